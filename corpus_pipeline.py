"""A corpus pipeline of five stages over ``documents``; each stage works on all that its predecessor kept.

All stages but the last return the columns of their input. Texts are whole; nothing is sampled or capped but the
classifier's labelled training rows (``bytecnn.SAMPLE``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import bpe, bytecnn, mixing, secrets, simhash
from tracewright.llm.common import removed, shared_folder, table
from tracewright.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the byte network, trained on the labelled fold, rejects."""
    return bytecnn.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return simhash.keep_one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; every document stays."""
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, cuts and leaves out documents so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes that they decode to."""
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
    ("byte-level BPE", encode_stage),
]

#: Learned scores, XXH64 fingerprints, seeded choices and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents``; each result is written as Parquet in the shared checkpoint folder and read again.

    A stage's folder is removed as soon as the next stage is written; the last one stays, as the result reads it.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            removed(spark, f"{folder}/{k - 1}")
    return docs
