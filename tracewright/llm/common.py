"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Texts may hold a hundred thousand characters, so batches stay short.
ARROW_ROWS = 512
#: Labels are learned only from rows outside this fold.
FOLDS, HELD_OUT_FOLD = 3, 1


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches short enough for very long texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``, else one set on the context.

    Without either this raises, as a folder of the driver's own machine would be lost on executors; only a local master,
    where all share one machine, gets a folder of its own under the working directory of Spark.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        context.setCheckpointDir(f"{spark.conf.get('spark.local.dir', '/tmp')}/checkpoints-{context.applicationId}")
    return context._jsc.sc().getCheckpointDir().get()


#: What a Python worker keeps from task to task, by name, with the function that lets it go.
KEPT: dict[str, Callable[[], object]] = {}


def batches_then_release(batches: Iterator, uses: str | None = None) -> Iterator:
    """``batches`` of one task that ``uses`` one of the things in KEPT: the others, kept by tasks of earlier stages, go first.

    A Python worker lives on for the tasks of later stages: when the batches end, memory that allocators hold without
    need goes back to the system.
    """
    for name in [n for n in KEPT if n != uses]:
        KEPT.pop(name)()
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others need not
    if trim is not None:
        trim(0)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file systems, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Rows of a few numbers each that may be broadcast; larger tables are shuffled instead.
BROADCAST_ROWS = 200_000
#: Keys with more than one in HOT of all rows are at most HOT.
HOT = 1000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` (narrow, and cheap to read twice) marked for broadcast if it has at most BROADCAST_ROWS rows, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def join_hot(rows: DataFrame, groups: DataFrame, key: str, counts: DataFrame, total: int, most: int = HOT) -> DataFrame:
    """The inner join of ``rows`` and ``groups`` (one row a key), where a few keys may hold most rows.

    ``counts`` has (key, n), the rows of each key. Keys with more than one in ``most`` of ``total`` rows are at most ``most``:
    their groups are broadcast, so that no task gets all rows of one key. The other keys are shuffled as usual. Wide
    groups take a smaller ``most``.
    """
    hot = F.broadcast(counts.where(F.col("n") * most > total).select(key))
    few = groups.join(hot, key, "left_semi")
    return rows.join(F.broadcast(few), key).unionByName(rows.join(hot, key, "left_anti").join(groups, key))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no label may be learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> list[tuple[str, int]]:
    """At most ``per_class[c]`` training texts of each class, picked by a hash of the id; the held-out fold is never read.

    Repeated labels of one id count as their largest; null labels, ids and texts do not count. The choice is made on
    the narrow label table, so only the chosen texts (a bounded number) reach the driver.
    """
    marks = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    picked = None
    for value, most in sorted(per_class.items()):
        part = marks.where(F.col("_y") == value).orderBy(F.xxhash64("_id", F.lit(7)), "_id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    rows = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(F.broadcast(picked), "_id")
        .where(F.col("_text").isNotNull())
        .groupBy("_id")
        .agg(F.min("_text").alias("_text"), F.max("_y").alias("_y"))
        .collect()
    )
    rows.sort(key=lambda r: r["_id"])
    return [(r["_text"], r["_y"]) for r in rows]
