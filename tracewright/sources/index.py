"""An index of a dataset's files from their Parquet footers, and reads of single row groups."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.sources import files, listing, metadata, readers

INDEX = "episode_index BIGINT, file STRING, row_group INT, rows BIGINT, first DOUBLE, last DOUBLE"


def dataset_index(spark: SparkSession, root: str, time: str = "timestamp") -> DataFrame:
    """INDEX of the published files below ``root``: one row a row group, with the range of ``time`` in it (null without
    statistics). Executors read the footers only."""
    below = listing.listed(spark, f"{root}/data").where("NOT is_dir").where(F.col("path").rlike(r"^chunk-[^/]*/episode_[0-9]+\.parquet$"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                fs, at = files.opened(f"{root}/data/{path}")
                with fs.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                episode = int(path.rsplit("_", 1)[1].removesuffix(".parquet"))
                column = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == time), None)
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = group.column(column).statistics if column is not None else None
                    low, high = (float(stats.min), float(stats.max)) if stats is not None and stats.has_min_max else (None, None)
                    out.append((episode, f"data/{path}", g, group.num_rows, low, high))
            if out:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["episode_index", "file", "row_group", "rows", "first", "last"])

    return below.select("path").mapInArrow(run, INDEX)


def rows_between(index: DataFrame, root: str, wanted: DataFrame, time: str = "timestamp") -> DataFrame:
    """Rows of the dataset whose ``time`` is in a wanted (episode_index, start, end) range of their episode, ends included;
    rows in several ranges of one episode come once. Of each file only the row groups that may hold such rows are read.

    An episode's ranges are few: they travel with its row groups. Without a row group to read there are no rows.
    """
    spark = index.sparkSession
    ranges = wanted.groupBy("episode_index").agg(F.collect_set(F.struct(F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))).alias("ranges"))
    met = F.exists("ranges", lambda r: F.col("first").isNull() | ((r["start"] <= F.col("last")) & (r["end"] >= F.col("first"))))
    groups = index.join(ranges, "episode_index").where(met).select("file", "row_group", "ranges")
    some = index.select("file").limit(1).collect()
    if not some:
        raise ValueError(f"no episode files below {root}")
    schema = spark.read.parquet(f"{root}/{some[0]['file']}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, group, spans in zip(*(batch.column(c).to_pylist() for c in ("file", "row_group", "ranges")), strict=True):
                fs, at = files.opened(f"{root}/{file}")
                with fs.open_input_file(at) as f:
                    rows = pq.ParquetFile(f).read_row_group(group, columns=schema.names)
                keep = None
                for s in spans:
                    x = pc.cast(rows[time], pa.float64())
                    here = pc.and_(pc.greater_equal(x, s["start"]), pc.less_equal(x, s["end"]))
                    keep = here if keep is None else pc.or_(keep, here)
                yield from rows.filter(keep).to_batches()

    return groups.repartition("file", "row_group").mapInArrow(run, schema)


@dataclass
class Dataset:
    """A published dataset: fps, chunk size and video features of its info document, episodes with their tasks, and rows."""

    fps: float
    chunk_size: int
    video_keys: list[str]
    episodes: DataFrame
    rows: DataFrame


def loaded(spark: SparkSession, root: str) -> Dataset:
    """The dataset below ``root``. Rows have the tasks of their episode's line in meta/episodes.jsonl, where blank lines are
    skipped; rows of episodes without a line have null."""
    info = metadata.video_features(spark.read.option("wholetext", True).text(f"{root}/meta/info.json")).first()
    lines = metadata.parsed_lines(readers.numbered_lines(spark, f"{root}/meta/episodes.jsonl")).where("readable")
    episodes = lines.select("episode_index", "length", F.col("task_list").alias("tasks"), "line")
    # of repeated lines of one episode the first counts
    one = episodes.groupBy("episode_index").agg(F.min_by("tasks", "line").alias("tasks"))
    rows = readers.dataset(spark, root, chunk=info["chunk_size"]).join(one, "episode_index", "left")
    return Dataset(info["fps"], info["chunk_size"], info["video_keys"], episodes, rows)
