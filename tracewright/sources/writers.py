"""Datasets, metadata and copy manifests as files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions import names as N
from tracewright.sources import files


def write_dataset(rows: DataFrame, root: str, chunk: int = 1000) -> None:
    """``data/chunk-000/episode_000000.parquet``: one file an episode, its rows in order of frame_index.

    Tasks write one file for each of their episodes under ``root/_staged``; these are then moved to their names, which
    touches no data. Episodes that are there already raise FileExistsError before anything moves.
    """
    spark, staged = rows.sparkSession, f"{root}/_staged"
    laid = rows.withColumn("_episode", F.col("episode_index"))
    laid.repartition("_episode").sortWithinPartitions("_episode", "frame_index").write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("_episode").parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    moves = []
    for folder in fs.listStatus(path(staged)):
        name = folder.getPath().getName()
        if name.startswith("_episode="):
            episode = int(name.removeprefix("_episode="))
            file = next(f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet"))
            moves.append((file, path(f"{root}/data/chunk-{episode // chunk:03d}/episode_{episode:06d}.parquet")))
    there = [str(to) for _, to in moves if fs.exists(to)]
    if there:
        raise FileExistsError(there[0])
    for file, to in moves:
        fs.mkdirs(to.getParent())
        fs.rename(file, to)
    fs.delete(path(staged), True)


def file_manifest(rows: DataFrame, chunk: int = 1000) -> DataFrame:
    """(episode_index, path): the exact file name that each episode has in the published layout."""
    return rows.select("episode_index").distinct().select("episode_index", N.chunk_path(F.col("episode_index"), chunk).alias("path"))


def write_splits(counts: DataFrame, root: str) -> dict[str, str]:
    """Splits of a one-row frame (n, perfect, recovery) written into ``meta/info.json``, whose other entries stay."""
    from tracewright.operators.planning import splits

    out = counts.select(*splits(F.col("n"), F.col("perfect"), F.col("recovery"))).first().asDict()
    path = f"{root}/meta/info.json"
    info = json.loads(files.read_text(path) or "{}")
    files.write_text(path, json.dumps(info | {"splits": out}, indent=2))
    return out


def write_kinematics(rows: DataFrame, path: str, by: str = "episode_id", order: str = "frame_idx", names: dict[str, str] | None = None) -> DataFrame:
    """``path/<episode>/ee_csv.csv``: each episode's rows in ``order`` under a header; (file, lines) of what was written.

    ``by`` and ``order`` are no columns of the files; ``names`` gives columns other names in the header. One task writes
    one file, whole or not at all; episodes without rows have none.
    """
    kept = [c for c in rows.columns if c not in (by, order)]
    head = ",".join((names or {}).get(c, c) for c in kept)
    file = F.concat(F.col(by).cast("string"), F.lit("/ee_csv.csv")).alias("file")
    body = rows.select(file, F.col(order).alias("line"), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in kept])).alias("text"))
    top = rows.select(file).distinct().select("file", F.lit(-1).alias("line"), F.lit(head).alias("text"))
    spark = rows.sparkSession
    return spark.createDataFrame(files.write_lines(top.unionByName(body), path).collect(), "file string, lines bigint")


def execute_manifest(manifest: DataFrame, source: str, target: str, dry_run: bool = False) -> int:
    """Copies or links (src, dst, op) below the two roots on the executors; rerunning a task repeats no harm.

    Returns the number of rows, from the one run of the plan; with ``dry_run`` nothing is written.
    """
    return manifest.count() if dry_run else files.place_all(manifest, source, target).agg(F.count("src")).first()[0]
