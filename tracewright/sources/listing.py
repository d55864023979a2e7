"""Directory trees as DataFrames: empty directories are data, so trees are listed before Spark reads any file."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import names as N
from tracewright.sources import files

IMAGES = (".jpg", ".jpeg", ".png")
NOT_IMAGES = (".csv", ".txt", ".json", ".xml")
SCHEMA = "path STRING, parent STRING, name STRING, is_dir BOOLEAN, depth INT"


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, parent, name, is_dir, depth) of all that lies under ``root``, links to directories not followed.

    Paths are relative to the root, whose own parent and path are empty. Executors list the folders of one level at a time;
    the driver holds the number of folders only. Levels stay in the executors' storage and are listed again if lost.
    Folders that cannot be read are empty. File systems that Arrow does not open by URI are listed through Hadoop, by the
    driver. A missing root raises FileNotFoundError.
    """
    try:
        there = files.kind(root) == "folder"
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return spark.createDataFrame(list(_hadoop(spark, root)), SCHEMA)
    if not there:
        raise FileNotFoundError(root)
    level, found, most = spark.createDataFrame([("",)], "path STRING"), None, 4 * spark.sparkContext.defaultParallelism
    while True:
        entries = level.mapInArrow(_listing_task(root), f"{SCHEMA}, is_link BOOLEAN").persist()
        below = entries.where("is_dir AND NOT is_link").select("path")
        n = below.count()
        found = entries if found is None else found.unionByName(entries)
        if not n:
            return found.drop("is_link")
        level = below.repartition(min(n, most))


def _listing_task(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that lists the folders it is given by their paths below ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = files.opened(root)
        local = isinstance(fs, pafs.LocalFileSystem)
        for batch in batches:
            for at in batch.column("path").to_pylist():
                try:
                    found = fs.get_file_info(pafs.FileSelector(f"{top}/{at}" if at else top))
                except OSError:
                    continue
                depth = at.count("/") + 2 if at else 1
                rows = [(f"{at}/{i.base_name}" if at else i.base_name, at, i.base_name, i.type == pafs.FileType.Directory, depth, local and os.path.islink(i.path)) for i in found]
                if rows:
                    kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "parent", "name", "is_dir", "depth", "is_link"])

    return run


def _hadoop(spark: SparkSession, root: str) -> Iterator[tuple]:
    jvm = spark._jvm
    start = jvm.org.apache.hadoop.fs.Path(root)
    fs = start.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(start):
        raise FileNotFoundError(root)
    todo = [(start, "", 0)]
    while todo:
        folder, at, depth = todo.pop()
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            path = f"{at}/{name}" if at else name
            yield path, at, name, status.isDirectory(), depth + 1
            if status.isDirectory():
                todo.append((status.getPath(), path, depth + 1))


def episodes(entries: DataFrame, need_images: bool = True) -> DataFrame:
    """Folders with the file ``ee_csv.csv`` and, if asked, the folder ``left_img_dir``, which may be empty; sorted."""
    csv = F.bool_or((F.col("name") == "ee_csv.csv") & ~F.col("is_dir"))
    left = F.bool_or((F.col("name") == "left_img_dir") & F.col("is_dir"))
    found = entries.groupBy("parent").agg(csv.alias("csv"), left.alias("left"))
    return found.where(F.col("csv") & (F.col("left") | F.lit(not need_images))).select(F.col("parent").alias("episode_id")).orderBy("episode_id")


def frames(entries: DataFrame, folders: dict[str, tuple[str, str]], lenient: bool = False) -> DataFrame:
    """(episode_id, camera, frame_name, ts_ns, seq_key, path) of the frames in each camera's (folder, name suffix).

    A frame's name ends with .jpg, holds the suffix, and has a time; others are not frames.
    """
    files = entries.where("NOT is_dir AND name LIKE '%.jpg'")
    out = None
    for camera, (folder, suffix) in folders.items():
        here = files.where(F.element_at(F.split("parent", "/"), -1) == folder).where(F.col("name").contains(suffix.removesuffix(".jpg")))
        episode = F.regexp_replace("parent", "(^|/)[^/]*$", "")
        part = here.select(episode.alias("episode_id"), F.lit(camera).alias("camera"), F.col("name").alias("frame_name"), N.frame_timestamp(F.col("name"), lenient).alias("ts_ns"), N.frame_number(F.col("name")).alias("seq_key"), "path")
        out = part if out is None else out.unionByName(part)
    return out.where("ts_ns IS NOT NULL")


def images(entries: DataFrame, natural: bool = False) -> DataFrame:
    """Image files by extension in any case, in order of their path; ``natural``: all files but tables and texts, in natural order."""
    extension = F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    files = entries.where("NOT is_dir")
    if natural:
        return files.where(~extension.isin(*NOT_IMAGES)).orderBy("parent", N.natural_key(F.col("name")), "name")
    return files.where(extension.isin(*IMAGES)).orderBy("path")


def direct_episodes(entries: DataFrame) -> DataFrame:
    """Episodes with a frame, and the tissue, collector, phase and action that their path names, in that order."""
    left = entries.where("NOT is_dir AND name LIKE '%.jpg'").where(F.element_at(F.split("parent", "/"), -1) == "left_img_dir")
    shown = left.select(F.regexp_replace("parent", "(^|/)[^/]*$", "").alias("episode_id")).distinct()
    found = episodes(entries, need_images=False).join(shown, "episode_id").withColumn("d", N.direct_parts(F.col("episode_id")))
    return found.where("d IS NOT NULL").select("episode_id", "d.*").orderBy("tissue_num", "collector", "phase", "action", "episode_id")


def numbered_folders(entries: DataFrame, parent: str = "") -> DataFrame:
    """(path, number) of the folders right below ``parent`` by the number at their names' end, those without one last."""
    here = entries.where("is_dir").where(F.col("parent") == parent)
    return here.select("path", N.trailing_number(F.col("name")).alias("number")).orderBy(F.asc_nulls_last("number"), "path")


def flat_folders(entries: DataFrame, parent: str = "") -> DataFrame:
    """(path, name) of the folders right below ``parent``, by name."""
    return entries.where("is_dir").where(F.col("parent") == parent).select("path", "name").orderBy("name")


def numbered_walk(entries: DataFrame, levels: int = 3) -> DataFrame:
    """(path, numbers) of the folders ``levels`` deep (tissue, subtask, episode), in order of the number at the end of each
    name on the way, then of the name; names without a number come last on their level."""
    parts = [F.get(F.split("path", "/"), F.lit(k)) for k in range(levels)]
    numbers = [N.trailing_number(p) for p in parts]
    rows = entries.where(F.col("is_dir") & (F.col("depth") == levels))
    return rows.select("path", F.array(*numbers).alias("numbers")).orderBy(*[o for k in range(levels) for o in (F.asc_nulls_last(F.get("numbers", F.lit(k))), F.get(F.split("path", "/"), F.lit(k)))])


def camera_frames(entries: DataFrame, folder: str, old_names: bool = False) -> DataFrame:
    """(episode_id, frame_name, ts_ns, path) of all .jpg files of a camera's folder whatever their suffix, by time;
    ``old_names`` takes names of the old form only. Names without a time are left out."""
    here = entries.where("NOT is_dir AND name LIKE '%.jpg'").where(F.element_at(F.split("parent", "/"), -1) == folder)
    time = F.when(F.lit(old_names) & F.col("name").rlike("^" + N.NEW_FRAME), F.lit(None)).otherwise(N.frame_timestamp(F.col("name")))
    rows = here.select(F.regexp_replace("parent", "(^|/)[^/]*$", "").alias("episode_id"), F.col("name").alias("frame_name"), time.alias("ts_ns"), "path")
    return rows.where("ts_ns IS NOT NULL").orderBy("episode_id", "ts_ns", "frame_name")


def tissue_runs(entries: DataFrame, modalities: list[str], prefix: str = "cautery_tissue") -> DataFrame:
    """(tissue, run) of the runs right below tissue folders (their names begin with ``prefix``) that hold a folder for each
    of the ``modalities``, empty or not; sorted."""
    from tracewright.operators.planning import complete_runs

    inside = entries.where("is_dir AND depth = 3").where(F.col("path").startswith(prefix))
    part = lambda k: F.get(F.split("path", "/"), F.lit(k))
    return complete_runs(inside.select(part(0).alias("tissue"), part(1).alias("run"), "name"), ["tissue", "run"], "name", modalities).orderBy("tissue", "run")


def run_frames(entries: DataFrame, modality: str) -> DataFrame:
    """(run, path) of the image files in each run's folder of a modality, in order of their whole path."""
    return images(entries.where(F.element_at(F.split("parent", "/"), -1) == modality)).select(F.regexp_replace("parent", "(^|/)[^/]*$", "").alias("run"), "path").orderBy("path")


def checked_structure(entries: DataFrame, cameras: list[str], separator: str = "; ") -> DataFrame:
    """(episode_id, valid, message) of each folder with an ``ee_csv.csv`` or a camera's folder: the first of the ``cameras``
    must hold a .jpg, the others a file, and the CSV must be there; the message lists what is wrong, in this order."""
    leaf, above = F.element_at(F.split("parent", "/"), -1), F.regexp_replace("parent", "(^|/)[^/]*$", "")
    inside = entries.where(~F.col("is_dir") & leaf.isin(cameras)).select(above.alias("episode_id"), leaf.alias("what"), F.col("name").endswith(".jpg").alias("jpg"), F.lit(True).alias("file"))
    own = entries.where((F.col("is_dir") & F.col("name").isin(cameras)) | (~F.col("is_dir") & (F.col("name") == "ee_csv.csv"))).select(F.col("parent").alias("episode_id"), F.col("name").alias("what"), F.lit(False).alias("jpg"), F.lit(False).alias("file"))
    of = lambda what, c: F.coalesce(F.bool_or(F.when(F.col("what") == what, F.col(c))), F.lit(False))
    checks = [F.when(~of(cameras[0], "jpg"), F.lit(f"no .jpg in {cameras[0]}")), *[F.when(~of(c, "file"), F.lit(f"{c} is empty or missing")) for c in cameras[1:]], F.when(~F.bool_or(F.col("what") == "ee_csv.csv"), F.lit("ee_csv.csv is missing"))]
    found = own.unionByName(inside).groupBy("episode_id").agg(F.concat_ws(separator, *checks).alias("message"))
    return found.select("episode_id", (F.col("message") == "").alias("valid"), "message").orderBy("episode_id")


def video_runs(entries: DataFrame, root: str) -> DataFrame:
    """(path, output) of folders collector/tissue/run with left frames, in order, and the name of each one's video."""
    left = entries.where("is_dir AND name = 'left_img_dir' AND depth = 4")
    part = lambda i: F.get(F.split("parent", "/"), F.lit(i))
    output = F.concat_ws("_", F.lit(root), part(0), F.replace(part(1), F.lit("#"), F.lit("")), part(2))
    return left.select(F.col("parent").alias("path"), F.concat(output, F.lit(".mp4")).alias("output")).orderBy("path")


def sessions(entries: DataFrame) -> DataFrame:
    """Folders whose name is a session's, with tissue, session and collector; sorted by path."""
    named = entries.where("is_dir").withColumn("s", N.session_parts(F.col("name"))).where("s IS NOT NULL")
    return named.select("path", "s.*").orderBy("path")
