"""Planned episodes as folders ``tissue_N/k_action/episode_NNN`` of renamed frames and cut CSV, written as a transaction.

All files are first staged below ``_transaction`` in the target; then each episode's folder is moved to its place. The log
says how far a run came: one that was stopped before all was staged is undone by the next, one that was stopped later is
finished. Executors copy, write and move; the driver writes the log.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions import names as N
from tracewright.operators.align import planned_rows
from tracewright.schema import FPS
from tracewright.sources import files

TRANSACTION, STAGED, DONE = "_transaction", "STAGED", "DONE"
CSV = "ee_csv.csv"


def numbered_plan(plan: DataFrame, tissue: str, action: str, order: list[str]) -> DataFrame:
    """``plan`` with dst, the folder of each episode: actions are numbered in order of their names, episodes from 1 in
    ``order`` within tissue and action."""
    from tracewright.operators.planning import action_numbers, positions

    numbered = plan.join(F.broadcast(action_numbers(plan, action)), action)
    placed = positions(numbered, [tissue, action], order, name="_no")
    dst = F.format_string("tissue_%d/%s/episode_%03d", F.col(tissue).cast("bigint"), F.col("numbered"), F.col("_no") + 1)
    return placed.withColumn("dst", dst).drop("_no", "numbered")


def frame_files(plan: DataFrame, frames: DataFrame, cameras: dict[str, tuple[str, str]], op: str = "copy") -> DataFrame:
    """(dst_episode, src, dst, op) of the frames of each planned episode and camera, renamed by their place in it.

    ``plan`` has episode_id, start, end (frames from 0, both inclusive) and dst; ``frames`` episode_id, camera, frame_name,
    ts_ns and path, in order of time and name; ``cameras`` the folder and the name's suffix of each. Ends are held within
    the camera's own frames.
    """
    w = Window.partitionBy("episode_id", "camera").orderBy("ts_ns", "frame_name")
    placed = frames.select("episode_id", "camera", "frame_name", "path", (F.row_number().over(w) - 1).alias("t"))
    each = plan.select("episode_id", "dst", F.greatest(F.col("start"), F.lit(0)).alias("_start"), "start", (F.col("end") + 1).alias("end"), F.explode(F.array(*map(F.lit, cameras))).alias("camera"))
    found = planned_rows(each, placed, ["episode_id", "camera"])
    folder, suffix = (F.create_map(*[F.lit(x) for c, v in cameras.items() for x in (c, v[k])]) for k in (0, 1))
    extension = F.regexp_extract("frame_name", r"(\.[^.]*)$", 1)
    name = F.concat(F.format_string("frame%06d", F.col("t") - F.col("_start")), suffix[F.col("camera")], F.lower(extension))
    return found.select(F.col("dst").alias("dst_episode"), F.col("path").alias("src"), F.concat_ws("/", "dst", folder[F.col("camera")], name).alias("dst"), F.lit(op).alias("op"))


def csv_text(cells: Column) -> Column:
    """One line of CSV; cells with commas or quotes are quoted."""
    return F.array_join(F.transform(cells, lambda c: F.when(c.rlike('[,"]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)), ",")


def csv_lines(plan: DataFrame, raw: DataFrame, fps: int = FPS) -> DataFrame:
    """(file, line, text): the header and the rows start to end of each planned episode's CSV, as texts; the first cell of
    a row is its place in the episode as seconds.

    ``raw`` has episode_id and the line and cells of readers.raw_rows; rows beyond the file's last do not come. Blank
    lines hold no row.
    """
    rows = raw.where(F.size("cells") > 0)
    data = rows.where("line > 1").select("episode_id", "cells", (F.col("line") - 2).alias("t"))
    cut = planned_rows(plan.select("episode_id", "dst", F.greatest(F.col("start"), F.lit(0)).alias("_start"), "start", (F.col("end") + 1).alias("end")), data, ["episode_id"])
    place = F.col("t") - F.col("_start")
    timed = F.concat(F.array(N.normalized_time(place, fps)), F.slice("cells", 2, F.size("cells")))
    body = cut.select("dst", (place + 1).alias("line"), csv_text(timed).alias("text"))
    head = plan.join(rows.where("line = 1").select("episode_id", "cells"), "episode_id").select("dst", F.lit(0).cast("bigint").alias("line"), csv_text(F.col("cells")).alias("text"))
    return head.unionByName(body).select(F.concat(F.col("dst"), F.lit(f"/{CSV}")).alias("file"), "line", "text")


def state(root: str) -> str | None:
    """``open``, ``staged`` or None: how far an unfinished transaction in ``root`` is."""
    if files.kind(f"{root}/{TRANSACTION}") is None:
        return None
    return "staged" if files.read_text(f"{root}/{TRANSACTION}/{STAGED}") is not None else "open"


def recover(spark: SparkSession, root: str) -> str | None:
    """Finish or undo what a stopped run left in ``root``: ``finished``, ``undone`` or None (nothing was left)."""
    found = state(root)
    if found == "staged":
        commit(spark, root)
        return "finished"
    if found == "open":
        files.remove_folder(f"{root}/{TRANSACTION}")
        return "undone"
    return None


def stage(frames: DataFrame, lines: DataFrame, source: str, root: str, replace: bool = False) -> DataFrame:
    """Copy ``frames`` (frame_files) and write ``lines`` (csv_lines) below the transaction; (dst, frames, rows) by episode.

    An episode that is there already raises FileExistsError before anything is written, unless ``replace`` is given.
    """
    spark, at = frames.sparkSession, f"{root}/{TRANSACTION}"
    episodes = frames.select(F.col("dst_episode").alias("dst")).unionByName(lines.select(F.regexp_replace("file", "/[^/]*$", "").alias("dst"))).distinct()
    if not replace:

        def there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([d for d in batch.column("dst").to_pylist() if files.kind(f"{root}/{d}")], pa.string())], ["dst"])

        found = episodes.mapInArrow(there, "dst string").limit(1).collect()
        if found:
            raise FileExistsError(f"{root}/{found[0]['dst']}")
    files.make_folder(at)
    # each plan runs once: what was written is kept in the log and read from there
    files.place_all(frames, source, f"{at}/files").write.parquet(f"{at}/log/frames")
    files.write_lines(lines, f"{at}/files").write.parquet(f"{at}/log/csv")
    episode = lambda c, depth: F.substring_index(c, "/", depth)
    copied = spark.read.parquet(f"{at}/log/frames").groupBy(episode("dst", 3).alias("dst")).agg(F.count("*").alias("frames"))
    written = spark.read.parquet(f"{at}/log/csv").select(episode("file", 3).alias("dst"), (F.col("lines") - 1).alias("rows"))
    copied.join(written, "dst", "full").na.fill(0, ["frames", "rows"]).write.parquet(f"{at}/log/episodes")
    files.write_text(f"{at}/{STAGED}", "")
    return spark.read.parquet(f"{at}/log/episodes")


def commit(spark: SparkSession, root: str) -> int:
    """Move every staged episode to its place, one that is there first into the transaction; the number of episodes.

    May be repeated after a stop: an episode that is no longer staged has been moved.
    """
    at = f"{root}/{TRANSACTION}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("dst").to_pylist()
            for d in names:
                staged, to, old = f"{at}/files/{d}", f"{root}/{d}", f"{at}/old/{d}"
                if files.kind(staged):
                    if files.kind(to) and not files.kind(old):
                        files.move(to, old)
                    files.move(staged, to)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["dst"])

    n = spark.read.parquet(f"{at}/log/episodes").select("dst").mapInArrow(run, "dst string").count()
    files.remove_folder(at)
    return n


def restructured(plan: DataFrame, frames: DataFrame, raw: DataFrame, cameras: dict[str, tuple[str, str]], source: str, root: str, op: str = "copy", fps: int = FPS, replace: bool = False) -> int:
    """Write all planned episodes below ``root`` and return their number; what a stopped run left there is settled first.

    ``plan`` has episode_id (the source folder below ``source``), start, end and dst; see frame_files and csv_lines.
    With ``replace`` the folders of a former run are replaced: so episodes are trimmed in place.
    """
    recover(plan.sparkSession, root)
    stage(frame_files(plan, frames, cameras, op), csv_lines(plan, raw, fps), source, root, replace)
    return commit(plan.sparkSession, root)
