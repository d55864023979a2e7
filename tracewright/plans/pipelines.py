"""The chains from raw streams to output rows, each one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators import align, asof, assemble, motion, planning
from tracewright.schema import FPS, MIN_IMAGES, MIN_LENGTH, TOLERANCE_MS, TRIM_THRESHOLD


@dataclass
class Filtered:
    """Frames that all streams match, the samples they point to, and one row of figures for each episode."""

    frames: DataFrame
    kinematics: DataFrame
    report: DataFrame


def filter_episodes(left: DataFrame, cameras: Mapping[str, DataFrame], kinematics: DataFrame, tolerance_ms: float = TOLERANCE_MS, min_images: int = MIN_IMAGES) -> Filtered:
    """Left frames (episode_id, frame_name, ts_ns) with a sample and a frame of every camera within the tolerance.

    Kinematics (episode_id, kin_idx, ts_ns, ...) and cameras share one union and one shuffle by episode. An episode
    with fewer than ``min_images`` such frames is left out; its row in the report says so.
    """
    by = ["episode_id"]
    named = {n: c.select("episode_id", "ts_ns", F.col("frame_name"), F.row_number().over(_frames_in_order()).cast("bigint").alias("key")) for n, c in cameras.items()}
    samples = kinematics.select("episode_id", "ts_ns", F.lit(None).cast("string").alias("frame_name"), F.col("kin_idx").alias("key"))
    near = asof.nearest_streams(left, {**named, "kin": samples}, by, "ts_ns", "key")
    tolerance = int(tolerance_ms * 1e6)
    ok = F.lit(True)
    for n in (*named, "kin"):
        ok = ok & asof.within(F.col("ts_ns"), F.col(n), "ts_ns", tolerance)
    marked = near.withColumn("ok", ok)
    report = marked.groupBy(*by).agg(F.count("*").alias("n_images"), F.count_if("ok").alias("n_kept"))
    report = report.withColumn("reason", F.when(F.col("n_kept") == 0, F.lit("no synchronized frames")).when(F.col("n_kept") < min_images, F.concat(F.lit(f"fewer than {min_images} frames: "), F.col("n_kept").cast("string"))))
    good = report.where("reason IS NULL").select(*by)
    kept = align.indexed(marked.where("ok").join(good, by, "left_semi"), by, ["ts_ns", "frame_name"], "frame_idx")
    frames = kept.select("episode_id", "frame_idx", "frame_name", "ts_ns", *[F.col(f"{n}.frame_name").alias(f"{n}_name") for n in named], F.col("kin.key").alias("kinematics_idx"), ((F.col("ts_ns") - F.col("kin.ts_ns")) / 1e6).alias("time_diff_ms"))
    sync = frames.select("episode_id", "frame_idx", "kinematics_idx")
    return Filtered(frames, asof.gathered(sync, kinematics, by), report)


def _frames_in_order():
    from pyspark.sql import Window

    return Window.partitionBy("episode_id").orderBy("ts_ns", "frame_name")


def trimmed_plan(plan: DataFrame, ref: DataFrame, src: DataFrame, moved: DataFrame, threshold: float = TRIM_THRESHOLD, min_length: int = MIN_LENGTH) -> DataFrame:
    """``plan`` (episode_id, plan_id, start, end in reference frames) with stationary head and tail taken off.

    The range is mapped into source frames, trimmed on their deltas (t, delta) and mapped back; plans that map to
    nothing or end up shorter than ``min_length`` go.
    """
    by, key = ["episode_id"], ["plan_id"]
    a = align.align_ranges(plan, ref, src, by, key, ts="ts_ns").where("NOT empty")
    # transitions of rows start .. end are t in [start, end)
    inner = a.select(*by, *key, F.col("src_start").alias("start"), F.col("src_end").alias("end"))
    hits = align.planned_rows(inner, moved.select(*by, "t", "delta"), by).where(motion.moving(F.col("delta"), threshold)).select(*by, *key, "t")
    cut = inner.join(hits, [*by, *key], "left")
    hit = F.col("t")
    ends = cut.groupBy(*by, *key, "start", "end").agg(F.min(hit).alias("f"), F.max(hit).alias("l"))
    src_range = ends.select(*by, *key, F.coalesce("f", "start").alias("start"), F.coalesce(F.least(F.col("l") + 1, F.col("end")), F.col("end")).alias("end"))
    back = align.align_ranges(src_range, src, ref, by, key, ts="ts_ns")
    out = back.select(*by, *key, F.col("src_start").alias("start"), F.col("src_end").alias("end"))
    return out.where(F.col("end") - F.col("start") + 1 >= min_length)


def converted(filtered: DataFrame, episode: str, order: list[str], state: str, action: str, session: list[str], fps: int = FPS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Output rows of aligned frames with state and action vectors; relative actions look ahead within ``session``."""
    rows = assemble.with_relative_actions(filtered, session, order, action)
    return assemble.assembled(rows, episode, order, state, action, "action_hybrid_relative", fps, carry)


def planned_episodes(annotations: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Parsed annotations with subdir, episode_no and destination, in order of destination."""
    p = planning.parsed_annotations(annotations).withColumn("subdir", planning.action_subdir(F.col("action")))
    p = planning.numbered_episodes(p, [*group, "subdir"], order)
    return p.withColumn("dst", F.concat_ws("/", *group, "subdir", F.format_string("episode_%03d", "episode_no"))).orderBy("dst")
