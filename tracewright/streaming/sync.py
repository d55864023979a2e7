"""Nearest-sample synchronisation of two live streams (extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidate_pairs(frames: DataFrame, samples: DataFrame, tolerance_ms: int, late: str = "10 seconds") -> DataFrame:
    """Pairs of frames (episode_id, frame_id, frame_time) and samples (episode_id, kin_idx, kin_time) within the tolerance.

    Both sides carry a watermark of ``late`` and the condition bounds the times, so the join's state is bounded: a row
    goes once the other side's watermark is past its tolerance.
    """
    near = F.expr(f"kin_time >= frame_time - INTERVAL {tolerance_ms} MILLISECONDS AND kin_time <= frame_time + INTERVAL {tolerance_ms} MILLISECONDS")
    left = frames.withWatermark("frame_time", late).withColumnRenamed("episode_id", "_episode")
    return left.join(samples.withWatermark("kin_time", late), (F.col("_episode") == F.col("episode_id")) & near).drop("_episode")


def nearest_of_pairs(pairs: DataFrame) -> DataFrame:
    """The nearest sample of each frame, ties to the later: over a finished set of pairs, as in foreachBatch or a table."""
    gap = F.abs(F.unix_micros("frame_time") - F.unix_micros("kin_time"))
    best = F.min_by(F.struct("kin_idx", "kin_time"), F.struct(gap, -F.unix_micros("kin_time"), F.col("kin_idx")))
    return pairs.groupBy("episode_id", "frame_id", "frame_time").agg(best.alias("m")).select("episode_id", "frame_id", "frame_time", "m.kin_idx", "m.kin_time")
