"""Nearest-timestamp joins: one union, one shuffle by key, one ascending and one descending window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators import parts as P
from tracewright.schema import TOLERANCE_MS


def nearest_streams(probe: DataFrame, streams: Mapping[str, DataFrame], by: list[str], ts: str, key: str, tie: str = "later", span: float | None = None) -> DataFrame:
    """``probe`` plus, for each stream, a struct column of its row whose ``ts`` is nearest within ``by``; null without any.

    Ties go to the later row (or the ``earlier``). Of rows at one time the first by ``key`` is met from the left side,
    the last from the right. All streams share one shuffle and two sorts, however many they are. Null times are never
    near: such probes get null. With ``span`` a group is cut into parts of that length of time, each a task of its own
    that gets every stream's last row before it and first row behind it; the result is the same.
    """
    kinds = {n: F.struct(*[F.col(f"`{c}`") for c in s.columns]) for n, s in streams.items()}
    kept = F.struct(*[F.col(f"`{c}`") for c in probe.columns])
    types = {n: s.select(kinds[n].alias("v")).schema["v"].dataType for n, s in streams.items()}
    probe_type = probe.select(kept.alias("v")).schema["v"].dataType

    def laid(df: DataFrame, side: int, row: Column, own: str | None) -> DataFrame:
        cells = [(row if own == n else F.lit(None).cast(types[n])).alias(f"_s_{n}") for n in streams]
        order = F.col(key) if own else F.lit(None).cast(key_type)
        return df.select(*by, P.part_of(F.col(ts), span).alias(P.PART), F.col(ts).alias("_t"), F.lit(side).alias("_side"), order.alias("_key"), (kept if own is None else F.lit(None).cast(probe_type)).alias("_probe"), *cells)

    key_type = next(iter(streams.values())).schema[key].dataType
    rows = laid(probe, 0, kept, None)
    for n, s in streams.items():
        rows = rows.unionByName(laid(s.where(F.col(ts).isNotNull()), 1, kinds[n], n))
    up_order, down_order = ["_t", "_side", F.asc_nulls_first("_key")], [F.desc("_t"), F.desc("_side"), F.desc_nulls_last("_key")]
    up, down = Window.partitionBy(*by).orderBy(*up_order), Window.partitionBy(*by).orderBy(*down_order)
    if span is not None:
        rows = P.with_carried(rows, _carried(rows, list(streams), by))
        up, down = P.running(by, up_order), Window.partitionBy(*by, P.PART).orderBy(F.desc(P.EDGE), *down_order)
    up, down = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (up, down))
    out = rows
    for n in streams:
        out = out.withColumn(f"_p_{n}", F.last(f"_s_{n}", ignorenulls=True).over(up))
    for n in streams:
        out = out.withColumn(f"_n_{n}", F.last(f"_s_{n}", ignorenulls=True).over(down))
    out = out.where("_side = 0")  # carried rows have no side
    found = []
    for n in streams:
        p, q = F.col(f"_p_{n}"), F.col(f"_n_{n}")
        left, right = F.col("_t") - p[ts], q[ts] - F.col("_t")
        nearer = left < right if tie == "later" else left <= right
        found.append(F.when(F.col("_t").isNull(), F.lit(None)).when(q.isNull() | nearer, p).otherwise(q).alias(n))
    return out.select("_probe.*", *found)


def _carried(rows: DataFrame, streams: list[str], by: list[str]) -> DataFrame:
    """Two rows a part: each stream's last row of all parts before it, and the first one of all parts behind it."""
    order = lambda n: F.when(F.col(f"_s_{n}").isNotNull(), F.struct("_t", "_key"))
    ends = rows.groupBy(*by, P.PART).agg(*[F.max_by(f"_s_{n}", order(n)).alias(f"_last_{n}") for n in streams], *[F.min_by(f"_s_{n}", order(n)).alias(f"_first_{n}") for n in streams])
    into = ends.select(*by, P.PART, F.lit(-1).alias(P.EDGE), *[F.last(f"_last_{n}", ignorenulls=True).over(P.before(by)).alias(f"_s_{n}") for n in streams])
    out_of = ends.select(*by, P.PART, F.lit(1).alias(P.EDGE), *[F.last(f"_first_{n}", ignorenulls=True).over(P.behind(by)).alias(f"_s_{n}") for n in streams])
    return into.unionByName(out_of)


def nearest(probe: DataFrame, build: DataFrame, by: list[str], ts: str, key: str, tie: str = "later", name: str = "match", span: float | None = None) -> DataFrame:
    return nearest_streams(probe, {name: build}, by, ts, key, tie, span)


def within(probe_ts: Column, match: Column, ts: str, tolerance: float) -> Column:
    """True where the match lies within ``tolerance`` (inclusive); false without one."""
    return F.coalesce(F.abs(probe_ts - match[ts]) <= tolerance, F.lit(False))


def synchronized(frames: DataFrame, kinematics: DataFrame, by: list[str], ts: str = "ts_ns", key: str = "kin_idx", tolerance_ms: float | None = TOLERANCE_MS, span: float | None = None) -> DataFrame:
    """Frames with kin_idx, kin_ts_ns, time_diff_ns and time_diff_ms of their nearest sample; null tolerance keeps all."""
    near = nearest(frames, kinematics.select(*by, ts, key), by, ts, key, span=span)
    diff = F.col(ts) - F.col("match")[ts]
    out = near.select(*frames.columns, F.col("match")[key].alias("kinematics_idx"), F.col("match")[ts].alias("kinematics_ts"), diff.alias("time_diff_ns"), (diff / F.lit(1e6)).alias("time_diff_ms"))
    out = out.where("kinematics_idx IS NOT NULL")
    return out if tolerance_ms is None else without_outliers(out, tolerance_ms)


def without_outliers(sync: DataFrame, tolerance_ms: float = TOLERANCE_MS) -> DataFrame:
    return sync.where(F.abs("time_diff_ms") <= tolerance_ms)


def all_matching(left: DataFrame, streams: Mapping[str, DataFrame], by: list[str], ts: str, key: str, tolerance: float, span: float | None = None) -> DataFrame:
    """Rows of ``left`` for which every stream has a match within ``tolerance``, with one struct for each stream.

    A stream without rows in a group drops all rows of the group.
    """
    near = nearest_streams(left, streams, by, ts, key, span=span)
    for n in streams:
        near = near.where(within(F.col(ts), F.col(n), ts, tolerance))
    return near


def outlier_figures(matched: DataFrame, by: list[str], difference: str, limit: float) -> DataFrame:
    """(by, kept, removed, least, most): matches within and beyond ``limit``, and the range of those beyond."""
    near = F.abs(F.col(difference)) <= limit
    off = F.when(~near, F.abs(F.col(difference)))
    return matched.groupBy(*by).agg(F.count_if(near).alias("kept"), F.count_if(~near).alias("removed"), F.min(off).alias("least"), F.max(off).alias("most"))


def with_enough(matched: DataFrame, by: list[str], least: int) -> DataFrame:
    """(by, n) of groups with ``least`` matches or more."""
    return matched.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def gathered(sync: DataFrame, kinematics: DataFrame, by: list[str], index: str = "kinematics_idx", key: str = "kin_idx") -> DataFrame:
    """Rows of ``kinematics`` at the indices of ``sync``; indices that repeat give repeated rows."""
    picks = sync.select(*by, F.col(index).alias(key), *[c for c in sync.columns if c not in (*by, index, *kinematics.columns)])
    return picks.join(kinematics, [*by, key])
