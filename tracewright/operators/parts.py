"""Scans in two levels: a long group is cut into parts of equal time, and each part begins with what those before it hold.

A part is a window partition of its own, so one recording that holds most rows is many tasks. What parts carry to one
another comes from a small table, one row a part: it is put among the rows as one more row that sorts before (or behind)
all rows of its part, so the rows themselves are shuffled once, as without parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Column that tells the part, and the one that sorts carried rows: -1 before a part's rows, 0 the rows, 1 behind them.
PART, EDGE = "_part", "_edge"


def part_of(time: Column, span: float | None) -> Column:
    """Number of the stretch of ``span`` that holds ``time``; null times are together before all others."""
    if span is None:
        return F.lit(0).cast("bigint")
    return F.coalesce(F.floor(time / F.lit(span)).cast("bigint"), F.lit(-(1 << 62)))


def span_for(df: DataFrame, by: list[str], time: str, rows: int = 1_000_000) -> float | None:
    """A span that gives about ``rows`` rows a part in the densest long group; None if no group is longer. One aggregate."""
    t = F.col(time).cast("double")
    groups = df.groupBy(*by).agg(F.count(t).alias("n"), (F.max(t) - F.min(t)).alias("length"))
    return groups.where(F.col("n") > rows).agg(F.min(F.col("length") * rows / F.col("n"))).first()[0]


def before(by: list[str]) -> WindowSpec:
    """The earlier parts of a group, over the table of parts."""
    return Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def behind(by: list[str]) -> WindowSpec:
    """The later parts of a group, nearest last."""
    return Window.partitionBy(*by).orderBy(F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)


def with_carried(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """``rows`` (by, PART, ...) and the ``carried`` ones (by, PART, EDGE, some of their columns)."""
    return rows.withColumn(EDGE, F.lit(0)).unionByName(carried, allowMissingColumns=True)


def running(by: list[str], order: list) -> WindowSpec:
    """A part's rows in order, what is carried into it first."""
    return Window.partitionBy(*by, PART).orderBy(EDGE, *order)
