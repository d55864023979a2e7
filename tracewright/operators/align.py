"""Interval alignment between two index spaces through timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators import parts as P


def indexed(df: DataFrame, by: list[str], order: list[str], name: str = "idx") -> DataFrame:
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("bigint"))


def align_ranges(plan: DataFrame, ref: DataFrame, src: DataFrame, by: list[str], plan_key: list[str], ts: str = "ts", index: str = "idx", span: float | None = None) -> DataFrame:
    """``plan`` (by, plan_key, start, end) with src_start and src_end, and empty where the window holds no source row.

    start and end are clamped into ``ref`` and turned into times; src_start is the number of source rows before the
    first time, src_end the number up to the second, less one; both are clamped into ``src``. So a window before or
    after all of the source gives one row, and one inside a gap gives src_end below src_start. Plans of groups
    without reference or source rows do not come back. With ``span`` the source rows of a group are counted in parts of
    that length of time, each beginning with the count before it.
    """
    size = ref.groupBy(*by).agg(F.count("*").alias("_n"))
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.col(c), F.col("_n") - 1))
    p = plan.join(size, by).withColumn("_a", clamp("start")).withColumn("_b", clamp("end"))
    at = lambda name, out: ref.select(*by, F.col(index).alias(name), F.col(ts).alias(out))
    p = p.join(at("_a", "_t1"), [*by, "_a"]).join(at("_b", "_t2"), [*by, "_b"])
    # one pass over bounds and source rows in order of time: the source rows before a bound are a running count
    keys = list(dict.fromkeys([*by, *plan_key]))
    mine = [c for c in keys if c not in by]
    bound = lambda c, place: F.struct(F.col(c).alias("_t"), F.lit(place).alias("_place"))
    plans = p.select(*by, F.explode(F.array(bound("_t1", 0), bound("_t2", 2))).alias("_b"), F.struct(*mine, "start", "end").alias("_plan")).select(*by, "_b.*", "_plan")
    rows = src.select(*by, F.col(ts).alias("_t"), F.lit(1).alias("_place"), F.lit(None).cast(plans.schema["_plan"].dataType).alias("_plan"))
    running = Window.partitionBy(*by).orderBy("_t", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    source = F.count(F.when(F.col("_place") == 1, 1))
    both = plans.unionByName(rows)
    if span is None:
        before = both.withColumn("_k", source.over(running)).withColumn("_m", source.over(Window.partitionBy(*by)))
    else:
        both = both.withColumn(P.PART, P.part_of(F.col("_t"), span))
        counts = both.groupBy(*by, P.PART).agg(source.alias("_n"))
        into = counts.select(*by, P.PART, F.lit(-1).alias(P.EDGE), F.coalesce(F.sum("_n").over(P.before(by)), F.lit(0)).alias("_more"), F.sum("_n").over(Window.partitionBy(*by)).alias("_all"))
        running = P.running(by, ["_t", "_place"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = lambda c: F.first(c, ignorenulls=True).over(running)
        before = P.with_carried(both, into).withColumn("_k", source.over(running) + carried("_more")).withColumn("_m", carried("_all"))
    at = lambda place: F.max(F.when(F.col("_place") == place, F.col("_k")))
    out = before.where("_place <> 1 AND _m > 0").groupBy(*by, "_plan").agg(at(0).alias("_s"), (at(2) - 1).alias("_e"), F.max("_m").alias("_m")).select(*by, "_plan.*", "_s", "_e", "_m")
    inside = lambda c: F.greatest(F.lit(0), F.least(F.col(c), F.col("_m") - 1)).cast("bigint")
    out = out.withColumn("src_start", inside("_s")).withColumn("src_end", inside("_e")).drop("_s", "_e", "_m")
    return out.withColumn("empty", F.col("src_end") < F.col("src_start"))


def planned_rows(plan: DataFrame, rows: DataFrame, by: list[str], index: str = "t") -> DataFrame:
    """Rows of a shared session within each plan's [max(start, 0), end): sequences are computed once and cut many times.

    Plans are spread to the places they cover, which are joined to the rows; so the work follows what comes back, and a
    long session is no hot key.
    """
    last = rows.groupBy(*by).agg(F.max(index).alias("_last"))
    p = plan.join(last, by).withColumn("_from", F.greatest(F.col("start"), F.lit(0)).cast("bigint")).withColumn("_to", F.least(F.col("end").cast("bigint") - 1, F.col("_last").cast("bigint")))
    spread = p.where("_to >= _from").withColumn(index, F.explode(F.sequence("_from", "_to"))).drop("_last", "_from", "_to")
    return spread.join(rows.withColumn(index, F.col(index).cast("bigint")), [*by, index])
