"""Motion along ordered sequences: deltas with quaternion sign repair, trim ranges, threshold studies."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tracewright.functions import quaternion as Q
from tracewright.operators import parts as P
from tracewright.schema import MIN_LENGTH

#: Value bins an octave of exact percentiles.
BINS = 1024


def deltas(df: DataFrame, by: list[str], order: list[str], columns: list[str], quaternions: list[list[str]] = (), span: float | None = None) -> DataFrame:
    """``df`` plus t (transition index, -1 on the first row) and delta, the L2 norm of the step from the row before.

    A quaternion's step takes the sign that brings it nearer its predecessor: sign repair along the whole sequence
    changes no norm beyond that, so one lag replaces the scan. Null on the first row of a group. With ``span`` a group is
    cut into parts of that length along the first of ``order``, a number; each begins with the row before it.
    """
    w, number = Window.partitionBy(*by).orderBy(*order), F.lit(-2)
    if span is not None:
        df, w = _parted(df, by, order, list(dict.fromkeys([*columns, *[c for q in quaternions for c in q]])), span)
        number = F.first("_before", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 3
    members = {c for q in quaternions for c in q}
    value = lambda c: F.col(f"`{c}`").cast("double")
    before = lambda c: F.lag(value(c)).over(w)
    terms = [F.pow(value(c) - before(c), F.lit(2.0)) for c in columns if c not in members]
    for q in quaternions:
        d = sum((value(c) * before(c) for c in q[1:]), value(q[0]) * before(q[0]))
        sign = F.when(d < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        terms += [F.pow(value(c) - sign * before(c), F.lit(2.0)) for c in q]
    total = sum(terms[1:], terms[0])
    out = df.withColumn("t", (F.row_number().over(w) + number).cast("bigint")).withColumn("delta", F.sqrt(total))
    return out if span is None else out.where(F.col(P.EDGE) == 0).drop(P.EDGE, P.PART, "_before")


def _parted(df: DataFrame, by: list[str], order: list[str], columns: list[str], span: float) -> tuple[DataFrame, WindowSpec]:
    """``df`` in parts, each with one more row: ``columns`` of the row before the part, and _before, the rows before it."""
    rows = df.withColumn(P.PART, P.part_of(F.col(order[0]), span))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns])
    ends = rows.groupBy(*by, P.PART).agg(F.count("*").alias("_n"), F.max_by(kept, F.struct(*order)).alias("_v"))
    into = ends.select(*by, P.PART, F.lit(-1).alias(P.EDGE), F.coalesce(F.sum("_n").over(P.before(by)), F.lit(0)).alias("_before"), F.last("_v", ignorenulls=True).over(P.before(by)).alias("_v"))
    return P.with_carried(rows, into.select(*by, P.PART, P.EDGE, "_before", "_v.*")), P.running(by, order)


def quaternion_signs(df: DataFrame, by: list[str], order: list[str], q: str, span: float | None = None) -> DataFrame:
    """``df`` plus sign (1 or -1): what repeated sign repair along the sequence multiplies ``q`` by.

    A product of exactly 0 with the row before resets the sign, so signs are parities within stretches between zeros.
    ``span`` cuts groups into parts as in ``deltas``; rows before a part's first zero add what the parts before leave.
    """
    if span is not None:
        return _signs_of_parts(df, by, order, q, span)
    w = Window.partitionBy(*by).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("_dot", Q.dot(F.lag(q).over(w), F.col(q)))
    d = d.withColumn("_seg", F.sum(F.when(F.col("_dot") == 0, 1).otherwise(0)).over(run))
    inner = Window.partitionBy(*by, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum(F.when(F.col("_dot") < 0, 1).otherwise(0)).over(inner)
    return d.withColumn("sign", F.when(flips % 2 == 0, 1).otherwise(-1)).drop("_dot", "_seg")


def _signs_of_parts(df: DataFrame, by: list[str], order: list[str], q: str, span: float) -> DataFrame:
    rows, w = _parted(df, by, order, [q], span)
    # the row that stands for the parts before has no product; its part's first row has its own with it
    d = rows.withColumn("_dot", Q.dot(F.lag(q).over(w), F.col(q))).where(F.col(P.EDGE) == 0).drop(P.EDGE, "_before")
    own = Window.partitionBy(*by, P.PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_seg", F.sum(F.when(F.col("_dot") == 0, 1).otherwise(0)).over(own))
    inner = Window.partitionBy(*by, P.PART, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_flips", F.sum(F.when(F.col("_dot") < 0, 1).otherwise(0)).over(inner))
    ends = d.groupBy(*by, P.PART).agg((F.max("_seg") > 0).cast("int").alias("_reset"), F.max_by("_flips", F.struct("_seg", "_flips")).alias("_tail"))
    upto = Window.partitionBy(*by).orderBy(P.PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_chain", F.sum("_reset").over(upto))
    ends = ends.withColumn("_run", F.sum("_tail").over(Window.partitionBy(*by, "_chain").orderBy(P.PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    left = ends.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col(P.PART).alias("_at"), F.coalesce(F.lag("_run").over(Window.partitionBy(*by).orderBy(P.PART)), F.lit(0)).alias("_left"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col(P.PART) == F.col("_at"))
    total = F.col("_flips") + F.when(F.col("_seg") == 0, F.col("_left")).otherwise(0)
    out = d.join(left, same).withColumn("sign", F.when(total % 2 == 0, 1).otherwise(-1))
    return out.drop("_dot", "_seg", "_flips", "_left", "_at", P.PART, *[f"_by_{c}" for c in by])


def moving(delta: Column, threshold: Column | float) -> Column:
    """NaN is not motion, though Spark orders it above every number."""
    return (delta > threshold) & ~F.isnan(delta)


def trim_ranges(moved: DataFrame, by: list[str], threshold: Column | float) -> DataFrame:
    """(by, n_rows, start, end) of rows with t and delta: first motion to last motion + 1; without motion all rows."""
    hit = F.when(moving(F.col("delta"), threshold), F.col("t"))
    n = F.count("*")
    return moved.groupBy(*by).agg(
        n.alias("n_rows"),
        F.coalesce(F.min(hit), F.lit(0)).cast("bigint").alias("start"),
        F.coalesce(F.least(F.max(hit) + 1, n - 1), n - 1).cast("bigint").alias("end"),
    )


def trim_report(ranges: DataFrame, min_length: int = MIN_LENGTH, dry_run: bool = False) -> DataFrame:
    """``ranges`` plus trimmed_length, start_removed, end_removed, skipped and reason."""
    length = F.col("end") - F.col("start") + 1
    none = (F.col("start") == 0) & (F.col("end") == F.col("n_rows") - 1)
    short = F.concat(F.lit("trimmed length "), length.cast("string"), F.lit(f" < min {min_length}"))
    reason = F.when(F.col("n_rows") < 2, F.lit("too few rows")).when(length < min_length, short).when(none, F.lit("no stationary frames detected")).otherwise(F.lit("dry-run" if dry_run else "trimmed"))
    skipped = (F.col("n_rows") < 2) | (length < min_length)
    return ranges.select("*", length.alias("trimmed_length"), F.col("start").alias("start_removed"), (F.col("n_rows") - 1 - F.col("end")).alias("end_removed"), skipped.alias("skipped"), reason.alias("reason"))


def pipeline_figures(report: DataFrame) -> DataFrame:
    """One row of processed, skipped and unreadable episodes, kept frames and all rows, from trim_report."""
    done, few = ~F.col("skipped"), F.col("n_rows") < 2
    counts = [F.count_if(done).alias("processed"), F.count_if(F.col("skipped") & ~few).alias("skipped"), F.count_if(few).alias("errors")]
    return report.agg(*counts, F.coalesce(F.sum(F.when(done, F.col("trimmed_length"))), F.lit(0)).cast("bigint").alias("frames"), F.sum("n_rows").cast("bigint").alias("rows"))


def with_missing(report: DataFrame, episodes: DataFrame, by: list[str]) -> DataFrame:
    """``report`` with a skipped row, reason ``missing CSV``, for each of the ``episodes`` that has no samples."""
    lost = episodes.join(report.select(*by), by, "left_anti").select(*by, F.lit(0).cast("bigint").alias("n_rows"), F.lit(True).alias("skipped"), F.lit("missing CSV").alias("reason"))
    return report.unionByName(lost, allowMissingColumns=True)


def nearest_threshold(grid: DataFrame, wanted: float, threshold: str = "threshold") -> DataFrame:
    """The row of ``grid`` whose threshold is nearest to ``wanted``, the smaller one of two."""
    return grid.orderBy(F.abs(F.col(threshold) - wanted), threshold).limit(1)


def trimmed(rows: DataFrame, report: DataFrame, by: list[str], index: str) -> DataFrame:
    """Rows within their group's range; a skipped group stays whole."""
    bounds = report.select(*by, "start", "end", "skipped")
    return rows.join(bounds, by).where(F.col("skipped") | F.col(index).between(F.col("start"), F.col("end"))).drop("start", "end", "skipped")


def trim_stats(report: DataFrame) -> DataFrame:
    cut = ~F.col("skipped") & (F.col("trimmed_length") < F.col("n_rows"))
    removed = F.when(cut, F.col("n_rows") - F.col("trimmed_length")).otherwise(0)
    return report.agg(F.count("*").alias("total"), F.count_if(cut).alias("trimmed"), F.coalesce(F.sum(removed), F.lit(0)).cast("bigint").alias("frames_removed"))


def number_below(edges: list[float], x: Column) -> Column:
    """How many of the ascending ``edges`` are below ``x``, found by halving; 0 for null and NaN."""
    table = F.split(F.lit(",".join(map(repr, edges))), ",").cast("array<double>")  # folded into one constant
    strides = [1 << k for k in range(len(edges).bit_length() - 1, -1, -1)]
    found = F.aggregate(F.array(*map(F.lit, strides)), F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) < x, at + s).otherwise(at))
    return F.when(F.isnan(x), F.lit(0)).otherwise(found)


def threshold_steps(moved: DataFrame, by: list[str], thresholds: list[float]) -> DataFrame:
    """(by, n, low, high, length): the trimmed length of a group's n rows under thresholds number low to high - 1, of those
    in ascending order; the steps of one group cover all thresholds.

    A row counts for the thresholds below its delta. Rows are grouped by how many those are; the first and last motion
    under a threshold are then the least and greatest t of the groups above it, running from the highest group down.
    """
    k = len(thresholds)
    each = moved.groupBy(*by, number_below(sorted(map(float, thresholds)), F.col("delta")).alias("k")).agg(F.count("*").alias("c"), F.min("t").alias("f"), F.max("t").alias("l"))
    down = Window.partitionBy(*by).orderBy(F.desc("k"))
    run = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select(*by, "k", F.sum("c").over(Window.partitionBy(*by)).alias("n"), F.min("f").over(run).alias("f"), F.max("l").over(run).alias("l"), F.lead("k", 1, 0).over(down).alias("below"), F.row_number().over(down).alias("place"))
    own = F.struct(F.col("below").alias("low"), F.col("k").alias("high"), (F.least(F.col("l") + 1, F.col("n") - 1) - F.col("f") + 1).alias("length"))
    still = F.when(F.col("place") == 1, F.struct(F.col("k").alias("low"), F.lit(k).alias("high"), F.col("n").alias("length")))
    return each.select(*by, "n", F.explode(F.array(own, still)).alias("s")).where("s.low < s.high").select(*by, "n", "s.*")


def threshold_sweep(moved: DataFrame, by: list[str], thresholds: list[float], min_length: int = MIN_LENGTH) -> DataFrame:
    """Per threshold: total_removed, episodes_dropped, mean_length, median_length (0 where nothing is kept).

    The rows are read once and cost the same for any number of thresholds; see ``threshold_steps``.
    """
    order = sorted(range(len(thresholds)), key=lambda i: thresholds[i])
    listed = lambda x, kind: F.split(F.lit(",".join(map(repr, x))), ",").cast(f"array<{kind}>")
    steps = threshold_steps(moved, by, thresholds).select("n", "length", F.explode(F.sequence("low", F.col("high") - 1)).alias("at"))
    # episodes of equal figures are counted together before they are spread over tasks
    one = steps.groupBy("at", "n", "length").agg(F.count("*").alias("c"))
    kept = F.col("length") >= min_length
    out = one.groupBy("at").agg(
        F.sum(F.when(kept, F.col("n") - F.col("length")).otherwise(F.col("n")) * F.col("c")).cast("bigint").alias("total_removed"),
        F.coalesce(F.sum(F.when(~kept, F.col("c"))), F.lit(0)).cast("bigint").alias("episodes_dropped"),
        F.coalesce(F.sum(F.when(kept, F.col("length") * F.col("c"))) / F.sum(F.when(kept, F.col("c"))), F.lit(0.0)).alias("mean_length"),
        F.coalesce(F.percentile(F.when(kept, F.col("length")), F.lit(0.5), F.col("c")), F.lit(0.0)).alias("median_length"),
    )
    return out.select(F.get(listed(order, "int"), F.col("at")).alias("i"), F.get(listed(sorted(map(float, thresholds)), "double"), F.col("at")).alias("threshold"), *[c for c in out.columns if c != "at"])


def threshold_grid(low: float, high: float, points: int = 50) -> list[float]:
    """``points`` thresholds, evenly spaced by logarithm from half a decade below ``low`` to half above ``high``."""
    from math import log10

    a, b = log10(low) - 0.5, log10(high) + 0.5
    return [10 ** (a + (b - a) * i / (points - 1)) for i in range(points)]


def delta_histogram(moved: DataFrame, points: int = 100) -> DataFrame:
    """(bin, count) of positive deltas over points - 1 bins, even by logarithm between whole decades; the last is closed."""
    x = moved.where(moving(F.col("delta"), 0.0)).select(F.log10("delta").alias("x"))
    edges = x.agg(F.floor(F.min("x")).alias("lo"), F.ceil(F.max("x")).alias("hi"))
    bins = points - 1
    width = F.greatest((F.col("hi") - F.col("lo")) / bins, F.lit(1e-12))
    return x.join(F.broadcast(edges)).groupBy(F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("count"))


def below_and_above(moved: DataFrame, threshold: float) -> DataFrame:
    x = moved.where(moving(F.col("delta"), 0.0))
    return x.agg(F.count_if(F.col("delta") <= threshold).alias("below"), F.count_if(F.col("delta") > threshold).alias("above"))


def delta_percentiles(moved: DataFrame, points: tuple[float, ...] = (0.05, 0.25, 0.5)) -> DataFrame:
    """One row of exact percentiles of the positive deltas, interpolated linearly; nulls where there are none.

    No task holds all values: counts of narrow value bins (BINS an octave, about two million for all doubles) locate
    the two order statistics of each point, and only the bins that hold one are sorted, by distinct values.
    """
    x = moved.where(moving(F.col("delta"), 0.0)).select("delta", F.floor(F.log2("delta") * BINS).alias("_bin"))
    counts = x.groupBy("_bin").agg(F.count("*").alias("_n"))
    total, upto = F.sum("_n").over(Window.partitionBy()), F.sum("_n").over(Window.orderBy("_bin"))
    counts = counts.select("_bin", total.alias("_total"), (upto - F.col("_n")).alias("_from"), upto.alias("_upto"))
    places = [F.lit(float(p)) * (F.col("_total") - 1) for p in points]
    within = lambda rank, first, end: (F.col(first) <= rank) & (rank < F.col(end))
    ranks = [r for at in places for r in (F.floor(at), F.ceil(at))]
    # two bins for a point at most
    wanted = counts.where(reduce(or_, [within(r, "_from", "_upto") for r in ranks]))
    values = x.join(F.broadcast(wanted), "_bin").groupBy("_bin", "_from", "_total", "delta").agg(F.count("*").alias("_n"))
    end = F.col("_from") + F.sum("_n").over(Window.partitionBy("_bin").orderBy("delta"))
    values = values.select("delta", "_total", end.alias("_end"), (end - F.col("_n")).alias("_first"))
    out = []
    for p, at in zip(points, places, strict=True):
        low, high = (F.max(F.when(within(f(at), "_first", "_end"), F.col("delta"))) for f in (F.floor, F.ceil))
        share = F.max(at - F.floor(at))
        out.append(F.when(share == 0, low).otherwise(low * (1 - share) + high * share).alias(f"p{round(p * 100):02d}"))
    return values.agg(*out)


def threshold_shares(moved: DataFrame, threshold: float) -> DataFrame:
    """below_and_above with both in percent of all positive deltas, 0 without any."""
    n = F.col("below") + F.col("above")
    share = lambda c: F.when(n == 0, F.lit(0.0)).otherwise(100.0 * F.col(c) / n)
    return below_and_above(moved, threshold).select("below", "above", share("below").alias("below_percent"), share("above").alias("above_percent"))


def fraction_figures(fractions: DataFrame) -> DataFrame:
    """One row of least, most, mean and median of stationary_fraction over episodes; nulls without episodes."""
    return fractions.agg(F.min("percent").alias("least"), F.max("percent").alias("most"), F.avg("percent").alias("mean"), F.percentile("percent", F.lit(0.5)).alias("median"))


def stationary_fraction(moved: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """(by, percent): deltas at or below the threshold, in percent of all; 0 without any."""
    n = F.count("delta")
    return moved.groupBy(*by).agg(F.when(n == 0, F.lit(0.0)).otherwise(100.0 * F.count_if(F.col("delta") <= threshold) / n).alias("percent"))
