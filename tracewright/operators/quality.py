"""Data-quality rules as findings (level, category, message, details)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import quaternion as Q
from tracewright.schema import JAW_HIGH, JAW_LOW, NORM_TOLERANCE

LEVELS = ("ERROR", "WARNING", "INFO", "SUCCESS")


def not_finite(v: Column) -> Column:
    return F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))


def norm_off(v: Column, arm: int) -> Column:
    return F.abs(Q.norm(Q.orientation(v, arm)) - 1) > NORM_TOLERANCE


def jaw_off(v: Column, arm: int) -> Column:
    return (Q.jaw(v, arm) < JAW_LOW) | (Q.jaw(v, arm) > JAW_HIGH)


def steps(df: DataFrame, by: list[str], order: list[str], ts: str) -> DataFrame:
    return df.withColumn("step", F.col(ts) - F.lag(ts).over(Window.partitionBy(*by).orderBy(*order)))


def monotonic(df: DataFrame, by: list[str], order: list[str], ts: str) -> DataFrame:
    """(by, violations, ok): steps that do not rise."""
    bad = F.count_if(F.col("step") <= 0)
    return steps(df, by, order, ts).groupBy(*by).agg(bad.alias("violations"), (bad == 0).alias("ok"))


def gaps(df: DataFrame, by: list[str], order: list[str], ts: str, limit: float) -> DataFrame:
    """(by, max_gap, gap): whether the longest step is above ``limit``."""
    return steps(df, by, order, ts).groupBy(*by).agg(F.max("step").alias("max_gap"), F.coalesce(F.max("step") > limit, F.lit(False)).alias("gap"))


def index_integrity(df: DataFrame, by: list[str], index: str, order: list, constant: str | None = None) -> DataFrame:
    """(by, n, ok): read in ``order``, that of the file, the index counts 0 to n - 1, and ``constant`` has one value.

    ``order`` must not be the index itself; readers.in_file_order gives the place of a row in its file.
    """
    r = df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    ok = F.count_if(~F.col(index).eqNullSafe(F.col("_r"))) == 0
    if constant:
        ok = ok & F.min(constant).eqNullSafe(F.max(constant)) & (F.count(constant) == F.count("*"))
    return r.groupBy(*by).agg(F.count("*").alias("n"), ok.alias("ok"))


def deviations(df: DataFrame, by: list[str], vector: str) -> DataFrame:
    """(by, dim, std): population deviation of each dimension."""
    return df.select(*by, F.posexplode(vector).alias("dim", "_v")).groupBy(*by, "dim").agg(F.stddev_pop(F.col("_v").cast("double")).alias("std"))


def feature_findings(features: DataFrame, expected: DataFrame) -> DataFrame:
    """(name, level, message) from comparing (name, dtype, dim) with what is expected; extra features are informational."""
    e = expected.select("name", F.col("dtype").alias("_dtype"), F.col("dim").alias("_dim"), F.lit(True).alias("_e"))
    both = features.withColumn("_f", F.lit(True)).join(e, "name", "full")
    message = (
        F.when(F.col("_f").isNull(), F.lit("missing"))
        .when(F.col("_e").isNull(), F.lit("extra"))
        .when(~F.col("dtype").eqNullSafe(F.col("_dtype")), F.concat(F.lit("dtype "), F.col("dtype"), F.lit(" instead of "), F.col("_dtype")))
        .when(~F.col("dim").eqNullSafe(F.col("_dim")), F.concat(F.lit("shape "), F.col("dim").cast("string"), F.lit(" instead of "), F.col("_dim").cast("string")))
        .otherwise(F.lit("ok"))
    )
    level = F.when(message == "ok", F.lit("SUCCESS")).when(message == "extra", F.lit("INFO")).otherwise(F.lit("ERROR"))
    return both.select("name", level.alias("level"), message.alias("message"))


def length_figures(lengths: DataFrame, n: str = "n", least: int = 10) -> DataFrame:
    """One row of shortest, longest and mean length, and whether the shortest is below ``least``."""
    return lengths.agg(F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).alias("mean"), (F.min(n) < least).alias("warned"))


def reconciled(left: DataFrame, right: DataFrame, name: str, times: int = 1) -> DataFrame:
    """(check, expected, found, ok) from two counts; both sides are single rows."""
    a, b = left.agg((F.count("*") * times).alias("expected")), right.agg(F.count("*").alias("found"))
    return a.join(b).select(F.lit(name).alias("check"), "expected", "found", (F.col("expected") == F.col("found")).alias("ok"))


def reconciled_episodes(lines: DataFrame, rows: DataFrame, videos: DataFrame, cameras: list[str]) -> DataFrame:
    """(episode_index, level, message): one row for each mismatch among metadata ``lines`` (episode_index, length), data
    ``rows`` (episode_index) and ``videos`` (episode_index, camera, frames; null frames are not compared).

    Named are episodes without a line, data or a camera's video, surplus lines and videos, videos of other cameras, and
    lengths that differ; videos are warnings, the rest errors. Each side is counted by episode, then all are put together
    in one grouping; an episode is a row of each, so no group is long.
    """
    none, kind = F.lit(None).cast("bigint"), lambda k: F.lit(k).alias("kind")
    meta = lines.groupBy("episode_index").agg(F.count("*").alias("n"), F.min("length").cast("bigint").alias("size")).select("episode_index", kind("meta"), "n", "size")
    data = rows.groupBy("episode_index").agg(F.count("*").alias("size")).select("episode_index", kind("data"), F.lit(1).cast("bigint").alias("n"), "size")
    film = videos.groupBy("episode_index", "camera").agg(F.count("*").alias("n"), F.min("frames").cast("bigint").alias("size")).select("episode_index", F.concat(F.lit("video "), "camera").alias("kind"), "n", "size")
    known = [f"video {c}" for c in cameras]
    of = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    strange = F.sort_array(F.collect_set(F.when(F.col("kind").startswith("video ") & ~F.col("kind").isin(known), F.col("kind"))))
    one = meta.unionByName(data).unionByName(film).groupBy("episode_index").agg(
        of("meta", "n").alias("lines"), of("meta", "size").alias("length"), of("data", "size").alias("rows"), strange.alias("strange"), *[f(k, c).alias(f"_{i}_{c}") for i, k in enumerate(known) for f, c in ((of, "n"), (of, "size"))]
    )
    text = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in x])
    row = lambda when, level, message: F.when(when, F.struct(F.lit(level).alias("level"), message.alias("message")))
    length = F.coalesce("length", "rows", none)
    checks = [
        row(F.col("lines").isNull(), "ERROR", text("no metadata line")),
        row(F.col("lines") > 1, "ERROR", text(F.col("lines"), " metadata lines")),
        row(F.col("rows").isNull(), "ERROR", text("no data file")),
        row(F.col("length") != F.col("rows"), "ERROR", text(F.col("rows"), " rows instead of ", F.col("length"))),
    ]
    for i, c in enumerate(cameras):
        n, size = F.col(f"_{i}_n"), F.col(f"_{i}_size")
        checks += [row(n.isNull(), "WARNING", text(f"no video of {c}")), row(n > 1, "WARNING", text(n, f" videos of {c}")), row(size != length, "WARNING", text(f"video of {c} has ", size, " frames instead of ", length))]
    other = F.transform("strange", lambda k: F.struct(F.lit("WARNING").alias("level"), F.concat(k, F.lit(" is not expected")).alias("message")))
    each = F.concat(F.filter(F.array(*checks), lambda f: f.isNotNull()), other)
    return one.select("episode_index", F.explode(each).alias("f")).select("episode_index", "f.*")


def keyword_share(docs: DataFrame, words: list[str], by: list[str], text: str = "text") -> DataFrame:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.lower(text).contains(w)
    return docs.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))


def roll_up(findings: DataFrame, first: int = 3) -> DataFrame:
    """(category, errors, warnings, compliant, messages): messages of errors, then warnings, the first few by order.

    ``findings`` has seq, level, category and message. Only the first messages of each category are gathered.
    """
    # categories stand in the order of their first finding
    rank = F.when(F.col("level") == "ERROR", 0).when(F.col("level") == "WARNING", 1).otherwise(2)
    w = Window.partitionBy("category").orderBy(rank, "seq")
    count = lambda level: F.count_if(F.col("level") == level)
    counts = findings.groupBy("category").agg(count("ERROR").alias("errors"), count("WARNING").alias("warnings"), (count("ERROR") == 0).alias("compliant"), F.min("seq").alias("_first"))
    # a filter on the row number limits each category before the shuffle, so no task sorts a whole category
    top = findings.select(F.col("category").alias("_c"), "message", F.row_number().over(w).alias("_k")).where(F.col("_k") <= first)
    lines = top.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct("_k", "message"))).alias("_kept"))
    messages = F.coalesce(F.array_join(F.transform("_kept", lambda x: x["message"]), "|"), F.lit(""))
    return counts.join(lines, F.col("category").eqNullSafe(F.col("_c")), "left").orderBy("_first").select("category", "errors", "warnings", "compliant", messages.alias("messages"))
