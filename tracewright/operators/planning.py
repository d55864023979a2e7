"""Episode discovery, annotations, plans, numbering, splits and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import names as N
from tracewright.schema import ACTION_SUBDIRS

ANNOTATION = "action STRING, affordance_range STRUCT<start: STRING, end: STRING>"


def episodes(files: DataFrame, need_images: bool = True) -> DataFrame:
    """Directories (episode_id) of a listing (episode_id, entry) that hold ``ee_csv.csv`` and, if asked, ``left_img_dir``."""
    has = lambda n: F.bool_or(F.col("entry") == n)
    found = files.groupBy("episode_id").agg(has("ee_csv.csv").alias("_csv"), has("left_img_dir").alias("_left"))
    return found.where(F.col("_csv") & (F.col("_left") | F.lit(not need_images))).select("episode_id")


def complete_runs(listing: DataFrame, by: list[str], member: str, needed: list[str]) -> DataFrame:
    """Groups that hold all of ``needed``."""
    return listing.where(F.col(member).isin(needed)).groupBy(*by).agg(F.count_distinct(member).alias("_n")).where(F.col("_n") == len(needed)).select(*by)


def validated(listing: DataFrame, by: list[str], member: str, needed: list[str], separator: str = "; ") -> DataFrame:
    """(by, valid, message): the message lists what is missing, in the order of ``needed``."""
    found = listing.groupBy(*by).agg(F.collect_set(F.when(F.col(member).isin(needed), F.col(member))).alias("_has"))  # a set of len(needed) at most
    missing = F.filter(F.array(*[F.lit(n) for n in needed]), lambda n: ~F.array_contains("_has", n))
    return found.select(*by, (F.size(missing) == 0).alias("valid"), F.array_join(F.transform(missing, lambda n: F.concat(F.lit("missing "), n)), separator).alias("message"))


def parsed_annotations(raw: DataFrame, text: str = "value") -> DataFrame:
    """``raw`` plus action, start and end of its JSON; rows that are unreadable or lack a whole range go."""
    a = F.from_json(F.col(text), ANNOTATION, {"mode": "PERMISSIVE"})
    out = raw.withColumn("_a", a)
    out = out.withColumn("action", F.lower(F.trim(F.coalesce("_a.action", F.lit("unknown")))))
    out = out.withColumn("start", F.col("_a.affordance_range.start").try_cast("int")).withColumn("end", F.col("_a.affordance_range.end").try_cast("int"))
    return out.where("start IS NOT NULL AND end IS NOT NULL").drop("_a")


def action_subdir(action: Column) -> Column:
    """Numbered directory of an action; unknown actions stay as they are."""
    out = action
    for name, numbered in ACTION_SUBDIRS.items():
        out = F.when(action == name, F.lit(numbered)).otherwise(out)
    return out


def annotation_files(paths: DataFrame, path: str = "path") -> DataFrame:
    name = F.lower(F.element_at(F.split(F.col(path), "/"), -1))
    return paths.where(name.endswith(".json") & ~name.endswith("_prompt.json"))


def numbered_episodes(df: DataFrame, by: list[str], order: list[str], name: str = "episode_no", base: int = 1) -> DataFrame:
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + (base - 1)).cast("bigint"))


def action_numbers(df: DataFrame, action: str = "action") -> DataFrame:
    """(action, numbered): distinct actions in order as ``1_a``, ``2_b``; there are few, so one small task orders them."""
    w = Window.orderBy(action)
    return df.select(action).distinct().withColumn("numbered", F.concat(F.row_number().over(w).cast("string"), F.lit("_"), F.col(action)))


def resolved_paths(wanted: DataFrame, candidates: list[tuple[Column, str]], existing: DataFrame, path: str = "path") -> DataFrame:
    """``wanted`` with the first of its candidate paths that exists; rows without one go."""
    out = wanted
    for i, (column, _) in enumerate(candidates):
        seen = existing.select(F.col(path).alias(f"_c{i}")).distinct()
        out = out.withColumn(f"_w{i}", column).join(seen, F.col(f"_w{i}") == F.col(f"_c{i}"), "left")
    first = F.coalesce(*[F.col(f"_c{i}") for i in range(len(candidates))])
    return out.withColumn("resolved", first).where("resolved IS NOT NULL").drop(*[f"_{k}{i}" for k in "cw" for i in range(len(candidates))])


def clamped_ends(plan: DataFrame, frames: DataFrame, by: list[str], camera: str = "camera") -> DataFrame:
    """``plan`` with end held within the shortest camera, and n_frames; plans without a frame go."""
    shortest = frames.groupBy(*by, camera).agg(F.count("*").alias("_k")).groupBy(*by).agg(F.min("_k").alias("shortest"))
    out = plan.join(shortest, by).withColumn("end", F.least(F.col("end"), F.col("shortest") - 1))
    return out.withColumn("n_frames", F.col("end") - F.col("start") + 1).where("n_frames > 0")


def splits(n: Column, perfect: Column, recovery: Column) -> list[Column]:
    """train, val, test, perfect and recovery as ``from:to`` of n episodes."""
    span = lambda a, b: F.concat(a.cast("string"), F.lit(":"), b.cast("string"))
    zero, train = F.lit(0).cast("bigint"), F.floor(n * F.lit(0.8)).cast("bigint")
    val = train + F.floor(n * F.lit(0.1)).cast("bigint")
    return [span(zero, train).alias("train"), span(train, val).alias("val"), span(val, n).alias("test"), span(zero, perfect).alias("perfect"), span(perfect, perfect + recovery).alias("recovery")]


def split_label(index: Column, n: Column) -> Column:
    train = F.floor(n * F.lit(0.8))
    return F.when(index < train, F.lit("train")).when(index < train + F.floor(n * F.lit(0.1)), F.lit("val")).otherwise(F.lit("test"))


def positions(df: DataFrame, by: list[str], order: list[str], bucket: Column | None = None, name: str = "position", count: str | None = None) -> DataFrame:
    """``df`` with the place (from 0) of each row in its group's order, and the group's number of rows as ``count``.

    A group may hold most of all rows: ``bucket`` rises with the first of ``order`` and cuts groups into parts. Rows are
    numbered within (group, bucket), and start behind the rows of the buckets before, of which there is one row each.
    """
    cut = df.withColumn("_bucket", F.lit(0) if bucket is None else bucket)
    sizes = cut.groupBy(*by, "_bucket").agg(F.count("*").alias("_k"))
    before = F.sum("_k").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first("_bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_k")
    starts = sizes.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_bucket").alias("_at"), before.alias("_start"), F.sum("_k").over(Window.partitionBy(*by)).alias("_total"))
    same = F.col("_bucket").eqNullSafe(F.col("_at"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    own = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)) - 1
    out = cut.withColumn("_own", own).join(starts, same).withColumn(name, (F.col("_start") + F.col("_own")).cast("bigint"))
    out = out.withColumn(count, F.col("_total")) if count else out
    return out.drop("_bucket", "_own", "_start", "_total", "_at", *[f"_by_{c}" for c in by])


def every_kth(df: DataFrame, by: list[str], order: list[str], parts: int = 10, bucket: Column | None = None) -> DataFrame:
    """Every max(1, n // parts)-th row of each group: all rows below ``parts``, else ``parts`` up to twice that, less one."""
    placed = positions(df, by, order, bucket, "_r", "_n")
    return placed.where(F.col("_r") % F.greatest(F.lit(1), F.floor(F.col("_n") / parts)) == 0).drop("_r", "_n")


def evenly_spaced(df: DataFrame, by: list[str], order: list[str], points: int = 6, bucket: Column | None = None) -> DataFrame:
    """Rows at the truncated positions of min(points, n) evenly spaced places from first to last."""
    rows = positions(df, by, order, bucket, "_r", "_n")
    k = F.least(F.lit(points), F.col("_n"))
    places = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.when(k == 1, F.lit(0)).otherwise(F.floor(i * (F.col("_n") - 1) / (k - 1))).cast("bigint"))
    return rows.where(F.array_contains(places, F.col("_r"))).drop("_r", "_n")


def copy_manifest(matched: DataFrame, left: str, cameras: dict[str, tuple[str, str]], op: str = "link") -> DataFrame:
    """(left name, camera, src, dst, op) of the left frame and of each camera's (name column, time column) in ``matched``."""
    rows = [F.struct(F.lit("left").alias("camera"), F.col(left).alias("src"), F.col(left).alias("dst"))]
    for camera, (name, ts) in cameras.items():
        rows.append(F.struct(F.lit(camera).alias("camera"), F.col(name).alias("src"), N.renamed_secondary(F.col(left), F.lit(camera), F.col(ts)).alias("dst")))
    return matched.select("*", F.explode(F.array(*rows)).alias("_m")).select(*matched.columns, "_m.*", F.lit(op).alias("op"))


def looked_up(names: DataFrame, index: DataFrame, key: str, value: str) -> DataFrame:
    """``names`` plus the ``value`` that ``index`` has for ``key``; a name that is not there raises an error."""
    must = F.when(F.col("_there"), F.col(value)).otherwise(F.raise_error(F.concat(F.lit("not in the index: "), F.col(key).cast("string"))))
    return names.join(index.select(key, value, F.lit(True).alias("_there")), key, "left").withColumn(value, must).drop("_there")


def not_done(plan: DataFrame, done: DataFrame, by: list[str]) -> DataFrame:
    """Plans without a result yet."""
    return plan.join(done.select(*by).distinct(), by, "left_anti")


def run_figures(runs: DataFrame, least: int) -> DataFrame:
    """One row of total, valid and synced runs and of images in the synced ones, from (valid, n) of each run."""
    good = F.col("valid") & (F.col("n") >= least)
    return runs.agg(F.count("*").alias("total"), F.count_if("valid").alias("valid"), F.count_if(good).alias("synced"), F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).cast("bigint").alias("images"))


def skipped_runs(runs: DataFrame, least: int) -> DataFrame:
    """The runs that run_figures does not count as synced, one row each."""
    return runs.where(~(F.col("valid") & (F.col("n") >= least)))


def merged_runs(runs: list[tuple[str, DataFrame]], order: list[str], bucket: Column | None = None) -> DataFrame:
    """Rows of all runs under one header with run number and position; a run with another header is an error."""
    first = runs[0][1].columns
    out = None
    for i, (name, df) in enumerate(runs):
        if df.columns != first:
            raise ValueError(f"run {name}: its header differs from the first run's")
        part = df.withColumn("run_no", F.lit(i).cast("bigint")).withColumn("run", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return positions(out, ["run_no", "run"], order, bucket)
