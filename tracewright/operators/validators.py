"""Rules of a whole dataset as one table of findings (seq, category, level, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators import quality
from tracewright.schema import FPS
from tracewright.sources import metadata

# What a dataset must hold.
FOLDERS = ("videos", "meta", "data")
METADATA = ("info.json", "episodes.jsonl", "tasks.jsonl")
README = "README.md"
FEATURES = ("action", "observation.state")
IMAGE_PREFIX, LEAST_HEIGHT, LEAST_WIDTH = "observation.images.", 480, 480
META_PATTERNS = ("observation.meta", "meta.tool", "instrument", "tissue")
COLUMNS = ("episode_index", "frame_index", "timestamp")
SYNC_WORDS = ("synchron", "timestamp")
#: Below this a dimension does not vary, and below STATIONARY (mean of all deviations) nothing does.
STILL, STATIONARY = 1e-8, 1e-6
#: Longest step between rows, in frames; fewest rows of an episode.
MOST_STEPS, LEAST_ROWS = 2, 10


def finding(category: str, level: Column | str, message: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(F.lit(category).alias("category"), lit(level).alias("level"), lit(message).alias("message"))


def judged(ok: Column, category: str, name: str, good: str, bad: str, level: str = "ERROR") -> Column:
    return finding(category, F.when(ok, F.lit("SUCCESS")).otherwise(F.lit(level)), F.when(ok, F.lit(f"{name} {good}")).otherwise(F.lit(f"{name} {bad}")))


def _rows(df: DataFrame, findings: list[Column]) -> DataFrame:
    """The findings of each row that are not null, one row each."""
    each = F.filter(F.array(*findings), lambda f: f.isNotNull())
    return df.select(F.explode(each).alias("f")).select("f.*")


def structure(entries: DataFrame) -> DataFrame:
    """Findings of a listing (path, is_dir): required folders, chunks and episode files."""
    has = lambda p: F.coalesce(F.bool_or((F.col("path") == p) & F.col("is_dir")), F.lit(False))
    chunk, episode = F.col("path").rlike("^data/chunk-[^/]*$") & F.col("is_dir"), F.col("path").rlike(r"^data/chunk-[^/]*/episode_[^/]*\.parquet$") & ~F.col("is_dir")
    one = entries.agg(*[has(p).alias(p) for p in FOLDERS], F.count_if(chunk).alias("chunks"), F.count_if(episode).alias("files"))
    found = [judged(F.col(p), "structure", p, "is there", "is missing") for p in FOLDERS]
    data = (
        F.when(~F.col("data"), F.lit(None))
        .when(F.col("chunks") == 0, finding("structure", "ERROR", "no chunk folders"))
        .when(F.col("files") == 0, finding("structure", "ERROR", "no episode files"))
        .otherwise(finding("structure", "SUCCESS", F.concat(F.col("files").cast("string"), F.lit(" episode files in "), F.col("chunks").cast("string"), F.lit(" chunks"))))
    )
    return _rows(one, [*found, data])


def metadata_files(entries: DataFrame) -> DataFrame:
    """Findings of a listing: the metadata files and the README."""
    has = lambda p: F.coalesce(F.bool_or((F.col("path") == f"meta/{p}") & ~F.col("is_dir")), F.lit(False))
    names = (*METADATA, README)
    one = entries.agg(*[has(p).alias(f"_{i}") for i, p in enumerate(names)])
    return _rows(one, [judged(F.col(f"_{i}"), "metadata", p, "is there", "is missing") for i, p in enumerate(names)])


def splits(info: DataFrame, text: str = "value") -> DataFrame:
    """Findings of info documents: standard splits, and the ones of perfect, recovery and failure examples as information;
    a document without any split gets one warning instead."""
    j = metadata.parsed(info, text).where("_j._bad IS NULL")
    has = lambda s: F.coalesce(F.map_contains_key("_j.splits", s), F.lit(False))
    some = F.coalesce(F.size(F.map_keys("_j.splits")) > 0, F.lit(False))
    none = F.when(~some, finding("splits", "WARNING", "no splits"))
    standard = [F.when(some, judged(has(s), "splits", f"split {s}", "defined", "missing", "WARNING")) for s in ("train", "val", "test")]
    recovery = F.when(some, judged(has("recovery"), "splits", "split recovery", "defined", "would add robustness", "INFO"))
    extra = [F.when(has(s), finding("splits", "INFO", f"split {s} defined")) for s in ("perfect", "failure")]
    return _rows(j, [none, *standard, recovery, *extra])


def image_features(names: Column, prefix: str = IMAGE_PREFIX) -> Column:
    return F.filter(names, lambda n: n.startswith(prefix))


def meta_features(names: Column, patterns: tuple[str, ...] = META_PATTERNS) -> Column:
    """Names that hold one of the patterns, each once, in their order."""
    return F.filter(names, lambda n: reduce(lambda a, b: a | b, [n.contains(p) for p in patterns]))


def features(info: DataFrame, text: str = "value") -> DataFrame:
    """Findings of info documents' features: required names, image names and sizes, domain metadata."""
    j = metadata.parsed(info, text).where("_j._bad IS NULL AND _j.features IS NOT NULL").withColumn("names", F.array_sort(F.map_keys("_j.features")))
    required = [judged(F.array_contains("names", n), "features", n, "is there", "is missing") for n in FEATURES]
    none = F.when(F.size(image_features(F.col("names"))) == 0, finding("features", "WARNING", f"no feature starts with {IMAGE_PREFIX}"))
    meta = F.array_join(F.slice(meta_features(F.col("names")), 1, 3), ", ")
    domain = F.when(meta != "", finding("features", "SUCCESS", F.concat(F.lit("domain metadata: "), meta))).otherwise(finding("features", "INFO", "no domain metadata"))
    images = j.select(F.explode(F.map_filter("_j.features", lambda n, _: n.startswith(IMAGE_PREFIX))).alias("name", "f"))
    h, w = F.get("f.shape", F.lit(0)), F.get("f.shape", F.lit(1))
    small = F.concat(F.col("name"), F.lit(" is "), h.cast("string"), F.lit("x"), w.cast("string"))
    of_images = _rows(images, [F.when(F.col("f.dtype") == "video", finding("images", "SUCCESS", F.concat("name", F.lit(" is video")))), F.when((h < LEAST_HEIGHT) | (w < LEAST_WIDTH), finding("images", "WARNING", small))])
    return _rows(j, [*required, none, domain]).unionByName(of_images)


def still_dimensions(rows: DataFrame, vector: str) -> DataFrame:
    """(still, mean_std) of a table: dimensions that do not vary, and the mean of all deviations; one row."""
    return quality.deviations(rows.withColumn("_all", F.lit(0)), ["_all"], vector).agg(F.count_if(F.col("std") < STILL).alias("still"), F.avg("std").alias("mean_std"))


def variation(rows: DataFrame, vector: str) -> DataFrame:
    """A warning if the mean deviation is near zero, else if a dimension does not vary."""
    one = still_dimensions(rows, vector)
    near_zero, some = F.col("mean_std") < STATIONARY, F.col("still") > 0
    message = F.when(near_zero, F.lit(f"{vector} hardly varies at all")).when(some, F.concat(F.col("still").cast("string"), F.lit(f" dimensions of {vector} do not vary"))).otherwise(F.lit(f"{vector} varies"))
    return _rows(one, [finding("variation", F.when(near_zero | some, F.lit("WARNING")).otherwise(F.lit("SUCCESS")), message)])


def tasks(lines: DataFrame, text: str = "value") -> DataFrame:
    """Findings of episode lines: whether tasks are named, how many, and how many are recoveries."""
    named = metadata.parsed_lines(lines, text).where("readable").select(F.explode("task_list").alias("task")).distinct()
    one = named.agg(F.count("*").alias("n"), F.count_if(F.lower("task").contains("recovery")).alias("r"))
    count = F.when(F.col("n") == 0, finding("tasks", "WARNING", "no task is named")).otherwise(finding("tasks", "SUCCESS", F.concat(F.col("n").cast("string"), F.lit(" tasks"))))
    return _rows(one, [count, F.when(F.col("r") > 0, finding("tasks", "SUCCESS", F.concat(F.col("r").cast("string"), F.lit(" recovery tasks"))))])


def synchronization(info: DataFrame, readme: DataFrame, text: str = "value") -> DataFrame:
    """Findings of the info document's tolerance_s and of what the README says about synchronisation."""
    tolerance = F.get_json_object(F.col(text), "$.tolerance_s")
    stated = _rows(info, [F.when(tolerance.isNotNull(), finding("synchronization", "SUCCESS", F.concat(F.lit("tolerance "), tolerance, F.lit("s"))))])
    said = reduce(lambda a, b: a | b, [F.lower(F.col(text)).contains(w) for w in SYNC_WORDS])
    return stated.unionByName(_rows(readme, [judged(F.coalesce(said, F.lit(False)), "synchronization", "README", "describes it", "does not describe it", "WARNING")]))


def columns(rows: DataFrame) -> DataFrame:
    """A warning for each of COLUMNS that the data lack; needs the schema only."""
    lost = [c for c in COLUMNS if c not in rows.columns]
    return rows.sparkSession.createDataFrame([("columns", "WARNING", f"column {c} missing") for c in lost] or [("columns", "SUCCESS", "all columns are there")], "category string, level string, message string")


def order_of(parts: list[DataFrame]) -> DataFrame:
    """All parts under one seq that follows the parts and, within one, category, level and message."""
    numbered = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered).select(F.struct("_part", "category", "level", "message").alias("seq"), "category", "level", "message")


def counted(n: Column, category: str, what: str, level: str) -> Column:
    """``level`` with the number of cases if there is one, else a success."""
    return finding(category, F.when(n > 0, F.lit(level)).otherwise(F.lit("SUCCESS")), F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {what}"))).otherwise(F.lit(f"no {what}")))


def info(documents: DataFrame, text: str = "value") -> DataFrame:
    """Findings of the info documents' own rules: readable, frame rate, robot and splits."""
    found = metadata.info_findings(documents.withColumn("id", F.lit(0)), text)
    return found.select(F.lit("info").alias("category"), "level", F.when(F.col("message") == "", F.lit("info is complete")).otherwise(F.col("message")).alias("message"))


def schema(documents: DataFrame, expected: DataFrame, text: str = "value") -> DataFrame:
    """Findings of the info documents' features against the ``expected`` (name, dtype, dim): type and first dimension."""
    j = metadata.parsed(documents, text).where("_j._bad IS NULL AND _j.features IS NOT NULL")
    each = j.select(F.explode("_j.features").alias("name", "f")).select("name", "f.dtype", F.get("f.shape", F.lit(0)).alias("dim"))
    found = quality.feature_findings(each, expected)
    return found.select(F.lit("schema").alias("category"), "level", F.concat("name", F.lit(": "), "message").alias("message"))


def values(rows: DataFrame, vectors: list[str]) -> DataFrame:
    """Findings of state and action vectors, in one pass over all rows: not finite, orientations of other length than 1,
    jaws out of bounds, for each arm."""
    checks, columns = [], []
    for v in vectors:
        for what, level, bad in (
            (f"rows of {v} with a value that is not finite", "ERROR", quality.not_finite(F.col(v))),
            *[(f"rows of {v} with an orientation of arm {a + 1} that is not of length 1", "WARNING", quality.norm_off(F.col(v), a)) for a in (0, 1)],
            *[(f"rows of {v} with a jaw of arm {a + 1} out of bounds", "WARNING", quality.jaw_off(F.col(v), a)) for a in (0, 1)],
        ):
            checks.append(F.count_if(bad).alias(f"_{len(checks)}"))
            columns.append(counted(F.col(f"_{len(columns)}"), "values", what, level))
    return _rows(rows.agg(*checks), columns)


def times(rows: DataFrame, fps: float, episode: str = "episode_index", index: str = "frame_index", time: str = "timestamp") -> DataFrame:
    """Findings of the rows' times and indices by episode: steps that do not rise or are long, indices that do not count
    from 0, episodes that are short."""
    step = quality.steps(rows, [episode], [index], time)
    e = step.groupBy(episode).agg(
        F.count("*").alias("n"), F.count_if(F.col("step") <= 0).alias("back"), F.coalesce(F.max("step") > MOST_STEPS / fps, F.lit(False)).alias("gap"),
        ((F.min(index) == 0) & (F.max(index) == F.count("*") - 1) & (F.count_distinct(index) == F.count("*"))).alias("counts"),
    )
    one = e.agg(F.count_if(F.col("back") > 0).alias("back"), F.count_if("gap").alias("gap"), F.count_if(~F.coalesce("counts", F.lit(False))).alias("counts"), F.count_if(F.col("n") < LEAST_ROWS).alias("short"))
    return _rows(one, [counted(F.col("back"), "times", "episodes whose time does not rise", "ERROR"), counted(F.col("gap"), "times", "episodes with a long step", "WARNING"), counted(F.col("counts"), "times", "episodes whose index does not count from 0", "ERROR"), counted(F.col("short"), "times", f"episodes of fewer than {LEAST_ROWS} rows", "WARNING")])


def reconciliation(lines: DataFrame, rows: DataFrame, videos: DataFrame, cameras: list[str], text: str = "value") -> DataFrame:
    """Findings of quality.reconciled_episodes, each naming its episode, or one success."""
    known = metadata.parsed_lines(lines, text).where("readable").select("episode_index", "length")
    found = quality.reconciled_episodes(known, rows.select("episode_index"), videos, cameras)
    each = found.select(F.lit("episodes").alias("category"), "level", F.concat(F.lit("episode "), F.coalesce(F.col("episode_index").cast("string"), F.lit("without number")), F.lit(": "), "message").alias("message"))
    fine = found.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("episodes").alias("category"), F.lit("SUCCESS").alias("level"), F.lit("lines, data and videos agree").alias("message"))
    return each.unionByName(fine)


def all_findings(entries: DataFrame, info_documents: DataFrame, lines: DataFrame, readme: DataFrame, rows: DataFrame, action: str = "action") -> DataFrame:
    """The rules of a dataset's listing, info document, episode lines and README, and of the variation of its rows; see
    ``every_finding`` for the rest."""
    return order_of([structure(entries), metadata_files(entries), splits(info_documents), features(info_documents), tasks(lines), synchronization(info_documents, readme), columns(rows), variation(rows, action)])


def every_finding(entries: DataFrame, info_documents: DataFrame, lines: DataFrame, readme: DataFrame, rows: DataFrame, videos: DataFrame, expected: DataFrame, cameras: list[str], vectors: list[str], action: str = "action", fps: float = FPS) -> DataFrame:
    """Every rule over one dataset: those of all_findings, the info document's own and its features against the
    ``expected`` ones, the values and times of all rows, and the reconciliation of lines, rows and ``videos`` by episode."""
    parts = [
        structure(entries), metadata_files(entries), info(info_documents), splits(info_documents), features(info_documents), schema(info_documents, expected), tasks(lines),
        synchronization(info_documents, readme), columns(rows), variation(rows, action), values(rows, vectors), times(rows, fps), reconciliation(lines, rows, videos, cameras),
    ]
    return order_of(parts)
