"""JSON metadata: info documents, line-wise episodes, task labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.schema import FPS

INFO = "fps DOUBLE, robot_type STRING, chunks_size INT, splits MAP<STRING, STRING>, features MAP<STRING, STRUCT<dtype: STRING, shape: ARRAY<INT>>>, _bad STRING"
EPISODE = "episode_index INT, length INT, tasks STRING, task STRING, _bad STRING"
SPLITS = ("test", "train", "val")
LEAST_FPS, ROBOT = 20, "dvrk"


def parsed(df: DataFrame, text: str = "value") -> DataFrame:
    """``df`` plus its info document as _j."""
    return _parsed(df, INFO, text)


def _parsed(df: DataFrame, schema: str, text: str) -> DataFrame:
    return df.withColumn("_j", F.from_json(F.col(text), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))


def info_findings(df: DataFrame, text: str = "value") -> DataFrame:
    """(id, level, message) of info documents: unreadable ones are errors, rule breaks are warnings."""
    j = _parsed(df, INFO, text)
    checks = [
        F.when(F.coalesce(F.col("_j.fps"), F.lit(0.0)) < LEAST_FPS, F.lit(f"fps below {LEAST_FPS}")),
        F.when(F.coalesce(F.col("_j.robot_type"), F.lit("")) != ROBOT, F.lit(f"robot_type is not {ROBOT}")),
        *[F.when(~F.coalesce(F.map_contains_key("_j.splits", s), F.lit(False)), F.lit(f"split {s} missing")) for s in SPLITS],
    ]
    message = F.when(F.col("_j._bad").isNotNull(), F.lit("unreadable")).otherwise(F.concat_ws("; ", *checks))
    level = F.when(message == "unreadable", F.lit("ERROR")).when(message == "", F.lit("SUCCESS")).otherwise(F.lit("WARNING"))
    return j.select("id", level.alias("level"), message.alias("message"))


def video_features(df: DataFrame, text: str = "value") -> DataFrame:
    """fps (default 30), chunk size (default 1000) and the sorted names of video features of info documents."""
    j = _parsed(df, INFO, text)
    keys = F.array_sort(F.map_keys(F.map_filter("_j.features", lambda _, f: f["dtype"] == "video")))
    return j.select("*", F.coalesce("_j.fps", F.lit(float(FPS))).alias("fps"), F.coalesce("_j.chunks_size", F.lit(1000)).alias("chunk_size"), keys.alias("video_keys")).drop("_j")


def parsed_lines(df: DataFrame, text: str = "value") -> DataFrame:
    """Non-blank JSON lines with readable, episode_index, length and tasks (an array, from a list, a text or ``task``)."""
    j = _parsed(df.where(F.trim(F.col(text)) != ""), EPISODE, text)
    listed = F.from_json(F.col("_j.tasks"), "array<string>")
    one = F.coalesce(F.col("_j.tasks"), F.col("_j.task"))
    tasks = F.when(F.col("_j.tasks").startswith("["), listed).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<string>"))
    return j.select("*", F.col("_j._bad").isNull().alias("readable"), "_j.episode_index", "_j.length", tasks.alias("task_list")).drop("_j")


def line_findings(lines: DataFrame) -> DataFrame:
    """(path, line, level, message): an error for each line (path, line, value) that is no JSON object or lacks an
    episode_index; blank lines are none."""
    j = parsed_lines(lines)
    wrong = F.when(~F.col("readable"), F.lit("unreadable")).when(F.col("episode_index").isNull(), F.lit("no episode_index"))
    message = F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(": "), wrong)
    return j.where(wrong.isNotNull()).select("path", "line", F.lit("ERROR").alias("level"), message.alias("message")).orderBy("path", "line")


def distinct_tasks(df: DataFrame, by: list[str], tasks: str = "tasks") -> DataFrame:
    """(by, tasks, n_tasks): distinct labels in order, joined. Labels are few: they are made distinct before they are gathered."""
    each = df.select(*by, F.explode(tasks).alias("_task")).distinct()
    return each.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("_task")), ", ").alias("tasks"), F.count("*").alias("n_tasks"))
