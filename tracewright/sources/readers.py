"""Kinematics, annotations and datasets as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.schema import MOTION_COLUMNS, SYNTHETIC_STEP_NS, plain, timestamp_column

#: Number types from narrow to wide; files may differ by them in one column.
NUMBERS = ("int", "bigint", "double")


def relative_folder(path: Column, root: str | None) -> Column:
    """A file's folder below ``root``, as listings name episodes; without a root the folder's own name."""
    if root is None:
        return F.regexp_extract(path, "([^/]+)/[^/]*$", 1)
    root = root.split("://", 1)[-1].rstrip("/") + "/"
    below = F.substring(plain_path(path), F.instr(plain_path(path), root) + len(root), F.length(plain_path(path)))
    return F.regexp_replace(below, "/?[^/]*$", "")


def plain_path(path: Column) -> Column:
    """A path as Spark's metadata names it, without the escapes of a URL."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def cells(line: Column) -> Column:
    """The cells of one line of CSV as texts, quotes taken off; a blank line has none. A quoted cell may hold commas and
    doubled quotes, but no line break; a quote that is not closed stands for itself."""
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit('("[^"]*+(?:""[^"]*+)*+"|[^,]*+),'), F.lit(1))
    bare = F.transform(found, lambda c: F.when((F.length(c) > 1) & c.startswith('"') & c.endswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.length(line) == 0, F.array().cast("array<string>")).otherwise(bare)


def _splits(df: DataFrame) -> DataFrame:
    """``df``, as read from files, with _file, the start of its _block in it, and _at, which rises along a block."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the place (from 0) of each row in its file as ``name``.

    Files are read in blocks, each in order by one task: rows are counted for each block, and a row's place is the rows of
    the blocks before its own and its place there. The rows are not shuffled; counts are one row a block, broadcast.
    """
    sizes = df.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return df.join(F.broadcast(starts), ["_file", "_block"]).withColumn(name, (F.col("_before") + F.col("_at") - F.col("_first")).cast("bigint")).drop("_before", "_first")


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line, value): the lines of text files with their numbers from 1, over all blocks of a file."""
    rows = _numbered(_splits(spark.read.text(paths)), "_line")
    return rows.select(plain_path(F.col("_file")).alias("path"), (F.col("_line") + 1).alias("line"), "value")


def raw_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line, cells): the rows of CSV files as they are, headers and blank lines included, each a list of texts.

    Rows may be of any width and differ in it. Line breaks within quotes are not supported.
    """
    return numbered_lines(spark, paths).select("path", "line", cells(F.col("value")).alias("cells"))


@contextmanager
def _set(spark: SparkSession, **conf: str) -> Iterator[None]:
    old = {k: spark.conf.get(k) for k in (n.replace("__", ".") for n in conf)}
    for k, v in conf.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _first_row(batches: Iterator) -> Iterator:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def headers(spark: SparkSession, paths: str | list[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """(column names, files) of each layout among CSV files. Of each block of a file one small batch is read; files
    without a line are left out. The driver gets the names of the files, as it does for any read."""
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # as dear to open as a full partition is to read: one block a task, which stops behind its first rows
    with _set(spark, spark__sql__files__openCostInBytes=most, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        first = lines.mapInArrow(_first_row, "value string, file string, at bigint").where("at = 0")
        found = first.groupBy(cells(F.col("value")).alias("names")).agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted((tuple(r["names"]), [unquote(f) for f in r["files"]]) for r in found)


def distinct_names(names: tuple[str, ...]) -> list[str]:
    """``names`` with .1, .2 behind repeated ones."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        out.append(f"{n}.{seen[n]}" if n in seen else n)
        seen[n] = seen.get(n, 0) + 1
    return out


def motion_samples(spark: SparkSession, paths: str | list[str], root: str | None = None) -> DataFrame:
    """As kinematics, but of the motion columns that are there only, as doubles; others are not parsed."""
    return kinematics(spark, paths, root, MOTION_COLUMNS)


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with _file and _row, their place in the file."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def kinematics(spark: SparkSession, paths: str | list[str], root: str | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """CSV samples with episode_id (the file's folder below ``root``), kin_idx, ts_ns and sanitised names.

    Each file is read by its own header: columns may stand in any order, and be missing (null) or more than elsewhere.
    Number types of one column are widened; text in one file and numbers in another raise ValueError. With ``columns``
    only those and the time are read, as doubles and whole numbers. ts_ns is the file's first column whose name holds
    ``time`` or ``stamp``, with its own type; without one the samples are 30 Hz apart from 0. Samples are numbered in
    the order of their file. Files without a line give nothing; if all are so, ValueError is raised.
    """
    layouts = [(distinct_names(names), files) for names, files in headers(spark, paths)]
    if not layouts:
        raise ValueError("no file has a header")
    parts = [_of_layout(spark, names, files, root, columns) for names, files in layouts]
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for c, kind in p.dtypes:
            kinds.setdefault(c, set()).add(kind)
    out = None
    for p in parts:
        for c, kind in p.dtypes:
            wide = _widest(c, {k for k in kinds[c] if k != "void"})
            p = p.withColumn(c, F.col(f"`{c}`").cast(wide)) if wide and wide != kind else p
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    last = ["episode_id", "kin_idx", "ts_ns"]
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in last], *last)


def _widest(column: str, kinds: set[str]) -> str | None:
    if kinds <= set(NUMBERS):
        return max(kinds, key=NUMBERS.index, default=None)
    if len(kinds) > 1:
        raise ValueError(f"column {column} has values of different types: {', '.join(sorted(kinds))}")
    return next(iter(kinds))


def _of_layout(spark: SparkSession, names: list[str], files: list[str], root: str | None, columns: tuple[str, ...] | None) -> DataFrame:
    """Samples of the files of one header. Columns without a value have no type (void)."""
    text = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    schema = spark.createDataFrame([], text).schema
    if columns is None:
        guessed = spark.read.csv(files, header=True, inferSchema=True, escape='"')
        schema = guessed.schema if len(guessed.columns) == len(names) else schema
        for f, n in zip(schema.fields, names, strict=True):
            f.name = n
    df = spark.read.csv(files, header=True, schema=schema, escape='"')
    time = timestamp_column(names)
    if columns is None:
        texts = [f.name for f in schema.fields if f.dataType.simpleString() == "string"]
        # a column of texts may have no value at all: then it fits any type
        held = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(texts)]).first() if texts else []
        empty = {c for c, n in zip(texts, held, strict=True) if n == 0}
        read = [(F.lit(None) if c in empty else F.col(f"`{c}`")).alias(plain(c)) for c in names]
    else:
        read = [F.col(f"`{c}`").try_cast("bigint" if c == time else "double").alias(plain(c)) for c in names if c in columns or c == time]
    rows = _numbered(_splits(df).select(*read, relative_folder(F.col("_file"), root).alias("episode_id"), "_file", "_block", "_at"), "kin_idx").drop("_file", "_block", "_at")
    return rows.withColumn("ts_ns", F.col(f"`{plain(time)}`") if time else F.col("kin_idx") * SYNTHETIC_STEP_NS)


def annotations(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of the annotation files under ``root``: .json in any case, but not prompts."""
    from tracewright.operators.planning import annotation_files

    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(root)
    return annotation_files(raw.select(F.col("_metadata.file_path").alias("path"), "value"))


def dataset(spark: SparkSession, root: str, episode: int | None = None, chunk: int = 1000) -> DataFrame:
    """Rows of a dataset in the published layout; of one episode only its own file is opened."""
    return spark.read.parquet(f"{root}/data/chunk-*/episode_*.parquet" if episode is None else f"{root}/data/chunk-{episode // chunk:03d}/episode_{episode:06d}.parquet")


def episodes_of(spark: SparkSession, root: str, episodes: list[int], chunk: int = 1000) -> DataFrame:
    """Rows of the named episodes; no other file is opened, and one that is not there raises an error."""
    return spark.read.parquet(*[f"{root}/data/chunk-{e // chunk:03d}/episode_{e:06d}.parquet" for e in episodes])


def sampled_dataset(spark: SparkSession, root: str, parts: int = 10) -> DataFrame:
    """Rows of every max(1, n // parts)-th episode file in order of their paths, chosen from the listing: the others are
    not opened. Without episode files ValueError is raised."""
    from tracewright.sources.listing import listed

    files = listed(spark, f"{root}/data").where("NOT is_dir AND depth = 2").where(F.col("path").rlike(r"^chunk-[^/]*/episode_[^/]*\.parquet$"))
    names = [r["path"] for r in files.select("path").orderBy("path").collect()]
    if not names:
        raise ValueError(f"no episode files below {root}")
    return spark.read.parquet(*[f"{root}/data/{n}" for n in names[:: max(1, len(names) // parts)]])


def binary_images(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
