"""Short codes for vectors: one codebook for each of eight parts, trained by Elkan's form of Lloyd's rounds on integers.

Each row keeps, from round to round, an upper bound on the distance to its part's entry and a lower bound on the
distance to every entry. A round first shifts the bounds by how far the entries moved; an entry is passed over only if a
bound shows it strictly farther, and all others are settled by exact integer distances, ties going to the lower index.
So the result is that of plain rounds. Bounds are whole numbers (upper ones rounded up, lower ones down). Rows are never
shuffled: a round reads the state of the round before, writes its own to the shared folder, and adds up one small row of
sums a task; only the codebooks (8 x 16 entries) pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import join_hot, prepare, removed, shared_folder

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Below this, sums of squares of differences fit into 64 bits; larger components are worked out in Python's integers.
NARROW = 1 << 27
#: A lower bound may be held at LOW; an upper bound at FAR stands for any larger one.
LOW, FAR = 65_535, 1 << 62
MOST = (1 << 63) - 1

STATE = "id {id}, label {label}, v array<bigint>, near binary, upper array<bigint>, lower binary, sums array<string>"


def whole_numbers(vector: Column) -> Column:
    """floor(4096 * x) of each component; null for vectors that are null or empty, or hold a null, NaN or infinity, or cannot
    be cut into eight equal parts. Values beyond 2^62 are held there."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    floors = F.transform(x, lambda c: F.floor(F.greatest(F.lit(-(2.0**62)), F.least(F.lit(2.0**62), c * SCALE))).cast("bigint"))
    return F.when(~bad & (F.size(x) > 0) & (F.size(x) % PARTS == 0), floors)


def root_floor(x: np.ndarray) -> np.ndarray:
    """The largest whole numbers whose squares are at most ``x``."""
    if x.dtype == object:
        return np.frompyfunc(math.isqrt, 1, 1)(x)
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def root_ceil(x: np.ndarray) -> np.ndarray:
    r = root_floor(x)
    return r + (r * r < x)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis; exact."""
    d = a - b
    return (d * d).sum(axis=-1)


def settle(x: np.ndarray, book: np.ndarray, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Set each row of ``x`` (n, d) to its nearest entry of ``book`` (k, d), in place; the number of distances worked out.

    ``near`` (n) is the entry so far; ``upper`` (n) bounds its distance from above, ``lower`` (n, k) all from below.
    """
    own = np.arange(len(x))
    # an entry is farther than the own one if that lies more than twice the own distance away from it
    half = (np.minimum(root_floor(squared(book[:, None, :], book[None, :, :])), FAR).astype(np.int64) - 1) // 2
    open_ = (lower <= upper[:, None]) & (half[near] < upper[:, None])
    open_[own, near] = False
    at = np.flatnonzero(open_.any(axis=1))
    if not len(at):
        return 0
    exact = squared(x[at], book[near[at]])
    upper[at] = np.minimum(root_ceil(exact), FAR)
    lower[at, near[at]] = np.minimum(root_floor(exact), LOW)
    still = open_[at] & (lower[at] <= upper[at][:, None]) & (half[near[at]] < upper[at][:, None])
    i, j = np.nonzero(still)
    if not len(i):
        return len(at)
    found = squared(x[at[i]], book[j])
    lower[at[i], j] = np.minimum(root_floor(found), LOW)
    # the least (distance, index) of each row's entries, its own included
    rows, entry, far = np.concatenate([np.arange(len(at)), i]), np.concatenate([near[at], j]), np.concatenate([exact, found])
    order = sorted(range(len(rows)), key=lambda k: (rows[k], far[k], entry[k])) if far.dtype == object else np.lexsort((entry, far, rows))
    order = np.asarray(order)
    first = order[np.concatenate([[True], np.diff(rows[order]) > 0])]
    near[at] = entry[first]
    upper[at] = np.minimum(root_ceil(far[first]), FAR)
    return len(at) + len(i)


def one_round(book: np.ndarray, moved: np.ndarray | None, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task of one round: rows with their bounds shifted by ``moved`` (parts, k) and settled; then a row of sums.

    The ``last`` round gives codes and errors instead, and no sums.
    """
    parts, k, d = book.shape
    wide = bool(np.abs(book).max(initial=0) >= NARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros((parts, k, d), dtype=object), np.zeros((parts, k), dtype=np.int64)
        schema = None
        for batch in batches:
            n, schema = batch.num_rows, batch.schema
            if not n:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, d)
            kind = object if wide or np.abs(x).max() >= NARROW else np.int64
            values, entries = x.astype(kind), book.astype(kind)
            if moved is None:
                near, upper, lower = np.zeros((n, parts), np.int64), np.full((n, parts), FAR), np.zeros((n, parts, k), np.int64)
            else:
                near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                upper = batch.column("upper").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts)
                lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), "<u2").reshape(n, parts, k).astype(np.int64)
                upper = np.minimum(upper, FAR - 1) + moved[np.arange(parts), near]
                upper = np.minimum(upper, FAR)
                lower = np.maximum(lower - moved[None], 0)
            for p in range(parts):
                settle(values[:, p], entries[p], near[:, p], upper[:, p], lower[:, p])
            if last:
                error = squared(values, entries[np.arange(parts), near]).sum(axis=1)
                codes = [bytes(row).hex() for row in near.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes), pa.array([min(int(e), MOST) for e in error], pa.int64())], ["id", "label", "code", "error"])
                continue
            for p in range(parts):
                for e in np.unique(near[:, p]):
                    mine = near[:, p] == e
                    total[p, e] += values[mine, p].sum(axis=0).astype(object)
                    number[p, e] += int(mine.sum())
            packed = [
                batch.column("id"), batch.column("label"), batch.column("v"), pa.array([bytes(r) for r in near.astype(np.uint8)], pa.binary()),
                pa.array(list(upper), pa.list_(pa.int64())), pa.array([r.tobytes() for r in lower.astype("<u2")], pa.binary()), pa.nulls(n, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(packed, ["id", "label", "v", "near", "upper", "lower", "sums"])
        if number.any():
            sums = [str(s) for s in (*total.ravel(), *number.ravel())]
            kinds = [schema.field("id").type, schema.field("label").type, pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in kinds], pa.array([sums], pa.list_(pa.string()))], ["id", "label", "v", "near", "upper", "lower", "sums"])

    return run


def moved_entries(book: np.ndarray, total: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries at floor(sum / count) of their parts, unused ones as before, and how far each moved, rounded up."""
    new = book.astype(object)
    for p, e in zip(*np.nonzero(number), strict=True):
        new[p, e] = [int(s) // int(number[p, e]) for s in total[p, e]]
    moved = np.minimum(root_ceil(squared(new, book.astype(object))), FAR // 2).astype(np.int64)
    return new.astype(np.int64), moved


def added_up(state: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of all tasks; added by Spark, one row a place arrives."""
    parts, k, d = shape
    each = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("place", "s"))
    rows = each.groupBy("place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    flat = np.zeros(parts * k * (d + 1), dtype=object)
    for r in rows:
        flat[r["place"]] = int(r["s"])
    return flat[: parts * k * d].reshape(shape), flat[parts * k * d :].reshape(parts, k).astype(np.int64)


def first_book(kept: DataFrame) -> np.ndarray | None:
    """Codebooks of the parts of the first ENTRIES rows by id (then by vector; null ids never), None without a row.

    The first row tells how long vectors are; with fewer rows there are fewer entries."""
    ranked = kept.where("id IS NOT NULL").orderBy("id", "v").limit(ENTRIES)
    rows = ranked.collect()
    if rows and any(len(r["v"]) != len(rows[0]["v"]) for r in rows):
        rows = kept.where(F.col("id").isNotNull() & (F.size("v") == len(rows[0]["v"]))).orderBy("id", "v").limit(ENTRIES).collect()
    if not rows:
        return None
    x = np.array([r["v"] for r in rows], dtype=np.int64)
    return x.reshape(len(x), PARTS, -1).transpose(1, 0, 2)


def book_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in book.ravel()).encode()).hexdigest()


def vector_codes(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(id_column, code, error, label_error, codebooks_sha256), one row for each vector that can be coded.

    Null vectors and those with null or non-finite components are dropped; so are empty ones, ones that eight does not
    divide and ones of another length than the vector of the smallest id. Repeated rows are rows of their own; rows with
    a null id are coded but never start a codebook (if all ids are null, nothing is returned). Errors beyond 2^63 - 1 are
    held there. Other columns of ``rows`` do not matter.
    """
    spark = rows.sparkSession
    prepare(spark)
    kept = rows.select(F.col(id_column).alias("id"), F.col(label).alias("label"), whole_numbers(F.col(vector)).alias("v")).where("v IS NOT NULL")
    kind = {c: kept.schema[c].dataType.simpleString() for c in ("id", "label")}
    names = [F.col("id").alias(id_column), "code", "error"]
    book = first_book(kept)
    if book is None:
        return kept.limit(0).select(F.col("id").alias(id_column), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    state = kept.where(F.size("v") == book.shape[0] * book.shape[2])
    folder, moved, before = f"{shared_folder(spark)}/codes-{uuid.uuid4().hex}", None, None
    for k in range(rounds):
        state.mapInArrow(one_round(book, moved, False), STATE.format(**kind)).write.parquet(f"{folder}/{k}")
        if before:
            removed(spark, before)
        before, state = f"{folder}/{k}", spark.read.parquet(f"{folder}/{k}")
        total, number = added_up(state, book.shape)
        book, moved = moved_entries(book, total, number)
        state = state.where("sums IS NULL")
    coded = state.mapInArrow(one_round(book, moved, True), f"id {kind['id']}, label {kind['label']}, code string, error bigint")
    coded.write.parquet(f"{folder}/codes")
    if before:
        removed(spark, before)
    coded = spark.read.parquet(f"{folder}/codes").withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null")))
    sums = coded.groupBy("_label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    sums = sums.select("_label", F.least(F.col("s"), F.lit(MOST).cast("decimal(38,0)")).cast("bigint").alias("label_error"), "n")
    joined = join_hot(coded, sums.select("_label", "label_error"), "_label", sums.select("_label", "n"), coded.count())
    return joined.select(*names, "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"))
