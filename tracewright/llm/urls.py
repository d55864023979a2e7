"""URL filters: host rules, and a character language-model ratio for urls that no rule decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import ascii_lower, broadcast_if_small, checkpointed, join_hot, prepare

# The rules, as (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

#: 64 symbols: 0 before a url's first character, letters of either case, digits, these marks, then any other ASCII
#: character and any other byte.
MARKS = "/.-_%?=&~:+,;@#!$'()*[]| "
BITS = 6
SYMBOLS = 1 << BITS
#: Longest context in characters, and the order of the part of the model that is a dense array (SYMBOLS ** (BASE + 1) cells);
#: longer contexts are a table with a row for each that occurs, so the model grows with the urls.
ORDER, BASE = 8, 2
#: Decided urls whose hash leaves 0 modulo this calibrate the threshold; the others teach.
CALIBRATE = 4
#: Bins of the calibration histogram over length-normalised differences, which reach from -SPAN to SPAN; a difference is
#: kept as a whole number of parts, so that sums do not depend on their order.
BINS, SPAN, PARTS = 400, 4.0, 1 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url and one without ``://``."""
    whole = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.when(url.contains("://"), F.regexp_extract(url, whole, i)).otherwise(F.lit(""))
    return ascii_lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path the url's path starts with, else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _table() -> np.ndarray:
    out = np.full(256, SYMBOLS - 1, np.int64)
    out[:128] = SYMBOLS - 2
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789" + MARKS):
        out[ord(c)] = out[ord(c.upper())] = i + 1
    return out


_TABLE = _table()


def windows(url: str) -> np.ndarray:
    """For each character of the url after its scheme: its symbol in the lowest bits, above it the ORDER symbols before it."""
    raw = url.split("://", 1)[-1].encode("utf-8", "replace")
    c = np.concatenate([np.zeros(ORDER, np.int64), _TABLE[np.frombuffer(raw, np.uint8)]])
    out = c[ORDER:].copy()
    for k in range(1, ORDER + 1):
        out |= c[ORDER - k : len(c) - k] << (BITS * k)
    return out


def _lower(w: np.ndarray, order: int) -> np.ndarray:
    """The windows with no more than ``order`` symbols of context."""
    return w & ((1 << BITS * (order + 1)) - 1)


def _mix(total: np.ndarray, kinds: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Witten-Bell: a context's own counts and the shorter context's estimate, mixed by its number of different followers.
    A context never seen falls back to the shorter one: the order varies with the evidence."""
    return np.where(total > 0, (n + kinds * lower) / np.maximum(total + kinds, 1), lower)


def base_probabilities(counts: np.ndarray) -> np.ndarray:
    """P(symbol | up to BASE symbols before it) of each cell, a window of order BASE."""
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(BASE + 1):
        n = counts.reshape(-1, SYMBOLS ** (order + 1)).sum(axis=0).reshape(-1, SYMBOLS).astype(float)
        lower = p if order == 0 else np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS, 1))
        p = _mix(n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True), n, np.broadcast_to(lower, n.shape))
    return p.ravel()


def probabilities(w: np.ndarray, n: np.ndarray, base: np.ndarray) -> np.ndarray:
    """P(symbol | up to ORDER symbols before it) of each distinct window ``w`` with count ``n``.

    All windows whose contexts end in the same BASE + 1 symbols must be there.
    """
    p = base[_lower(w, BASE)]
    for order in range(BASE + 1, ORDER + 1):
        gram, of_gram = np.unique(_lower(w, order), return_inverse=True)
        held = np.bincount(of_gram, n, len(gram))
        context, of_context = np.unique(gram >> BITS, return_inverse=True)
        total = np.bincount(of_context, held, len(context))[of_context]
        kinds = np.bincount(of_context, held > 0, len(context))[of_context]
        p = _mix(total[of_gram], kinds[of_gram], held[of_gram], p)
    return p


def counted_windows(rows: DataFrame) -> DataFrame:
    """(w, rejected, accepted) of each window that occurs in ``rows`` (url, kind: 1 accepted, 0 rejected, null neither)."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [windows(u) for u in batch["url"]]
            if not found:
                continue
            kind = np.repeat(batch["kind"].fillna(-1).to_numpy(np.int64), [len(f) for f in found])
            w, of = np.unique(np.concatenate(found), return_inverse=True)
            yield pd.DataFrame({"w": w, "r": np.bincount(of, kind == 0, len(w)).astype(np.int64), "a": np.bincount(of, kind == 1, len(w)).astype(np.int64)})

    return rows.mapInPandas(run, "w long, r long, a long").groupBy("w").agg(F.sum("r").alias("rejected"), F.sum("a").alias("accepted"))


def train(rows: DataFrame) -> DataFrame | None:
    """(w, difference) of each window in ``rows`` (url, kind): ln P(accepted) - ln P(rejected), in PARTS; null without both kinds.

    The counts are one table. Its part of order BASE, SYMBOLS ** (BASE + 1) cells at most, is an array; the longer
    contexts are dealt by their last BASE + 1 symbols, and each task works out its own.
    """
    spark = rows.sparkSession
    counts = checkpointed(counted_windows(rows))
    cells = counts.groupBy(F.col("w").bitwiseAND(F.lit(SYMBOLS ** (BASE + 1) - 1)).alias("cell")).agg(F.sum("rejected").alias("r"), F.sum("accepted").alias("a")).toPandas()
    dense = np.zeros((2, SYMBOLS ** (BASE + 1)))
    dense[:, cells["cell"].to_numpy(np.int64)] = cells[["r", "a"]].to_numpy(float).T
    if not dense.any(axis=1).all():
        return None
    shared = spark.sparkContext.broadcast([base_probabilities(d) for d in dense])  # 4 MB, whatever the input

    def worked(part: pd.DataFrame) -> pd.DataFrame:
        w = part["w"].to_numpy(np.int64)
        r, a = (probabilities(w, part[k].to_numpy(float), base) for k, base in zip(("rejected", "accepted"), shared.value, strict=True))
        return pd.DataFrame({"w": w, "difference": np.rint((np.log(a) - np.log(r)) * PARTS).astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # windows of the last context, of which the next batch may have more
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = int(np.searchsorted(held["context"].to_numpy(), held["context"].iloc[-1])) if len(held) else 0
            if last:
                yield worked(held.iloc[:last])
                held = held.iloc[last:]
        if held is not None and len(held):
            yield worked(held)

    context = F.shiftright("w", BITS).bitwiseAND(F.lit(SYMBOLS ** (BASE + 1) - 1))
    dealt = counts.withColumn("context", context).repartition("context").sortWithinPartitions("context")
    return checkpointed(dealt.mapInPandas(run, "w long, difference long"))


def with_ratio(rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` plus ratio of the column url: the mean difference of its characters (0 without any; null for null).

    Each distinct url is scored once. Its windows are joined to the model, which is broadcast if small; windows that very
    many urls hold are joined by broadcast in any case.
    """
    prepare(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["_uid"]].assign(ws=[windows(u) for u in batch["url"]])

    keyed = rows.withColumn("_uid", F.xxhash64("url"))
    texts = keyed.where(F.col("url").isNotNull()).groupBy("_uid").agg(F.first("url").alias("url"))
    held = texts.mapInPandas(run, "_uid long, ws array<long>").select("_uid", F.explode("ws").alias("w"))
    small = broadcast_if_small(model)
    if small is model:
        held = checkpointed(held)
        counts = checkpointed(held.groupBy("w").agg(F.count("*").alias("n")))
        both = join_hot(held, model, "w", counts, held.count())
    else:
        both = held.join(small, "w")
    means = both.groupBy("_uid").agg((F.sum("difference") / F.count("*") / PARTS).alias("_mean"))
    scored = keyed.join(means, "_uid", "left")
    return scored.withColumn("ratio", F.when(F.col("url").isNotNull(), F.coalesce("_mean", F.lit(0.0)))).drop("_uid", "_mean")


def calibrate(scored: DataFrame) -> float:
    """Threshold on ratio between the kinds: least sum of the shares on the wrong side, in the middle of equal ones."""
    bin_ = F.least(F.greatest(F.floor((F.col("ratio") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    table = np.zeros((2, BINS))
    for r in scored.groupBy("kind", bin_.alias("bin")).count().collect():  # at most 2 * BINS rows
        table[r["kind"], r["bin"]] = r["count"]
    share = table / np.maximum(table.sum(axis=1, keepdims=True), 1)
    wrong = np.concatenate([[0], np.cumsum(share[1])]) + 1 - np.concatenate([[0], np.cumsum(share[0])])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(best[len(best) // 2] / BINS * 2 * SPAN - SPAN)


def judged_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, ratio) for each row of ``pages``.

    Of the urls that a rule decides some teach the two models and the others, chosen by a hash, calibrate the threshold.
    All urls are scored, and the score decides where no rule does. Null urls, and all undecided ones where the rules
    decide no url of one kind, are allowed, as there is nothing to hold against them. Repeated rows each come back; an
    empty table gives an empty result; other columns are not looked at.
    """
    url = F.col("url")
    host, path = host_and_path(url)
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r for v, r in rules if v == "allow"])
    rows = rows.withColumn("kind", F.when(F.col("rule").isNotNull(), allowed.cast("int")))
    # copies count as often as they come, and stay on one side of the calibration as they have one hash
    held_back = F.pmod(F.xxhash64("url"), F.lit(CALIBRATE)) == 0
    some = rows.where("url IS NOT NULL")
    model = train(some.select("url", F.when(~held_back, F.col("kind")).alias("kind")))
    if model is None:
        scored, least = rows.withColumn("ratio", F.lit(None).cast("double")), 0.0
    else:
        scored = checkpointed(with_ratio(rows, model))
        least = calibrate(scored.where(F.col("kind").isNotNull() & F.col("ratio").isNotNull() & held_back))
    method = F.when(F.coalesce(F.col("ratio") >= least, F.lit(True)), F.lit("allow")).otherwise(F.lit("block"))
    verdict = F.when(F.col("kind") == 1, F.lit("allow")).when(F.col("kind") == 0, F.lit("block")).otherwise(method)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "ratio")
