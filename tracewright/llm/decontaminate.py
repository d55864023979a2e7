"""Benchmark passages in documents, found by Wu-Manber search over words.

A window is ten consecutive words of a benchmark item, or a shorter item whole. For each length of window there is one
search: a shift table over hashed blocks of two words tells how far the search may move on, buckets by the hash of the
last block and of the window select the windows that may stand at a place, and their bytes are compared with the text.
Documents are cut into lanes of word places that a numpy loop moves along together, each lane by its own shifts.

The windows are a query set: they go to the executors in blocks of at most BLOCK windows, and documents pass through one
block after the other, so memory does not grow with the benchmark. Documents are never shuffled or cut; a task holds the
text of CHUNK bytes, or one longer text, at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import ascii_lower, batches_then_release, prepare

WINDOW = 10
#: Windows searched for in one pass over the documents.
BLOCK = 200_000
#: Word places of one lane; bits of the shift table's index, beyond those of the number of windows.
LANE, SPARE_BITS = 256, 6
#: Bytes of text that are split into words at a time (one text may be longer).
CHUNK = 1 << 22
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_P_INVERSE = pow(_P, -1, 1 << 64)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window): the distinct windows of items, words joined by a space. Null texts and those without words have none."""
    words = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(WORD), F.lit(0))
    w = items.select(F.col(item_id).cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    each = w.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("window"))
    return each.distinct()


def powers(n: int, base: int) -> np.ndarray:
    """base^0 ... base^(n-1), modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of many texts, end to end: place in ``raw`` (lower-cased bytes), hash, and first word of each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        """Text i is raw[offsets[i]:offsets[i + 1]]."""
        self.raw = _LOWER[raw]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = _IS_WORD[self.raw]
        step = np.diff(inside)
        # a word that runs up to the end of one text ends there, though the next may go on with word bytes
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(raw))]
        cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
        self.start = np.sort(np.concatenate([np.flatnonzero(step == 1), cut]))
        self.end = np.sort(np.concatenate([np.flatnonzero(step == -1), cut]))
        self.first = np.searchsorted(self.start, offsets)  # len(texts) + 1 entries
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """A polynomial of a word's bytes, modulo 2^64, whatever its place."""
        n = len(self.raw)
        sums = np.zeros(n + 1, np.uint64)
        sums[1:] = np.add.accumulate((self.raw.astype(np.uint64) + np.uint64(1)) * powers(n, _P))
        total = (sums[self.end] - sums[self.start]) * powers(n + 1, _P_INVERSE)[self.start]
        total ^= total >> np.uint64(31)
        return (total + (self.end - self.start).astype(np.uint64)) * np.uint64(_Q)


def rolled(hashes: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that end at each of ``ends``."""
    out = np.zeros(len(ends), np.uint64)
    for back in range(k - 1, -1, -1):
        out = out * np.uint64(_P) + (hashes[ends - back] ^ (hashes[ends - back] >> np.uint64(29)))
    return out


class Search:
    """Windows of ``k`` words each (bytes, words joined by a space), and the tables of their search."""

    def __init__(self, windows: list[bytes], numbers: list[int], k: int):
        """``numbers`` are the windows' own, given back by ``found``."""
        self.k, self.block = k, min(2, k)
        text = b"\n".join(windows)
        offsets = np.cumsum([0, *[len(w) + 1 for w in windows]])
        offsets[-1] -= 1
        words = Words(np.frombuffer(text, np.uint8), offsets)
        last = words.first[1:] - 1
        self.bits = len(windows).bit_length() + SPARE_BITS
        # how far to move on where a block of words ends: as far as no window can have it
        self.shift = np.full(1 << self.bits, k - self.block + 1, np.uint8)
        for back in range(k - self.block, -1, -1):
            at = self.slots(words.hash, last - back)
            self.shift[at] = np.minimum(self.shift[at], back)
        # buckets: by the slot of the last block, then by the hash of the window
        slot, whole = self.slots(words.hash, last), rolled(words.hash, last, k)
        order = np.lexsort((whole, slot))
        self.whole, self.windows, self.numbers = whole[order], [windows[i] for i in order], np.asarray(numbers)[order]
        self.bucket = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def slots(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place in the shift table of the block that ends at each of ``ends``."""
        return (rolled(hashes, ends, self.block) >> np.uint64(64 - self.bits)).astype(np.int64)

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, int]:
        """(last word, number) of every occurrence of a window within one text, and how many places were looked at."""
        size = np.diff(words.first)
        ends = np.maximum(size - (self.k - 1), 0)  # places where a window may end
        lanes = -(-ends // LANE)
        text = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        here = words.first[text] + (self.k - 1) + nth * LANE
        stop = np.minimum(here + LANE, words.first[text + 1])
        looked, hits = 0, []
        while len(here):
            looked += len(here)
            slot = self.slots(words.hash, here)
            move = self.shift[slot].astype(np.int64)
            stay = move == 0
            if stay.any():
                hits.append((here[stay], slot[stay]))
            here = here + np.maximum(move, 1)
            on = here < stop
            here, stop = here[on], stop[on]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), looked
        at, slot = (np.concatenate(x) for x in zip(*hits, strict=True))
        at, number = self.confirmed(words, at, slot)
        return at, number, looked

    def confirmed(self, words: Words, at: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places ``at``, those where a window of the slot's bucket really stands, and its number."""
        whole = rolled(words.hash, at, self.k)
        low, high = self.bucket[slot].astype(np.int64), self.bucket[slot + 1].astype(np.int64)
        # the first window of the bucket whose hash is not below, for all places at once by halving
        first, last = low.copy(), high.copy()
        while (open_ := first < last).any():
            middle = (first + last) // 2
            below = open_ & (self.whole[np.minimum(middle, len(self.whole) - 1)] < whole)
            first, last = np.where(below, middle + 1, first), np.where(open_ & ~below, middle, last)
        places, numbers = [], []
        raw, k = words.raw, self.k
        seen: dict[tuple[int, bytes], bool] = {}
        same_hash = (first < high) & (self.whole[np.minimum(first, len(self.whole) - 1)] == whole)
        for i in np.flatnonzero(same_hash):
            for j in range(first[i], high[i]):
                if self.whole[j] != whole[i]:
                    break
                s, e = words.start[at[i] - k + 1 : at[i] + 1], words.end[at[i] - k + 1 : at[i] + 1]
                span = raw[s[0] : e[-1]].tobytes()
                same = seen.get((j, span))
                if same is None:
                    base = int(s[0])
                    same = seen[j, span] = b" ".join(span[a - base : b - base] for a, b in zip(s.tolist(), e.tolist(), strict=True)) == self.windows[j]
                if same:
                    places.append(at[i])
                    numbers.append(self.numbers[j])
        return np.asarray(places, np.int64), np.asarray(numbers, np.int64)


class Matcher:
    """All windows of one block: a search for each length, and the items of each window."""

    def __init__(self, rows: list[tuple[str, list[str | None]]]):
        """(window, its items) of each distinct window."""
        self.items = [sorted({i for i in items if i is not None}) for _, items in rows]
        by: dict[int, list[int]] = {}
        for n, (window, _) in enumerate(rows):
            by.setdefault(window.count(" ") + 1, []).append(n)
        self.searches = [Search([rows[n][0].encode() for n in ns], ns, k) for k, ns in sorted(by.items())]

    def scan(self, words: Words) -> tuple[np.ndarray, list[set[str]], int]:
        """For each word whether it is hit; for each text the items found in it; places looked at."""
        edge = np.zeros(len(words.start) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(words.first) - 1)]
        looked = 0
        for search in self.searches:
            at, number, n = search.found(words)
            looked += n
            np.add.at(edge, at - search.k + 1, 1)
            np.add.at(edge, at + 1, -1)
            pairs = np.unique(np.stack([np.searchsorted(words.first, at, "right") - 1, number]), axis=1)
            for t, w in pairs.T.tolist():
                items[t].update(self.items[w])
        return np.cumsum(edge)[:-1] > 0, items, looked


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (start, end), end exclusive."""
    step = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(step[::2].tolist(), step[1::2].tolist(), strict=True))


def united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


FOUND = "_words bigint, _spans array<struct<start: bigint, stop: bigint>>, _items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts, nulls as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def one_pass(matcher_value, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that adds what one block of windows finds to the columns of FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_value.value
        for batch in batches_then_release(batches):
            raw, offsets = texts_of(batch.column(text))
            before_spans, before_items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
            counts, spans, items = [], [], []
            t, n = 0, batch.num_rows
            while t < n:
                # as many texts as CHUNK bytes hold, one at least
                to = max(t + 1, int(np.searchsorted(offsets, offsets[t] + CHUNK, "right")) - 1)
                words = Words(raw[offsets[t] : offsets[to]], offsets[t : to + 1] - offsets[t])
                hit, found, _ = matcher.scan(words)
                for i in range(to - t):
                    here = hit[words.first[i] : words.first[i + 1]]
                    old = [(s["start"], s["stop"]) for s in before_spans[t + i]]
                    new = spans_of(here) if here.any() else []
                    counts.append(len(here))
                    spans.append([{"start": a, "stop": b} for a, b in (united(old, new) if old else new)])
                    items.append(sorted(found[i].union(before_items[t + i])))
                t = to
            out = [c for k, c in enumerate(batch.columns) if batch.schema.names[k] not in ("_words", "_spans", "_items")]
            names = [c for c in batch.schema.names if c not in ("_words", "_spans", "_items")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))], [*names, "_words", "_spans", "_items"])

    return run


def occurrences(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` plus _words (their number), _spans (word places inside occurrences, as disjoint runs) and _items (distinct
    ids of the items with occurring windows, as texts, in order).

    Null and empty texts have no words; items without words have no windows; windows of items with a null id hit words
    but name no item. Repeated items count once. Columns of ``docs`` of the three names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    windows = item_windows(items, item_id, item_text)
    blocks = max(1, -(-windows.count() // block))
    out = docs.drop("_words", "_spans", "_items").withColumns({"_words": F.lit(0).cast("bigint"), "_spans": F.array().cast("array<struct<start: bigint, stop: bigint>>"), "_items": F.array().cast("array<string>")})
    for b in range(blocks):
        # a pair of window and item has one block, so neither many windows nor a window of many items fills one
        mine = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b).collect()
        by: dict[str, list[str | None]] = {}
        for r in mine:
            by.setdefault(r["window"], []).append(r["item"])
        matcher = spark.sparkContext.broadcast(Matcher(sorted(by.items())))
        out = out.mapInArrow(one_pass(matcher, text), out.schema)
    return out


def without_passages(docs: DataFrame, items: DataFrame, most: float = 0.0) -> DataFrame:
    """``docs`` whose share of hit words is at most ``most``; wordless documents stay. Same columns."""
    found = occurrences(docs, items)
    return found.where(n_hit() <= F.col("_words") * most).select(*docs.columns)


def n_hit() -> Column:
    return F.aggregate("_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``docs``, repeated or not."""
    found = occurrences(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), items)
    digest = F.sha2(F.array_join("_items", ",").cast("binary"), 256)
    return found.select("doc_id", F.col("_words").alias("n_words"), n_hit().alias("n_hit"), F.size("_items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"))

