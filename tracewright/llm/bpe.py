"""Byte-level BPE: pre-tokenisation by class arrays and transition-function scans, cached merging, exact decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import KEPT, batches_then_release, prepare

# Codepoint classes.
LETTER, NUMBER, MARK, SPACE, BLANK = range(5)  # BLANK is U+0020, SPACE any other white space
# Symbols of the automaton: classes with what their neighbours decide, and the end of a text.
SYM_LETTER, SYM_NUMBER, SYM_MARK, SYM_SHORT, SYM_LONG, SYM_SPACE, SYM_LAST_SPACE, SYM_BLANK, SYM_LAST_BLANK, SYM_END = range(10)
# States: after a text's start or a token that is over; inside runs; a blank that joins what follows; in contractions.
FRESH, IN_LETTER, IN_NUMBER, IN_MARK, IN_SPACE, LEAD, ONE_MORE, TWO_MORE = range(8)
#: Columns of the blocks that are scanned at once.
BLOCK = 64
#: Longest slice that is cached, and cached slices of one worker at most.
CACHE_BYTES, CACHE = 48, 120_000
#: Table of the pairs: 2 to the TABLE places; a multiplicative hash; marks of an empty place and of a pair without a rank.
TABLE, HASH, EMPTY, NONE = 20, np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFF), np.int32(2**31 - 1)
# White space of the pattern's \s.
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of each codepoint, from the Unicode general categories."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(i))[0], MARK) for i in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE)] = SPACE
    out[0x20] = BLANK
    return out


@lru_cache(1)
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next[symbol, state], starts[symbol, state]): a token starts at a character where starts is true."""
    nxt, starts = np.zeros((10, 8), np.uint8), np.zeros((10, 8), bool)
    run = {SYM_LETTER: IN_LETTER, SYM_NUMBER: IN_NUMBER, SYM_MARK: IN_MARK}
    for s in range(8):
        inside = s in (ONE_MORE, TWO_MORE)
        after = FRESH if s == ONE_MORE else ONE_MORE
        for symbol, state in run.items():
            nxt[symbol, s] = after if inside else state
            starts[symbol, s] = not inside and s not in (state, LEAD)
        for symbol, state in ((SYM_SHORT, ONE_MORE), (SYM_LONG, TWO_MORE)):
            # an apostrophe opens a contraction only where a token may start; after a blank or a mark it is a mark
            nxt[symbol, s] = IN_MARK if s in (IN_MARK, LEAD) else state
            starts[symbol, s] = s not in (IN_MARK, LEAD)
        nxt[SYM_SPACE, s] = nxt[SYM_BLANK, s] = IN_SPACE
        starts[SYM_SPACE, s] = starts[SYM_BLANK, s] = s != IN_SPACE
        # the last of a run of white space before other text stands alone, a blank joins what follows
        nxt[SYM_LAST_SPACE, s], nxt[SYM_LAST_BLANK, s] = FRESH, LEAD
        starts[SYM_LAST_SPACE, s] = starts[SYM_LAST_BLANK, s] = True
        nxt[SYM_END, s], starts[SYM_END, s] = FRESH, True
    return nxt, starts


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbol of each character of texts laid end to end; ``ends`` marks one separator after each text."""
    kind = classes()[codes]
    follow = np.append(kind[1:], MARK)
    last = np.append(ends[1:], True)  # the next place is a separator
    white = kind >= SPACE
    before_text = white & ~last & (follow < SPACE)
    out = np.array([SYM_LETTER, SYM_NUMBER, SYM_MARK, SYM_SPACE, SYM_BLANK], np.uint8)[kind]
    out[before_text & (kind == SPACE)] = SYM_LAST_SPACE
    out[before_text & (kind == BLANK)] = SYM_LAST_BLANK
    at = np.flatnonzero((codes == 0x27) & ~ends)
    if len(at):
        padded = np.concatenate([codes, [0, 0]])
        sealed = np.concatenate([ends, [True, True]])
        one, two = np.where(sealed[at + 1], 0, padded[at + 1]), np.where(sealed[at + 1] | sealed[at + 2], 0, padded[at + 2])
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = SYM_SHORT
        pair = one.astype(np.int64) << 32 | two.astype(np.int64)
        out[at[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = SYM_LONG
    out[ends] = SYM_END
    return out


def scan(symbol: np.ndarray, state: int = FRESH) -> np.ndarray:
    """State before each character. Transition functions compose associatively: each block's function is built up
    column by column for all blocks at once, the blocks' functions are scanned in the same way, and the states inside
    the blocks follow from their first ones."""
    nxt, n = transitions()[0], len(symbol)
    if n <= BLOCK:
        out = np.empty(n, np.uint8)
        for i, s in enumerate(symbol):
            out[i] = state
            state = nxt[s, state]
        return out
    padded = np.full(-(-n // BLOCK) * BLOCK, SYM_END, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(-1, BLOCK).T)
    maps = np.tile(np.arange(8, dtype=np.uint8), (columns.shape[1], 1))
    flat = nxt.ravel()
    for column in columns:
        maps = np.take(flat, (column * np.uint8(8))[:, None] + maps)
    first = scan_maps(maps, state)
    out = np.empty(columns.shape, np.uint8)
    for i, column in enumerate(columns):
        out[i] = first
        first = flat[column * np.uint8(8) + first]
    return out.T.ravel()[:n]


def scan_maps(maps: np.ndarray, state: int) -> np.ndarray:
    """State before each of the functions ``maps`` (rows of 8 states), by doubling over pairs."""
    n = len(maps)
    if n <= BLOCK:
        out = np.empty(n, np.uint8)
        for i in range(n):
            out[i] = state
            state = maps[i, state]
        return out
    even, odd = maps[0 : n - n % 2 : 2], maps[1::2]
    pairs = np.take_along_axis(odd, even.astype(np.intp), axis=1)
    if n % 2:
        pairs = np.concatenate([pairs, maps[-1:]])
    heads = scan_maps(pairs, state)
    out = np.empty(n, np.uint8)
    out[0::2] = heads
    out[1::2] = even[np.arange(len(even)), heads[: len(even)]]
    return out


def slices(texts: list[str]) -> list[tuple[bytes, list[int]]]:
    """(bytes, offsets) of each text: slice i is bytes[offsets[i]:offsets[i + 1]]."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(lengths + 1) - 1
    ends = np.zeros(len(codes), bool)
    ends[stops] = True
    symbol = symbols(codes, ends)
    start = transitions()[1][symbol, scan(symbol)]
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.cumsum(width) - width  # byte offset of each character, separators included
    found = np.flatnonzero(start)
    borders = np.searchsorted(found, np.concatenate([[0], stops + 1]))
    begins = np.concatenate([[0], stops + 1])
    out = []
    for i, text in enumerate(texts):
        own = at[found[borders[i] : borders[i + 1]]] - at[begins[i]]
        out.append((text.encode("utf-8", "surrogatepass"), own.tolist()))
    return out


class Vocabulary:
    """Ranks of a tiktoken file; the ids of a slice are those of merging its lowest-ranked neighbours first."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        parts = [b""] * size
        for token, rank in self.ranks.items():
            parts[rank] = token
        self.parts = parts
        ranks = self.ranks
        # (left id << 20 | right id) -> id of the pair, for each way to cut a token into two tokens
        pairs = {ranks[t[:i]] << 20 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self._fill(pairs)
        self.bytes = np.array([ranks[bytes((i,))] for i in range(256)], np.int32)
        self.cache: dict[bytes, tuple[list[int], str]] = {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where they do not merge: open addressing, all probes of a round at once."""
        key = left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)
        slot = key * HASH >> np.uint64(64 - TABLE)
        out = np.full(len(key), NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (held != EMPTY)]
            slot[todo] = (slot[todo] + np.uint64(1)) & np.uint64((1 << TABLE) - 1)
        return out

    def _fill(self, pairs: dict[int, int]) -> None:
        key = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.keys, self.values = np.full(1 << TABLE, EMPTY, np.uint64), np.zeros(1 << TABLE, np.int32)
        slot, todo = key * HASH >> np.uint64(64 - TABLE), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == EMPTY]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = key[put], value[put]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + np.uint64(1)) & np.uint64((1 << TABLE) - 1)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of non-empty slices of like length: in each round every slice merges its lowest-ranked pair."""
        n, width = len(pieces), max(map(len, pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        place = np.arange(width)
        inside = place < sizes[:, None]
        ids = np.zeros((n, width), np.int32)
        ids[inside] = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        near = np.full((n, width), NONE, np.int32)
        pair = np.zeros((n, width), bool)
        pair[:, :-1] = inside[:, 1:]
        row, col = np.nonzero(pair)
        near[row, col] = self.ranks_of(ids[row, col], ids[row, col + 1])
        after = np.tile(place + 1, (n, 1)).astype(np.int16)
        before = np.tile(place - 1, (n, 1)).astype(np.int16)
        rows = np.arange(n)
        while len(rows):
            at = near[rows].argmin(axis=1)
            low = near[rows, at]
            go = low != NONE
            rows, at, low = rows[go], at[go], low[go]
            if not len(rows):
                break
            gone = after[rows, at]
            end = after[rows, gone]
            ids[rows, at] = low
            inside[rows, gone], near[rows, gone], near[rows, at] = False, NONE, NONE
            after[rows, at] = end
            k = np.flatnonzero(end < sizes[rows])
            before[rows[k], end[k]] = at[k]
            near[rows[k], at[k]] = self.ranks_of(low[k], ids[rows[k], end[k]])
            prior = before[rows, at]
            k = np.flatnonzero(prior >= 0)
            near[rows[k], prior[k]] = self.ranks_of(ids[rows[k], prior[k]], low[k])
        flat, stop = ids[inside].tolist(), np.cumsum(inside.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *stop], stop)]  # noqa: B905

    def learn(self, pieces: list[bytes]) -> None:
        """Put slices into the cache, those of like length together."""
        pieces.sort(key=len)
        for i in range(0, len(pieces), 8192):
            part = pieces[i : i + 8192]
            for piece, found in zip(part, self.merge_many(part), strict=True):
                self.cache[piece] = (found, ",".join(map(str, found)))

    def merge(self, piece: bytes) -> list[int]:
        """A heap of neighbouring pairs, so that long slices cost n log n."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        stop, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            if not alive[i] or stop[i] != middle or middle >= n or not alive[middle] or stop[middle] != end:
                continue
            alive[middle], stop[i] = False, end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, end, stop[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, i, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : stop[i]]])
            i = stop[i]
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[int], str, list[int]]]:
        """(ids, decimal form, byte offsets of the slices) of each text."""
        cut = []
        for raw, offsets in slices(texts):
            cut.append(([raw[a:b] for a, b in zip(offsets, [*offsets[1:], len(raw)], strict=True) if a < b], offsets))
        if len(self.cache) > CACHE:
            self.cache.clear()
        fresh = set().union(*(pieces for pieces, _ in cut)).difference(self.cache)
        long = {p for p in fresh if len(p) > CACHE_BYTES}
        self.learn(list(fresh - long))
        for piece in long:
            found = self.merge(piece)
            self.cache[piece] = (found, ",".join(map(str, found)))
        out = []
        for pieces, offsets in cut:
            pairs = list(map(self.cache.__getitem__, pieces))
            out.append((list(chain.from_iterable([x[0] for x in pairs])), ",".join([x[1] for x in pairs]), offsets))
        for piece in long:
            del self.cache[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        parts = self.parts
        return b"".join([parts[i] for i in ids])


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    """Kept by a worker with its cache of slices for the tasks that use it, see common.KEPT."""
    return Vocabulary(path)


def _ours(batches: Iterator) -> Iterator:
    KEPT["vocabulary"] = vocabulary.cache_clear
    return batches_then_release(batches, "vocabulary")


def _batches(texts: list[str], most: int = 300_000) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The columns of ``docs``, ids (array of int) and token_bytes (byte length of each token, which locate tokens).

    ``path`` names a rank file that every machine has. Null and empty texts have no ids; repeated rows each come back;
    columns of the new names (and ``_text``) are replaced; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for batch in _ours(batches):
            ids = [x[0] for part in _batches([t or "" for t in batch["_text"]]) for x in v.encode(part)]
            sizes = [[len(v.parts[i]) for i in x] for x in ids]
            yield batch.drop(columns="_text").assign(ids=ids, token_bytes=sizes)

    own = docs.drop("ids", "token_bytes", "_text")
    schema = own.withColumns({"ids": F.lit(None).cast("array<int>"), "token_bytes": F.lit(None).cast("array<int>")}).schema
    return own.withColumn("_text", F.col("text")).mapInPandas(run, schema)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``.

    Each whole text is encoded, and the bytes that the ids decode to are digested. Null texts are empty texts; repeated
    rows each come back; an empty table gives an empty result; other columns are not looked at.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for batch in _ours(batches):
            out = []
            for part in _batches([t or "" for t in batch["text"]]):
                for ids, decimal, _ in v.encode(part):
                    out.append((len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(v.decode(ids)).hexdigest()))
            got = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), got], axis=1)

    rows = docs.select("doc_id", "text")
    schema = rows.drop("text").withColumns({"n_tokens": F.lit(None).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")}).schema
    return rows.mapInPandas(run, schema)
