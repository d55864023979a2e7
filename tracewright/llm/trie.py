"""The prefix trie of conversations, from their sorted order.

Conversations are sorted by their turns (16 bytes a turn); the lengths of common prefixes of neighbours (LCP) make a
Cartesian tree, whose nodes are the branching nodes of the trie: an entry's node reaches to the nearest smaller entries
on both sides. Blocks of the sorted order (its partitions) find these by a stack each. What is open at an edge of a block
is settled by block minima: the next block whose minimum is smaller holds the nearest smaller entry, among the few that
are smaller than all between them and that block's edge (``steps``). Entries of equal value in one interval are one node,
depths without a branching are filled in, and counts are differences of running sums at the ends of an interval.

Steps and open nodes are at most twice the depth of the trie for each block; they are tables. One row for each block (its
last turns, sums and minima) passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tracewright.llm.common import broadcast_if_small, checkpointed, prepare

#: Bytes that stand for a turn: the first of a SHA-256 of role and text.
TURN = 16
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
#: Rows in one Arrow batch of results.
ROWS = 4096
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
#: An open node of a block, or a block's part of one. side: '<' open to the left, '>' to the right, '=' to both.
OPEN = (
    "side string, value bigint, spot bigint, entries bigint, ends bigint, ends_text string, words array<bigint>, words_from bigint,"
    " edge_value bigint, edge_spot bigint, edge_sum bigint, edge_leaves bigint, edge_least bigint"
)
#: A step: an entry smaller than all between it and its block's left ('[') or right (']') edge.
PIECE = f"kind string, block int, {NODE}, parent_side string, parent_value bigint, parent_block int, {OPEN}"
COLUMNS = [c.strip().split(" ")[0] for c in PIECE.split(",")]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, tokens): the turns of each conversation in order (null turn first, ties by their bytes), as structs of the
    turn's bytes and its number of words. Null roles and texts are empty; rows without conv_id belong to none and go."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    token = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, TURN)
    words = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(F.col("turn").alias("turn"), token.alias("t"), words.alias("w")).alias("x"))
    each = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return each.select("conv_id", F.transform("x", lambda x: F.struct(x["t"].alias("t"), x["w"].alias("w"))).alias("tokens"))


def rebuilt(tokens: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """``tokens`` with the first h turns of conversation conv_id - conv_id % family in place of the own first h, where h is
    the unsigned CRC-32 of conv_id in decimal, modulo ``heads``. A head that is absent gives no turns, a shorter one all; remainders of negative ids are negative."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = tokens.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_base"), F.slice("tokens", 1, heads - 1).alias("_head"))
    both = tokens.withColumn("_base", F.col("conv_id") - F.col("conv_id") % family).join(base, "_base", "left").withColumn("_h", h)
    none = F.array().cast(tokens.schema["tokens"].dataType)
    head = F.when(F.col("_h") > 0, F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), none)).otherwise(none)
    own = F.slice("tokens", F.col("_h") + 1, F.greatest(F.size("tokens"), F.lit(1)))
    return both.select("conv_id", F.concat(head, own).alias("tokens"))


def in_order(tokens: DataFrame) -> DataFrame:
    """(block, key, conv_id, words): conversations sorted by key (their turns' bytes) and conv_id over blocks in order.

    Copies of a conversation lie side by side and may spread over blocks. Written once, as all later steps read it."""
    key = F.unhex(F.array_join(F.transform("tokens", lambda x: F.hex(x["t"])), ""))
    rows = tokens.select(key.alias("key"), "conv_id", F.transform("tokens", lambda x: x["w"]).alias("words"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    return checkpointed(ranged.withColumn("block", F.spark_partition_id()))


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys share at their start."""
    n = min(len(a), len(b)) // TURN
    if a[: n * TURN] == b[: n * TURN]:
        return n
    low, high = 0, n - 1  # the first ``low`` turns agree, the first high + 1 do not
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def nearest_smaller(values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the nearest smaller entries to the left (-1: none) and right (len: none) of each, and of the first entry of
    equal value with the same ones."""
    n = len(values)
    left, right, first = np.empty(n, np.int64), np.full(n, n, np.int64), np.arange(n)
    stack: list[int] = []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = i
        if stack and values[stack[-1]] == v:
            top = stack.pop()
            left[i], first[i] = left[top], first[top]
            right[top] = -2 - i  # as that of i
        else:
            left[i] = stack[-1] if stack else -1
        stack.append(i)
    for i in range(n - 1, -1, -1):
        if right[i] < -1:
            right[i] = right[-2 - right[i]]
    return left, right, first


class Least:
    """Minima of stretches of an array."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        while 2 << (len(self.rows) - 1) <= len(x):
            half = 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(self.rows[-1][:-half], self.rows[-1][half:]))

    def __call__(self, a: int, b: int) -> int:
        """Of x[a:b], which is not empty."""
        k = (b - a).bit_length() - 1
        return int(min(self.rows[k][a], self.rows[k][b - (1 << k)]))


def digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY


def one_block(edges: dict[int, tuple[bytes | None, bytes | None, int | None]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task over one block: finished nodes ('node'), parts of open ones ('open'), steps ('[', ']') and the block's sums
    ('block'). ``edges``: of each block the key before it, the key after it and the number of the block after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, words, block = [], [], [], None
        for batch in batches:
            if batch.num_rows:
                block = batch.column("block")[0].as_py()
                keys += batch.column("key").to_pylist()
                ids += batch.column("conv_id").to_pylist()
                words += batch.column("words").to_pylist()
        if block is None:
            return
        rows: list[dict] = []
        for row in block_pieces(block, keys, ids, words, *edges[block]):
            rows.append(row)
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return run


_ARROW = pa.schema([(c, pa.string() if c in ("kind", "ends_sha256", "parent_side", "side", "ends_text") else pa.int32() if c.endswith("block") else pa.list_(pa.int64()) if c == "words" else pa.int64()) for c in COLUMNS])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def block_pieces(block: int, keys: list[bytes], ids: list[int], words: list[list[int]], before: bytes | None, after: bytes | None, next_block: int | None) -> Iterator[dict]:
    n = len(keys)
    # entry i is the LCP of conversation i and the one before; -1 before the first of all, and past the last of all
    lcp = [-1 if before is None else common(before, keys[0]), *[common(a, b) for a, b in zip(keys, keys[1:], strict=False)]]
    following = -1 if after is None else common(keys[-1], after)
    upto = [np.concatenate([[0], np.cumsum(w, dtype=np.int64)]) for w in words]  # words of the first d turns
    size = [len(k) // TURN for k in keys]
    shared = np.array([int(upto[i][v]) if v > 0 else 0 for i, v in enumerate(lcp)], np.int64)
    right_of = [*lcp[1:], following]
    leaf = np.array([right_of[i] < size[i] for i in range(n)], np.int64)
    sums, leaves = np.concatenate([[0], np.cumsum(shared)]), np.concatenate([[0], np.cumsum(leaf)])
    least = Least(np.array(ids, np.int64))
    last_block = after is None
    values = [*lcp, -1] if last_block else lcp  # the first block has its -1 as entry 0
    left, right, first = nearest_smaller(values)
    smallest = min(values)

    def side(i: int) -> str | None:
        """Where the node of entry i is open."""
        to_left, to_right = left[i] < 0, right[i] >= len(values)
        return "=" if to_left and to_right else "<" if to_left else ">" if to_right else None

    # conversations that end at the node of an entry; entry n is the next block's first
    ends: dict[int, list[int]] = {}
    for i in range(n):
        deepest = max(lcp[i], right_of[i])
        if size[i] == deepest:
            ends.setdefault(int(first[i]) if lcp[i] == deepest else int(first[i + 1]) if i + 1 < n else n, []).append(ids[i])

    def parent(i: int) -> dict:
        """The node of entry i as a parent: its least member, or where to look that up."""
        if i >= n:
            return {} if last_block else {"parent_block": next_block, "parent_side": "<", "parent_value": following}
        if lcp[i] < 0:
            return {}
        s = side(i)
        return {"parent_block": block, "parent_side": s, "parent_value": lcp[i]} if s else {"parent_conv_id": least(int(left[i]), int(right[i]))}

    def chain(low: int, depth: int, member: int, above: dict, rest: dict, children: int, sha: str, saved: Callable[[int], int]) -> Iterator[dict]:
        """The nodes of one interval at depths low to ``depth``; only the deepest branches or ends conversations."""
        for q in range(low, depth + 1):
            up = above if q == low else {"parent_conv_id": member}
            yield {"kind": "node", "block": block, "conv_id": member, "depth": q, "n_children": children if q == depth else 1, "saved_tokens": saved(q), "ends_sha256": sha if q == depth else EMPTY, **rest, **up}

    for i in range(n):  # a conversation below all branchings
        low = max(lcp[i], right_of[i]) + 1
        if size[i] >= low:
            yield from chain(low, size[i], ids[i], parent(i if lcp[i] >= right_of[i] else i + 1), {"n_convs": 1, "n_leaves": 1}, 0, digest([ids[i]]), lambda q: 0)
    count = np.bincount(first[:n], minlength=n)
    for i in range(n):
        if first[i] != i or lcp[i] < 0:
            continue
        l, r, d, s = int(left[i]), int(right[i]), lcp[i], side(i)
        mine = ends.get(i, [])
        if s is None:
            low = max(lcp[l], values[r]) + 1
            total, member, w = int(sums[r] - sums[l + 1]), least(l, r), upto[i]
            above = parent(l if lcp[l] >= values[r] else r)
            rest = {"n_convs": r - l, "n_leaves": int(leaves[r] - leaves[l])}
            yield from chain(low, d, member, above, rest, int(count[i]) + 1 - len(mine), digest(mine), lambda q, total=total, w=w, k=r - l - 1: total - k * int(w[max(q - 1, 0)]))
            continue
        # the known end of an interval that is open on one side
        known = {} if s == "=" else {"edge_value": lcp[l], "edge_spot": l, "edge_sum": int(sums[l + 1]), "edge_leaves": int(leaves[l]), "edge_least": least(l, n)} if s == ">" else {"edge_value": values[r], "edge_spot": r, "edge_sum": int(sums[r]), "edge_leaves": int(leaves[r]), "edge_least": least(0, r) if r else None}
        lowest = max(known.get("edge_value", -1), 0)  # the words of shallower depths are not asked for
        yield {"kind": "open", "block": block, "side": s, "value": d, "spot": i, "entries": int(count[i]), "ends": len(mine), "ends_text": ",".join(map(str, mine)) if mine else None, "words": upto[i][lowest : d + 1].tolist(), "words_from": lowest, **known}
    if n in ends:
        yield {"kind": "open", "block": next_block, "side": "<", "value": following, "spot": -1, "entries": 0, "ends": len(ends[n]), "ends_text": ",".join(map(str, ends[n])), "words": None}
    low = None
    for i, v in enumerate(values):
        if low is None or v < low:
            low = v
            yield {"kind": "[", "block": block, "value": low, "edge_spot": i, "edge_sum": int(sums[i]), "edge_leaves": int(leaves[i]), "edge_least": least(0, i) if i else None}
    low = None
    for i in range(n - 1, -1, -1):
        if low is None or lcp[i] < low:
            low = lcp[i]
            yield {"kind": "]", "block": block, "value": low, "edge_spot": i, "edge_sum": int(sums[i + 1]), "edge_leaves": int(leaves[i]), "edge_least": least(i, n)}
    yield {"kind": "block", "block": block, "value": smallest, "spot": n, "edge_sum": int(sums[n]), "edge_leaves": int(leaves[n]), "edge_least": least(0, n)}


class Blocks:
    """Sums and minima of all blocks, one row each, in order."""

    def __init__(self, rows: list[Row]):
        rows = sorted(rows, key=lambda r: r["block"])
        self.number = np.array([r["block"] for r in rows], np.int64)
        self.value = np.array([r["value"] for r in rows], np.int64)
        self.least = Least(np.array([r["edge_least"] for r in rows], np.int64))
        self.low = Least(self.value)
        before = lambda c: np.concatenate([[0], np.cumsum([r[c] for r in rows])]).astype(np.int64)
        self.spot, self.sum, self.leaves = before("spot"), before("edge_sum"), before("edge_leaves")

    def at(self, block: int) -> int:
        return int(np.searchsorted(self.number, block))

    def smaller(self, block: int, value: int, step: int) -> int:
        """Place of the nearest block before (step -1) or behind (1) with a minimum below ``value``; -1 or len: none.

        A walk by doubling stretches, then halves."""
        at, n = self.at(block), len(self.number)
        a, b = (0, at) if step < 0 else (at + 1, n)
        if a >= b or self.low(a, b) >= value:
            return -1 if step < 0 else n
        while b - a > 1:
            middle = (a + b) // 2
            near, far = ((middle, b), (a, middle)) if step < 0 else ((a, middle), (middle, b))
            a, b = near if self.low(*near) < value else far
        return a


WANT = "block int, side string, value bigint, to_left int, to_right int"


def looked_up(blocks: Blocks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that names, for each open node, the places of the blocks that close it to the left and right (null: not
    asked for). The first block and the last one hold a -1, so there always is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, side, value in zip(*(batch.column(c).to_pylist() for c in ("block", "side", "value")), strict=True):
                out.append((blocks.smaller(block, value, -1) if side != ">" else None, blocks.smaller(block, value, 1) if side != "<" else None))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("side"), batch.column("value"), pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32())], ["block", "side", "value", "to_left", "to_right"])

    return run


def closed(opens: DataFrame, steps: DataFrame, blocks: Blocks) -> DataFrame:
    """(block, side, value, l_.., r_..): both ends of the interval of each open node, by its name in a block.

    An end is a place (spot, all blocks counted), its value, the running sums there, the least member between it and its
    block's edge, its block's place and its name there as an open node. An end in another block is the first step
    below ``value`` from that block's edge: asked for once for each value, and read in one pass in order of value."""
    keys = ["block", "side", "value"]
    spark = opens.sparkSession
    shared = spark.sparkContext.broadcast(blocks)
    wanted = opens.where("spot >= 0").select(*keys).mapInArrow(lambda b: looked_up(shared.value)(b), WANT)
    place = spark.createDataFrame([(int(b), k, int(blocks.value[k]), int(blocks.spot[k]), int(blocks.sum[k]), int(blocks.leaves[k])) for k, b in enumerate(blocks.number)], "block int, place int, block_value bigint, b_spot bigint, b_sum bigint, b_leaves bigint")
    ends = ["value", "spot", "sum", "leaves", "least", "place", "side"]

    def whole(df: DataFrame, side: Column) -> DataFrame:
        """Ends within their block, told over all blocks."""
        at = df.join(F.broadcast(place), "block")
        return at.select("*", F.struct(F.col("edge_value").alias("value"), (F.col("edge_spot") + F.col("b_spot")).alias("spot"), (F.col("edge_sum") + F.col("b_sum")).alias("sum"), (F.col("edge_leaves") + F.col("b_leaves")).alias("leaves"), F.col("edge_least").alias("least"), F.col("place").alias("place"), side.alias("side")).alias("end"))

    def other(kind: str, to: str, side: str) -> DataFrame:
        """(to, value, end) for each block and value that is asked for."""
        named = F.when(F.col("edge_value") == F.col("block_value"), F.lit("=")).otherwise(F.lit(side))
        entries = whole(steps.where(F.col("kind") == kind).withColumn("edge_value", F.col("value")).drop("side"), named).select(F.col("place").alias(to), "value", F.lit(0).alias("_ask"), "end")
        asked = wanted.where(F.col(to).isNotNull()).select(to, "value").distinct().select(to, "value", F.lit(1).alias("_ask"), F.lit(None).cast(entries.schema["end"].dataType).alias("end"))
        # strictly smaller entries stand before a question of their value
        w = Window.partitionBy(to).orderBy("value", F.desc("_ask")).rowsBetween(Window.unboundedPreceding, -1)
        return entries.unionByName(asked).withColumn("end", F.last("end", ignorenulls=True).over(w)).where("_ask = 1").drop("_ask")

    own = whole(opens.where("spot >= 0"), F.when(F.col("edge_value") == F.col("block_value"), F.lit("=")).otherwise(F.col("side")))
    own = own.select(*keys, F.col("place").alias("here"), F.when(F.col("edge_spot").isNotNull(), F.col("end")).alias("own"))
    both = own.join(wanted, keys).join(other("]", "to_left", ">").withColumnRenamed("end", "_l"), ["to_left", "value"], "left").join(other("[", "to_right", "<").withColumnRenamed("end", "_r"), ["to_right", "value"], "left")
    l = F.when(F.col("side") == ">", F.col("own")).otherwise(F.col("_l"))
    r = F.when(F.col("side") == "<", F.col("own")).otherwise(F.col("_r"))
    both = both.select(*keys, l.alias("l"), r.alias("r"))
    return both.select(*keys, *[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in "lr" for c in ends])


def _least_between(blocks: Blocks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that sets ``least`` to the least member of the whole blocks between two places, null without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("l_place").to_pylist(), batch.column("r_place").to_pylist()
            out = [blocks.least(x + 1, y) if y > x + 1 else None for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("l_spot"), batch.column("r_spot"), pa.array(out, pa.int64())], ["l_spot", "r_spot", "between"])

    return run


def _ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, read in order; a node's texts need not be in memory together."""
    node, running, first = None, None, True

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([running.hexdigest()])], ["l_spot", "r_spot", "sha"])

    for batch in batches:
        for l, r, text in zip(*(batch.column(c).to_pylist() for c in ("l_spot", "r_spot", "ends_text")), strict=True):
            if (l, r) != node:
                if node is not None:
                    yield row()
                node, running, first = (l, r), hashlib.sha256(), True
            running.update(("" if first else ",").encode() + text.encode())
            first = False
    if node is not None:
        yield row()


def open_nodes(opens: DataFrame, ends: DataFrame, blocks: Blocks) -> tuple[DataFrame, DataFrame]:
    """Rows of NODE of the nodes that reach over an edge of blocks, and (block, side, value, member) to find them by."""
    keys, node = ["block", "side", "value"], ["l_spot", "r_spot"]
    spark = opens.sparkSession
    shared = spark.sparkContext.broadcast(blocks)
    spans = ends.groupBy(*node).agg(F.min("value").alias("value"), *[F.first(c).alias(c) for c in ends.columns if c not in (*keys, *node)])
    between = spans.select(*node, "l_place", "r_place").mapInArrow(lambda b: _least_between(shared.value)(b), "l_spot bigint, r_spot bigint, between bigint")
    spans = spans.join(between, node).withColumn("member", F.least("l_least", "between", "r_least")).drop("between")
    parts = opens.join(ends.select(*keys, *node), keys)
    # every part's list of words reaches down to the parent's depth
    figures = parts.groupBy(*node).agg(F.sum("entries").cast("bigint").alias("entries"), F.sum("ends").cast("bigint").alias("n_ends"), F.min_by(F.struct("words", "words_from"), F.when(F.col("words").isNotNull(), F.size("words"))).alias("w"))
    texts = parts.where("ends_text IS NOT NULL").select(*node, "block", "spot", "ends_text").repartition(*node).sortWithinPartitions(*node, "block", "spot")
    shas = texts.mapInArrow(_ends_digests, "l_spot bigint, r_spot bigint, sha string")
    names = ends.select(*keys, *node).join(spans.select(*node, "member"), node).select(*keys, "member")
    upper = F.struct(F.when(F.col("l_value") >= F.col("r_value"), F.col("l_place")).otherwise(F.col("r_place")).alias("place"), F.when(F.col("l_value") >= F.col("r_value"), F.col("l_side")).otherwise(F.col("r_side")).alias("side"), F.greatest("l_value", "r_value").alias("value"))
    places = spark.createDataFrame([(k, int(b)) for k, b in enumerate(blocks.number)], "_place int, _at int")
    one = spans.join(figures, node).join(shas, node, "left").withColumn("up", upper).join(F.broadcast(places), F.col("up.place") == F.col("_place"), "left")
    above = names.select(F.col("block").alias("_block"), F.col("side").alias("_side"), F.col("value").alias("_value"), F.col("member").alias("_parent"))
    one = one.join(above, (F.col("_at") == F.col("_block")) & (F.col("up.side") == F.col("_side")) & (F.col("up.value") == F.col("_value")), "left")
    size, low = F.col("r_spot") - F.col("l_spot"), F.col("up.value") + 1
    depths = one.withColumn("depth", F.explode(F.sequence(low, F.col("value"))))
    deepest = F.col("depth") == F.col("value")
    at = F.greatest(F.col("depth") - 1, F.lit(0)) - F.col("w.words_from")
    saved = F.col("r_sum") - F.col("l_sum") - (size - 1) * F.get("w.words", at.cast("int"))
    return depths.select(
        F.col("member").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == low, F.col("_parent")).otherwise(F.col("member")).alias("parent_conv_id"),
        size.alias("n_convs"),
        F.when(deepest, F.col("entries") + 1 - F.col("n_ends")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        (F.col("r_leaves") - F.col("l_leaves")).alias("n_leaves"),
        saved.cast("bigint").alias("saved_tokens"),
        F.when(deepest, F.coalesce("sha", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    ), names


def prefix_trie(tokens: DataFrame) -> DataFrame:
    """NODE of each node of the trie of (conv_id, tokens): see the module's text; conv_ids are distinct.

    Conversations without turns are members of the root, which is there as soon as there is a conversation. One
    conversation is one row (TURN bytes a turn), and the conversations of one block are held by one task. The digest of
    the conversations that end at one node is of one text by its definition: a task reads that in pieces.
    """
    spark = tokens.sparkSession
    prepare(spark)
    rows = in_order(tokens)
    last = sorted(rows.groupBy("block").agg(F.max(F.struct("key", "conv_id")).alias("z"), F.min(F.struct("key", "conv_id")).alias("a")).select("block", F.col("a.key").alias("a"), F.col("z.key").alias("z")).collect())
    if not last:
        return spark.createDataFrame([], NODE)
    edges = {r["block"]: (bytes(last[k - 1]["z"]) if k else None, bytes(last[k + 1]["a"]) if k + 1 < len(last) else None, last[k + 1]["block"] if k + 1 < len(last) else None) for k, r in enumerate(last)}
    shared = spark.sparkContext.broadcast(edges)
    pieces = checkpointed(rows.mapInArrow(lambda b: one_block(shared.value)(b), PIECE))
    blocks = Blocks(pieces.where("kind = 'block'").select("block", "value", "spot", "edge_sum", "edge_leaves", "edge_least").collect())
    lowest = spark.createDataFrame([(int(b), int(v)) for b, v in zip(blocks.number, blocks.value, strict=True)], "block int, _lowest bigint")
    # a neighbour that names a block's first entry cannot know whether it is the block's least
    named = lambda df, block, side, value: df.join(F.broadcast(lowest.withColumnRenamed("block", block)), block, "left").withColumn(side, F.when((F.col(side) == "<") & (F.col(value) == F.col("_lowest")), F.lit("=")).otherwise(F.col(side))).drop("_lowest")
    columns = [c.strip().split(" ")[0] for c in OPEN.split(",")]
    opens = named(pieces.where("kind = 'open'").select("block", *columns), "block", "side", "value")
    steps = pieces.where("kind IN ('[', ']')").select("kind", "block", "value", "edge_spot", "edge_sum", "edge_leaves", "edge_least", "side")
    nodes = [c.strip().split(" ")[0] for c in NODE.split(",")]
    done = named(pieces.where("kind = 'node'").select(*nodes, "parent_block", "parent_side", "parent_value"), "parent_block", "parent_side", "parent_value")
    ends = checkpointed(closed(opens, steps, blocks))
    across, names = open_nodes(opens, ends, blocks)
    names = names.select(F.col("block").alias("parent_block"), F.col("side").alias("parent_side"), F.col("value").alias("parent_value"), F.col("member").alias("_member"))
    found = done.join(broadcast_if_small(names), ["parent_block", "parent_side", "parent_value"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_member"))
    return found.select(*nodes).unionByName(across.select(*nodes))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations (conv_id, turn, role, text); null conv_ids go, repeated rows are repeated turns."""
    return prefix_trie(rebuilt(turns(conversations.select("conv_id", "turn", "role", "text"))))
