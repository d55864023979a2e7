"""SimHash near-duplicate groups: 64-bit fingerprints, pigeonhole blocks, Hamming verification, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import BROADCAST_ROWS, batches_then_release, broadcast_if_small, checkpointed, join_hot, prepare

BITS = 64
#: Blocks of equal width; two fingerprints at MAX_BITS or fewer differing bits agree on BLOCKS - MAX_BITS of them.
BLOCKS, MAX_BITS = 4, 2
#: Buckets above this size are not paired; their members meet at common midpoints instead.
PAIR_CAP = 64
#: Wide fingerprints for near copies have WIDE_BITS bits, of which the first are split into blocks of equal width. A block is
#: joined on together with its ANCHORS, the least of the text's shingles under as many orders of the block's own. Texts of
#: Jaccard similarity s agree on an anchor with chance s and on a bit with chance 1 - arccos(2s / (1 + s)) / pi, so a pair
#: at exactly 0.8 shares no block with a chance of 4 in 100,000 (5 in 10,000 for sets of four and five shingles, the
#: worst case), closer pairs with a far smaller one. The anchors keep unrelated texts apart at any table size, together
#: with the bits also those that share no more than a frequent passage.
WIDE_BITS, WIDE_BLOCKS, WIDE_WIDTH, ANCHORS = 960, 48, 6, 3
#: At a similarity of 0.8 145 +- 11 bits differ; 180 +- 12 for sets of four and five shingles, so that sets below SMALL_SET
#: have a limit of their own. At 0.6 it is 221 +- 13, by chance 480 +- 15.
NEAR_BITS, SMALL_BITS, SMALL_SET = 190, 230, 20
#: Buckets above this size are linked by their centre first, then by what their members share beyond it.
WIDE_PAIRS = 8
#: Keys with more than one in HUBS of all pairs are joined by broadcast: so many shingle sets at most.
HUBS = 50
#: Rows of a few numbers, and of whole fingerprints, that one task takes where a table is gathered.
GATHER, GATHER_WIDE = 50_000, 10_000
#: Near copies: Jaccard similarity of the shingle sets, as a fraction.
NEAR = (4, 5)


def _shingle_digests(text: str | None, shingle_words: int) -> bytes:
    """XXH64 (seed 42, big-endian) of each shingle, repeats included; nothing for null and wordless texts."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return b""
    joined, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[starts[i] : ends[min(i + shingle_words, len(words)) - 1] - 1], 42) for i in range(n)])


def simhash(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned fingerprint of one text; null and wordless texts give 0."""
    raw = _shingle_digests(text, shingle_words)
    n = len(raw) // 8
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        part = np.frombuffer(raw[8 * at : 8 * (at + 65536)], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; none without words."""
    return np.unique(np.frombuffer(_shingle_digests(text, shingle_words), ">u8").astype(np.uint64))


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_LANES = np.arange(1, WIDE_BITS // 64 + 1, dtype=np.uint64) * _STEP
_ORDERS = _mixed(np.arange(1, 2 * WIDE_BLOCKS * ANCHORS + 1, dtype=np.uint64) * _STEP).reshape(2, -1)
_NUMBERS = np.arange(1, WIDE_BLOCKS + 1, dtype=np.uint64) * _STEP


def wide_simhash(hashes: np.ndarray) -> np.ndarray:
    """Bits of the wide fingerprint of a set of shingle hashes; all 0 for the empty set."""
    ones = np.zeros(WIDE_BITS, np.int64)
    for at in range(0, len(hashes), 255):  # 255 rows at most, so that the counts of a part fit a byte
        z = _mixed(hashes[at : at + 255, None] + _LANES)
        ones += np.unpackbits(z.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return 2 * ones > len(hashes)


def block_keys(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A key for each block of the fingerprint, of its bits and its anchors; none for the empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(WIDE_BLOCKS * ANCHORS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 256):
        np.minimum(least, ((hashes[at : at + 256, None] ^ _ORDERS[0]) * (_ORDERS[1] | np.uint64(1))).min(axis=0), out=least)
    blocks = bits[: WIDE_BLOCKS * WIDE_WIDTH].reshape(WIDE_BLOCKS, WIDE_WIDTH) @ (1 << np.arange(WIDE_WIDTH))
    keys = _mixed(_NUMBERS ^ blocks.astype(np.uint64))
    for anchors in least.reshape(ANCHORS, WIDE_BLOCKS):
        keys = _mixed(keys ^ anchors)
    return keys.view(np.int64)


def fingerprints(docs: DataFrame, shingle_words: int = 3, carry: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """The ``carry`` columns and ``name``, the fingerprint as a signed long, of each row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_then_release(batches):
            marks = np.array([simhash(t, shingle_words) for t in batch["_text"]], np.uint64).view(np.int64)
            yield batch.drop(columns="_text").assign(**{name: marks})

    rows = docs.select(*carry, F.col("text").alias("_text"))
    schema = rows.drop("_text").withColumn(name, F.lit(0).cast("long")).schema
    return rows.mapInPandas(run, schema)


def _block_keys(fp: Column) -> Column:
    width = BITS // BLOCKS
    cut = [F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit((1 << width) - 1)) for i in range(BLOCKS)]
    keys = []
    for k, members in enumerate(combinations(range(BLOCKS), BLOCKS - MAX_BITS)):
        key = F.lit(k).cast("long")
        for i in members:
            key = F.shiftleft(key, width).bitwiseOR(cut[i])
        keys.append(key)
    return F.array(*keys)


def links(distinct: DataFrame) -> DataFrame:
    """Links (u, v), enough to connect all of the distinct ``fp`` that are at two or fewer differing bits.

    Fingerprints meet in pigeonhole buckets; pairs within a bucket are verified. In a bucket of more than PAIR_CAP
    members, pairs would grow with the square of its size: there each member is sent to itself and its 64 one-bit
    neighbours. Two fingerprints are within two bits exactly if they share such a midpoint, a midpoint has at most 65
    members, and all of them are within two bits of one another, so linking each to the smallest is exact and linear.
    """
    blocks = distinct.select("fp", F.explode(_block_keys(F.col("fp"))).alias("key"))
    sizes = blocks.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = checkpointed(blocks.join(sizes, "key"))
    few = shared.where(F.col("n") <= PAIR_CAP)
    pairs = (
        few.select("key", F.col("fp").alias("u"))
        .join(few.select("key", F.col("fp").alias("v")), "key")
        .where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS))
        .select("u", "v")
    )
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(BITS)])
    middles = shared.where(F.col("n") > PAIR_CAP).select("fp").distinct().select("fp", F.explode(around).alias("mid"))
    lowest = middles.groupBy("mid").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = middles.join(lowest, "mid").where(F.col("u") < F.col("fp")).select("u", F.col("fp").alias("v"))
    return pairs.unionAll(stars).distinct()


def gathered(df: DataFrame, rows: int, each: int = GATHER) -> DataFrame:
    """``df``, of at most ``rows`` rows, in as few partitions as hold ``each`` rows; a small table makes few tasks and files."""
    return df.coalesce(max(1, -(-rows // each)))


def _found(rows: DataFrame, groups: DataFrame, key: str, total: int, size: int) -> DataFrame:
    """The inner join of ``total`` rows and ``size`` groups, one a key: by broadcast if they are few, else by join_hot."""
    if size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), key)
    return join_hot(rows, groups, key, rows.groupBy(key).agg(F.count("*").alias("n")), total)


def connected(edges: DataFrame) -> DataFrame:
    """(id, label) for each end of ``edges`` (u, v): the smallest id that can be reached.

    Each round every end points to its smallest neighbour, if that is smaller; pointers jump to their own pointer's end
    until all are at roots, in as many steps as the logarithm of a chain's length. Then the edges are moved to the roots
    of their ends: those within a tree go, and equal ones become one, so that the edges are read once and later rounds
    have few. Each step is written to the checkpoint folder. Ends with very many edges and roots of very many ends are
    joined by broadcast, so that no task gets all of them.
    """
    edges = checkpointed(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))
    labels, known, n = edges.select(F.col("u").alias("id"), F.col("v").alias("label")), 0, edges.count()
    while n:
        edges = gathered(edges, n)
        both = edges.unionAll(edges.select(F.col("v"), F.col("u")))
        roots = checkpointed(gathered(both.groupBy(F.col("u").alias("id")).agg(F.least("id", F.min("v")).alias("label")), 2 * n))
        ends, moved = roots.count(), True
        while moved:
            up = roots.select(F.col("id").alias("label"), F.col("label").alias("up"))
            jumped = checkpointed(gathered(_found(roots, up, "label", ends, ends).select("id", F.col("up").alias("label"), F.expr("up <> label").alias("moved")), ends))
            roots, moved = jumped.select("id", "label"), not jumped.where("moved").isEmpty()
        if known:
            later = labels.select("label").distinct().join(roots.withColumnRenamed("label", "root"), F.col("label") == F.col("id"), "left").select("label", F.coalesce("root", "label").alias("root"))
            labels = checkpointed(gathered(_found(labels, later, "label", known, known).select("id", F.col("root").alias("label")), known))
        else:
            labels, known = roots, ends
        for end in ("u", "v"):
            edges = _found(edges, roots.select(F.col("id").alias(end), F.col("label").alias(f"_{end}")), end, n, ends)
        edges = checkpointed(gathered(edges.where("_u <> _v").select(F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v")).distinct(), n))
        n = edges.count()
    return labels


def grouped_fingerprints(marked: DataFrame) -> DataFrame:
    """(fp, first_id, n, component_id) for each distinct ``fp`` of ``marked`` (doc_id, fp): its smallest doc_id and its rows."""
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    parts = connected(links(distinct)).withColumnRenamed("id", "fp")
    linked = parts.join(distinct, "fp")
    lowest = linked.groupBy("label").agg(F.min("first_id").alias("low"))
    moved = linked.join(lowest, "label").select("fp", "low")
    return distinct.join(moved, "fp", "left").select("fp", "first_id", "n", F.coalesce("low", "first_id").alias("component_id"))


def near_duplicate_groups(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """One row (doc_id, fp, component_id) for each row of ``docs``.

    component_id is the smallest doc_id among the rows reachable over fingerprints at two or fewer differing bits.
    Rows of one fingerprint are collapsed before anything is paired, so groups of exact copies cost one row.
    Null and empty texts share fingerprint 0; null ids are carried but never chosen (a group of null ids has a null
    component); repeated rows stay; an empty table gives an empty result.
    """
    marked = checkpointed(fingerprints(docs, shingle_words))
    groups = checkpointed(grouped_fingerprints(marked))
    return join_hot(marked, groups.select("fp", "component_id"), "fp", groups.select("fp", "n"), marked.count()).select("doc_id", "fp", "component_id")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def shared_cells(cells: DataFrame) -> DataFrame:
    """The ``cells`` (fp, key) of keys that several hold, with their number n.

    The numbers are pre-aggregated before the shuffle, so that a key of very many cells makes few rows of it. The two
    members of a bucket of two, the usual kind, come with the numbers; only larger buckets are joined to the cells.
    """
    ends = [F.min("fp").alias("low"), F.max("fp").alias("high")]
    sizes = checkpointed(cells.groupBy("key").agg(F.count("*").alias("n"), *ends).where("n > 1"))
    two = sizes.where("n = 2").select(F.explode(F.array("low", "high")).alias("fp"), "key", "n")
    more = cells.join(broadcast_if_small(sizes.where("n > 2").select("key", "n")), "key").select("fp", "key", "n")
    return checkpointed(two.unionAll(more))


def _close(u: str, v: str, n: Column, m: Column) -> Column:
    """Whether two wide fingerprints, columns ``u`` and ``v`` of sets of n and m shingles, differ in few enough bits."""
    differ = F.aggregate(F.zip_with(u, v, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda k, x: k + x)
    return differ <= F.when(F.least(n, m) < SMALL_SET, SMALL_BITS).otherwise(NEAR_BITS)


def _enough(n: Column, m: Column, both: Column) -> Column:
    """Whether sets of n and m shingles, ``both`` of them in common, have a Jaccard similarity of NEAR or more."""
    part, whole = NEAR
    return (n + m) * part <= both * (part + whole)


def linked_components(shared: DataFrame, nodes: DataFrame, sets: DataFrame, overlaps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(fp, label) for each fp linked to others: all that share a key of ``shared`` and are near by ``overlaps`` of the pair.

    ``nodes`` has (fp, wide, size), ``sets`` (fp, shingles). Small buckets are paired. Buckets of more than WIDE_PAIRS members, where pairs would grow
    with the square of their size, are linked without listing pairs, and still lose none. Of the shingles that several
    of their members hold, those of more than WIDE_PAIRS are the core of such families, the others are rare. Whether two
    texts are near follows from their sizes and the number of shingles in common, so bounds of that number leave out pairs.

    0. A member with too few shared shingles to be near any other is left out.
    1. Each other member is compared with its bucket's centre, the member with most core shingles
       beyond its other ones.
    2. Members of different parts that share rare shingles are paired by them (at most WIDE_PAIRS hold one), and compared
       if these and the core shingles of either are enough.
    3. Members that share core shingles only have no more in common than what either shares with a centre and what either
       has beyond it. Members outside of their centre's part are compared with those that this and the Hamming distance
       leave, as a rule none: both would be near the centre.
    """
    n_cells, n_texts = shared.count(), nodes.count()
    shared, nodes = gathered(shared, n_cells), gathered(nodes, n_texts, GATHER_WIDE)
    few, hot = shared.where(F.col("n") <= WIDE_PAIRS), shared.where(F.col("n") > WIDE_PAIRS).select("key", "fp")
    pairs = few.select("key", F.col("fp").alias("u")).join(few.select("key", F.col("fp").alias("v")), "key").where("u < v").select("u", "v")
    linked = lambda found: found.where("near").select("u", "v")
    if hot.isEmpty():
        return connected(linked(overlaps(pairs.distinct()))).withColumnRenamed("id", "fp")
    held = sets.join(hot.select("fp").distinct(), "fp").select("fp", F.explode("shingles").alias("shingle"))
    often = checkpointed(held.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"))
    marks = checkpointed(held.join(broadcast_if_small(often), "shingle"))
    one, whole = NEAR
    counts = marks.groupBy("fp").agg(F.count("*").alias("known"), F.count(F.when(F.col("n") > WIDE_PAIRS, 1)).alias("core"))
    texts = checkpointed(gathered(nodes.select("fp", "size").join(counts, "fp").where(F.col("known") * whole >= F.col("size") * one), n_texts))
    members = checkpointed(gathered(hot.join(texts, "fp"), n_cells))
    middle = F.struct(2 * F.col("core") - F.col("size"), F.col("fp").alias("centre"), F.col("size").alias("_size"), F.col("known").alias("_known"))
    central = checkpointed(gathered(members.groupBy("key").agg(F.max(middle).alias("m")).select("key", "m.centre", "m._size", "m._known"), n_cells))
    cells = checkpointed(gathered(members.join(broadcast_if_small(central), "key"), n_cells))
    near = _enough(F.col("size"), F.col("_size"), F.least("known", "_known")) & F.expr("fp <> centre")
    stars = overlaps(cells.where(near).select(F.col("centre").alias("u"), F.col("fp").alias("v")).distinct())
    first = checkpointed(connected(linked(overlaps(pairs.distinct())).unionAll(linked(stars)).distinct())).withColumnRenamed("id", "fp")

    part = lambda df: df.join(first, "fp", "left").withColumn("part", F.coalesce("label", "fp")).drop("label")
    placed = part(texts)
    rare = checkpointed(marks.where(F.col("n") <= WIDE_PAIRS).select("fp", "shingle").join(placed, "fp"))
    end = lambda df, name, *more: df.select(F.col("fp").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("part", "core", "size", *more)])
    reach = lambda both: _enough(F.col("size_u"), F.col("size_v"), both)
    ends = ["u", "v", "part_u", "part_v"]
    beyond = end(rare, "u", "shingle").withColumnRenamed("shingle_u", "shingle").join(end(rare, "v", "shingle").withColumnRenamed("shingle_v", "shingle"), "shingle").where("part_u <> part_v AND u < v")
    beyond = beyond.groupBy(*ends, "core_u", "core_v", "size_u", "size_v").agg(F.count("*").alias("both")).where(reach(F.least("core_u", "core_v") + F.col("both"))).select(*ends)
    # a text's home is, of the centres it was compared with and itself, the one compared with most texts
    counted = stars.select(F.col("u").alias("home"), F.col("v").alias("fp"), F.col("both").alias("in"))
    of_itself = counted.select("home").distinct().join(nodes.select(F.col("fp").alias("home"), F.col("size").alias("in")), "home").select("home", F.col("home").alias("fp"), "in")
    popular = counted.groupBy("home").agg(F.count("*").alias("_texts"))
    own = texts.select(F.col("fp").alias("home"), (F.col("known") - F.col("core")).alias("_rare"))
    homes = counted.unionAll(of_itself).join(broadcast_if_small(checkpointed(popular.join(own, "home"))), "home").groupBy("fp").agg(F.max(F.struct("_texts", "home", "in", "_rare")).alias("h"))
    homely = part(texts.where(F.col("core") * whole >= F.col("size") * one)).join(homes.select("fp", "h.home", "h.in", "h._rare"), "fp", "left").join(nodes.select("fp", "wide"), "fp")
    # of the shared ones some may be rare shingles of the home, so as many more of the core may lie outside of it
    out = F.greatest(F.lit(0), F.col("core") - F.col("in") + F.col("_rare"))
    homely = homely.select("fp", "part", "core", "size", "home", F.least("in", "core").alias("in"), out.alias("out"), "wide")
    heavy = checkpointed(gathered(hot.join(homely, "fp"), n_cells, GATHER_WIDE))
    mains = checkpointed(gathered(part(central.select("key", F.col("centre").alias("fp"))).select("key", F.col("part").alias("main")), n_cells))
    outside = heavy.join(broadcast_if_small(mains), "key").where("part <> main")
    more = ("key", "home", "in", "out", "wide")
    within = end(outside, "u", *more, "main").join(end(heavy, "v", *more), F.col("key_u") == F.col("key_v"))
    within = within.where("part_u <> part_v AND (part_v = main_u OR u < v)").where(reach(F.when(F.expr("home_u = home_v"), F.least("in_u", "in_v") + F.least("out_u", "out_v")).otherwise(F.least("core_u", "core_v"))))
    within = within.where(_close("wide_u", "wide_v", F.col("size_u"), F.col("size_v"))).select(*ends)
    last = overlaps(beyond.unionAll(within).distinct()).where("near")
    across = connected(last.select(F.col("part_u").alias("u"), F.col("part_v").alias("v")).distinct())
    joined = across.select(F.col("id").alias("part"), F.col("label").alias("later"))
    known = part(first.select("fp").unionAll(texts.select("fp")).distinct())
    return known.join(joined, "part", "left").select("fp", F.coalesce("later", "part").alias("label"))


def wide_fingerprints(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """(doc_id, own, fp, wide, size, keys) of each row: hashes of the text and of its shingle set, the wide fingerprint
    (as longs), the set's size and a key for each block. Texts without words have the empty set and no keys."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_then_release(batches):
            sets = [shingle_set(t, shingle_words) for t in batch["_text"]]
            bits = [wide_simhash(x) for x in sets]
            marks = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            wide, keys = [np.packbits(b).view(np.int64) for b in bits], [block_keys(x, b) for x, b in zip(sets, bits, strict=True)]
            yield batch.drop(columns="_text").assign(fp=marks, wide=wide, size=[len(x) for x in sets], keys=keys)

    rows = docs.select("doc_id", F.xxhash64("text").alias("own"), F.col("text").alias("_text"))
    longs = F.array(F.lit(0).cast("long"))
    schema = rows.drop("_text").withColumns({"fp": F.lit(0).cast("long"), "wide": longs, "size": F.lit(0).cast("int"), "keys": longs}).schema
    return rows.mapInPandas(run, schema)


def shingle_sets(texts: DataFrame, shingle_words: int = 5) -> DataFrame:
    """(fp, shingles) of each row of ``texts`` (fp, text): its distinct shingle hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_then_release(batches):
            yield pd.DataFrame({"fp": batch["fp"], "shingles": [shingle_set(t, shingle_words).view(np.int64) for t in batch["text"]]})

    return texts.select("fp", "text").mapInPandas(run, "fp long, shingles array<long>")


def _overlaps(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (u, v, ...) whose sizes allow them to be near and whose wide fingerprints differ in few enough bits, with
    both, the exact number of shingles in common, and near: whether their Jaccard similarity is NEAR or more."""
    part, whole = NEAR
    side = lambda name: nodes.select(F.col("fp").alias(name), F.col("wide").alias(f"_w{name}"), F.col("size").alias(f"_n{name}"))
    close = (F.least("_nu", "_nv") * whole >= F.greatest("_nu", "_nv") * part) & _close("_wu", "_wv", F.col("_nu"), F.col("_nv"))
    pairs = checkpointed(pairs)
    n = pairs.count()
    pairs = gathered(pairs, n)
    ends = checkpointed(gathered(pairs.groupBy("u").agg(F.count("*").alias("n")), n))
    few = checkpointed(join_hot(pairs, side("u"), "u", ends, n, HUBS).join(side("v"), "v").where(close).select(*pairs.columns))
    end = lambda name: sets.select(F.col("fp").alias(name), F.col("shingles").alias(f"_s{name}"))
    # one centre may be in most pairs; its set may be long, so few are broadcast
    n = few.count()
    few = gathered(few, n)
    counts = checkpointed(gathered(few.groupBy("u").agg(F.count("*").alias("n")), n))
    found = join_hot(few, end("u"), "u", counts, n, HUBS).join(end("v"), "v").withColumn("both", F.size(F.array_intersect("_su", "_sv")))
    near = _enough(F.size("_su"), F.size("_sv"), F.col("both"))
    return gathered(checkpointed(found.select(*pairs.columns, "both", near.alias("near"))), n)


def near_copy_labels(nodes: DataFrame, sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(fp, label) for each text of ``nodes`` that is linked to others over ``shared`` cells."""
    small = nodes.join(shared.select("fp").distinct(), "fp", "left_semi").select("fp", "wide", "size")
    small = checkpointed(small)
    small = gathered(small, small.count(), GATHER_WIDE)
    return linked_components(shared, small, sets, lambda pairs: _overlaps(pairs, small, sets))


def keep_one_of_each(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id. Columns stay as they are.

    Near copies are texts whose sets of ``shingle_words``-word shingles have a Jaccard similarity of NEAR or more; groups
    are what such links connect. Candidates share a block of their wide SimHash and its anchor; each is verified by the
    Hamming distance of the fingerprints and then by its whole sets. Null, empty and wordless texts are one group. Of
    repeated rows of the kept id and text one stays, and of several texts of that id the one with the smallest hash; an
    id is preferred to a null one. An empty table stays empty.
    """
    names = docs.columns
    marked = checkpointed(wide_fingerprints(docs, shingle_words))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")
    firsts = [F.first(c).alias(c) for c in ("wide", "size", "keys")]
    nodes = checkpointed(marked.groupBy("fp").agg(F.min(order).alias("best"), F.count("*").alias("n"), *firsts))
    shared = shared_cells(nodes.select("fp", F.explode("keys").alias("key")))
    wanted = nodes.join(shared.select("fp").distinct(), "fp", "left_semi").select("fp", F.col("best.doc_id").alias("_want"), F.col("best.own").alias("_mark"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_own"), "text")
    # rows repeated with id and text come as often; one of each set stays
    same = F.col("_id").eqNullSafe(F.col("_want")) & (F.col("_own") == F.col("_mark"))
    found = texts.join(broadcast_if_small(checkpointed(wanted)), same).select("fp", "text")
    repeated = not marked.groupBy("doc_id", "own").count().where("count > 1").isEmpty()
    sets = checkpointed(shingle_sets(found.dropDuplicates(["fp"]) if repeated else found, shingle_words))
    labels = near_copy_labels(nodes, sets, shared)
    placed = checkpointed(nodes.select("fp", "best", "n").join(labels, "fp", "left").select("fp", "best", "n", F.coalesce("label", "fp").alias("label")))
    kept = placed.groupBy("label").agg(F.min("best").alias("kept"))
    members = placed.groupBy("label").agg(F.count("*").alias("n"))
    chosen = checkpointed(join_hot(placed.select("fp", "label", F.col("n").alias("rows")), kept, "label", members, placed.count()))
    gone = join_hot(marked.select("fp", order.alias("here")), chosen.select("fp", "kept"), "fp", chosen.select("fp", F.col("rows").alias("n")), marked.count())
    gone = checkpointed(gone.where(F.col("here") != F.col("kept")).select(F.col("here.doc_id").alias("_gone"), F.col("here.own").alias("_mark")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_own"))
    held = rows.join(broadcast_if_small(gone), F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_own") == F.col("_mark")), "left_anti")
    if repeated:
        held = held.dropDuplicates(["_id", "_own"])
    return held.select("_row.*")
