"""Document fingerprints: a Merkle tree over paragraphs and sections, in native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import checkpointed

#: A paragraph ends at a line end. A section begins after blank lines and at a heading line. A sentence (the leaves of the
#: tree) ends after its marks and the blanks behind them, or after this many characters.
BLANK, HEADING = r"^[ \t\r\n]*$", r"^#{1,6} "
PARAGRAPH = r"(?<=\n)"
SENTENCE = r"[^.!?|]{0,200}[.!?|]*\s*"
#: Parts of the written fingerprint: root, then sections, then paragraphs, which are their sentences' digests.
ROOT_SEP, SECTION_SEP, PARAGRAPH_SEP = "|", "/", ","


def _hex16(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def _paragraph(leaves: Column) -> Column:
    return F.xxhash64(leaves)


def _section(paragraphs: Column) -> Column:
    return F.xxhash64(F.transform(paragraphs, _paragraph))


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the Merkle tree of its non-null column ``text``: struct(root, sections).

    Sections hold paragraphs, these the 64-bit digests of their sentences. A paragraph's digest is that of its
    sentences', a section's that of its paragraphs' digests, the root that of the sections' digests and of nothing else,
    so any branch can be checked by itself. The text without characters has no section. Equal texts have equal roots, and
    equal roots mean equal texts, but for collisions of 64-bit hashes.
    """
    some = lambda parts: F.filter(parts, lambda p: p != "")
    sentences = lambda p: F.transform(some(F.regexp_extract_all(p, F.lit(SENTENCE), F.lit(0))), lambda x: F.xxhash64(x))
    out = df.withColumn("_lines", some(F.split(F.col(text), PARAGRAPH)))
    out = out.withColumn("_blank", F.transform("_lines", lambda l: l.rlike(BLANK))).withColumn("_paragraphs", F.transform("_lines", sentences))
    new = lambda l, i: (i == 0) | l.rlike(HEADING) | ((i > 1) & F.get("_blank", i - 1) & ~F.get("_blank", i))
    out = out.withColumn("_starts", F.filter(F.transform("_lines", lambda l, i: F.when(new(l, i), i + 1).otherwise(0)), lambda i: i > 0))
    end = lambda i: F.coalesce(F.get("_starts", i + 1), F.size("_paragraphs") + 1)
    out = out.withColumn("_sections", F.transform("_starts", lambda start, i: F.slice("_paragraphs", start, end(i) - start)))
    out = out.drop("_lines", "_blank", "_paragraphs", "_starts")
    return out.withColumn(name, F.struct(F.xxhash64(F.transform("_sections", _section)).alias("root"), F.col("_sections").alias("sections"))).drop("_sections")


def fingerprint_text(tree: Column) -> Column:
    """``root|section/section/...`` of a tree: the root in 16 hex digits; a section is its paragraphs, joined by commas, of the
    last 8 hex digits of each sentence's digest."""
    short = lambda h: F.lower(F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    paragraph = lambda p: F.array_join(F.transform(p, short), "")
    section = lambda s: F.array_join(F.transform(s, paragraph), PARAGRAPH_SEP)
    return F.concat(_hex16(tree["root"]), F.lit(ROOT_SEP), F.array_join(F.transform(tree["sections"], section), SECTION_SEP))


def _split_equal(df: DataFrame, a: str, b: str, digest: Callable[[Column], Column], front: str, back: str) -> DataFrame:
    """``df`` with the arrays ``a`` and ``b`` cut to the range in which the ``digest`` of their elements differ, and with the
    numbers of equal elements before (``front``) and after it (``back``)."""
    out = df.withColumn("_da", F.transform(a, digest)).withColumn("_db", F.transform(b, digest))
    for name in (front, back):  # the equal ones at the front, then at the back of what is left
        same = F.zip_with("_da", "_db", lambda p, q: p.isNotNull() & q.isNotNull() & (p == q))
        out = out.withColumn("_first", F.array_position(same, False).cast("int"))
        out = out.withColumn(name, F.when(F.col("_first") > 0, F.col("_first") - 1).otherwise(F.size("_da")))
        if name == front:
            rest = lambda x: F.reverse(F.slice(x, F.col(front) + 1, F.size(x)))
            out = out.withColumn("_da", rest("_da")).withColumn("_db", rest("_db"))
    middle = lambda x: F.slice(x, F.col(front) + 1, F.greatest(F.lit(0), F.size(x) - F.col(front) - F.col(back)))
    return out.withColumn(a, middle(a)).withColumn(b, middle(b)).drop("_da", "_db", "_first")


def with_likeness(df: DataFrame, a: str, b: str, name: str, where: str | None = None) -> DataFrame:
    """``df`` with the likeness, 0 to 1, of its tree columns ``a`` and ``b``, and in ``where`` the place of the edit.

    Both trees are descended where digests differ: equal sections at either end are left out, then equal paragraphs at
    either end of what remains, then equal sentences; the sentences left are compared as often as both hold each. Equal
    roots give 1, and only they. Else the likeness is the share of the larger tree's sentences that both hold; trees of
    the same n sentences in another order have n / (n + 1), as if the root were one more. Two empty trees are equal.

    ``where`` is struct(section, paragraph, paragraphs): the section of ``a`` in which it begins to differ from ``b``, the
    first paragraph to differ (counted in all of ``a``) and how many paragraphs of ``a`` differ from there on; null for equal
    trees. All count from 0.
    """

    def tagged(leaves: str, side: int) -> Column:
        return F.transform(leaves, lambda x: F.struct(x.alias("x"), F.lit(side).alias("side")))

    def step(acc: Column, leaf: Column) -> Column:
        # of a run of equal leaves, first those of a, then those of b: each of b takes one of a that is left
        left = F.when(leaf["x"] == acc["x"], acc["left"]).otherwise(F.lit(0))
        taken = (leaf["side"] == 1) & (left > 0)
        return F.struct(leaf["x"].alias("x"), F.when(leaf["side"] == 0, left + 1).when(taken, left - 1).otherwise(left).alias("left"), (acc["both"] + taken.cast("int")).alias("both"))

    leaves = lambda c: F.aggregate(F.flatten(F.col(c)["sections"]), F.lit(0), lambda n, p: n + F.size(p))
    equal = F.col(a)["root"] == F.col(b)["root"]
    part = lambda c: F.when(equal, F.array().cast("array<array<array<bigint>>>")).otherwise(F.col(c)["sections"])
    out = df.withColumn("_na", leaves(a)).withColumn("_nb", leaves(b)).withColumn("_a", part(a)).withColumn("_b", part(b))
    out = _split_equal(out, "_a", "_b", _section, "_s", "_")
    out = out.withColumn("_a", F.flatten("_a")).withColumn("_b", F.flatten("_b"))
    out = _split_equal(out, "_a", "_b", _paragraph, "_p", "_").withColumn("_differ", F.size("_a"))
    out = out.withColumn("_a", F.flatten("_a")).withColumn("_b", F.flatten("_b"))
    out = _split_equal(out, "_a", "_b", lambda x: x, "_l", "_")
    start = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).alias("left"), F.lit(0).alias("both"))
    out = out.withColumn("_both", F.aggregate(F.sort_array(F.concat(tagged("_a", 0), tagged("_b", 1))), start, step, lambda acc: acc["both"]) + F.col("_na") - F.size("_a"))
    most = F.greatest("_na", "_nb")
    value = F.when(equal, F.lit(1.0)).otherwise(F.col("_both").cast("double") / F.when(F.col("_both") == most, most + 1).otherwise(most))
    out = out.withColumn(name, value)
    if where:
        before = F.aggregate(F.slice(F.col(a)["sections"], F.lit(1), F.col("_s")), F.lit(0), lambda n, s: n + F.size(s))
        place = F.struct(F.col("_s").alias("section"), (before + F.col("_p")).alias("paragraph"), F.col("_differ").alias("paragraphs"))
        out = out.withColumn(where, F.when(~equal, place))
    return out.drop("_na", "_nb", "_a", "_b", "_s", "_p", "_l", "_", "_differ", "_both")


def followers(keys: DataFrame) -> DataFrame:
    """``keys`` (distinct rows of doc_id, h, n) with prev_id, prev_h and prev_n, the row before each in their order.

    The first row's predecessor is the last row. The order is by doc_id (null first), then h. Rows are dealt by ranges;
    only a range's first row needs its neighbour range's last, and there is one such row for each range.
    """
    spark = keys.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.asc_nulls_first("doc_id"), F.asc("h")]
    dealt = checkpointed(keys.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()))
    one = F.struct(F.col("doc_id").isNotNull().alias("some"), F.col("doc_id").alias("doc_id"), F.col("h").alias("h"), F.col("n").alias("n"))
    lasts = dealt.groupBy("part").agg(F.max(one).alias("last"))
    # one row for each range: at most spark.sql.shuffle.partitions
    ends = Window.orderBy("part")
    total = lasts.agg(F.max("last").alias("last"))
    starts = lasts.select("part", F.lag("last").over(ends).alias("before")).join(F.broadcast(total))
    starts = starts.select("part", F.coalesce("before", "last").alias("before"))
    w = Window.partitionBy("part").orderBy(*order)
    rows = dealt.withColumn("_prev", F.lag(one).over(w)).join(F.broadcast(starts), "part")
    prev = F.coalesce("_prev", "before")
    return rows.select("doc_id", "h", "n", prev["doc_id"].alias("prev_id"), prev["h"].alias("prev_h"), prev["n"].alias("prev_n"))


def fingerprints_and_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_doc_id, edit) for each row;
    edit is the place (section, paragraph, paragraphs) where the edited text differs, null where it does not.

    The edit replaces the last floor(n_chars / 4) code points by the first as many (or all) of the next document's.
    The next document is the next by (doc_id with null first, hash of the text), after the last the first; repeated
    rows count as one document there and each come back. A table of one document is its own next. Null texts are
    empty texts. An empty table gives an empty result.

    Texts are shuffled once, by their key; what a document gives to the one before it (the few characters needed and
    its fingerprint) is shuffled to that key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("h", F.xxhash64("text")).withColumn("n", F.length("text").cast("long"))
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), h.cast("string"))
    order = followers(rows.select("doc_id", "h", "n").distinct())
    order = order.select(key(F.col("doc_id"), F.col("h")).alias("key"), key(F.col("prev_id"), F.col("prev_h")).alias("prev"), "prev_n")
    full = with_tree(rows.withColumn("key", key(F.col("doc_id"), F.col("h"))), "text", "tree").drop("h")
    # a running count, as a rank would be cut before the shuffle; all columns are used on both sides, so that the
    # shuffle of the texts is one and is read twice
    running = Window.partitionBy("key").orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once = full.withColumn("_count", F.count("*").over(running)).where("_count = 1")
    given = once.join(order, "key").select(
        F.col("prev").alias("key"),
        F.expr("substring(text, 1, cast(least(n, prev_n div 4) as int))").alias("start"),
        F.col("tree").alias("next_tree"),
        F.col("doc_id").alias("next_doc_id"),
    )
    edited = F.concat(F.expr("substring(text, 1, cast(n - n div 4 as int))"), F.col("start"))
    both = full.join(given, "key").withColumn("edited", edited).drop("text", "start")
    out = with_tree(both, "edited", "edited_tree").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    out = with_likeness(out, "tree", "edited_tree", "near_edited", "edit")
    out = with_likeness(out, "tree", "next_tree", "near_next")
    written = [fingerprint_text(F.col("tree")).alias("fingerprint"), fingerprint_text(F.col("edited_tree")).alias("edited_fingerprint")]
    return out.select("doc_id", F.col("n").alias("n_chars"), "edited_sha256", *written, "near_edited", "near_next", "next_doc_id", "edit")
