"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import broadcast_if_small, checkpointed, join_hot

#: Weights of the sources in order of their names (null last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: The mix takes this share of all words; no source gives more than REPEATS times its own.
SHARE, REPEATS = 1.5, 2
#: Words in a block, and in a shard on average: shards grow in number with the corpus, not in size.
BLOCK, SHARD_WORDS = 16, 1_000_000
SEED = 17


def placed(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with place, that of a row (from 0) in the ``order``, a total one, of its group.

    Rows are dealt by ranges of group and order; a range's first place in a group is the number of the group's rows in the
    ranges before it, so that no group is one task.
    """
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = checkpointed(rows.repartitionByRange(ranges, *by, *order).withColumn("_part", F.spark_partition_id()))
    # a row for each group and one more for each range that a group goes on in
    starts = dealt.groupBy("_part", *by).agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", *by, (F.sum("_rows").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_rows")).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)) - 1
    numbered = dealt.withColumn("_within", within).join(broadcast_if_small(starts), ["_part", *by])
    return numbered.withColumn("place", F.col("_start") + F.col("_within")).drop("_part", "_start", "_within")


def ranked(found: DataFrame) -> DataFrame:
    """``found`` (source, n) with rank, its place (from 0) in the order of the names by code point, null last."""
    return placed(found, [], [F.col("source").isNull(), F.col("source")]).withColumnRenamed("place", "rank")


def with_targets(found: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``found`` (source, n) with rank and target: shares by weight, held at ``repeats`` times n, the excess reshared by weight.

    All targets are least(weight * level, repeats * n); the level rises with the sources that are full until none is
    added. Each round is one aggregate of the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    out = checkpointed(ranked(found).withColumn("weight", weight))
    size, total = out.agg(F.sum("n"), F.sum("weight")).first()
    level = share * (size or 0) / total if total else 0.0
    while True:
        full = F.col("weight") * level > repeats * F.col("n")
        held, free = out.agg(F.sum(F.when(full, F.col("n"))), F.sum(F.when(~full, F.col("weight")))).first()
        rise = (share * (size or 0) - repeats * (held or 0)) / free if free else level
        if rise <= level:
            return out.withColumn("target", F.least(F.col("weight") * level, repeats * F.col("n").cast("double"))).drop("weight")
        level = rise


def join_plan(rows: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``plan``, one row a key, whose column n (dropped) counts the rows of the key; keys may be hot."""
    groups = plan.drop("n")
    small = broadcast_if_small(groups)
    if small is not groups:
        return rows.join(small, key)
    return join_hot(rows, groups, key, plan.select(key, "n"), plan.agg(F.sum("n")).first()[0] or 0)


def with_seats(rows: DataFrame, by: str, place: str, votes: str) -> DataFrame:
    """``rows`` with blocks: in each group ``by`` its ``seats`` (a column, one value a group) go by Sainte-Lague to the
    highest quotients votes / (2k + 1); of equal quotients the row earlier by ``place`` gets its seat first.

    The quotients above a divisor d number round(votes / 2d) a row, at most half a seat from votes / 2d. So of n rows the
    divisor that makes these sum up to seats - n / 2 gives no seat too many and the one for seats + n / 2 none too few.
    Seats below the first are sure; only those between the two, about 2n, are listed and put into one distributed order.
    Groups without votes give no seats.
    """
    groups = checkpointed(rows.groupBy(by).agg(F.sum(votes).alias("_sum"), F.count("*").alias("n")).withColumn("_n", F.col("n")))
    seats = lambda more: F.col(votes) * F.greatest(F.lit(0.0), F.col("seats") + more * (F.col("_n") / 2 + 1)) / F.col("_sum")
    sure, most = (F.when(F.col("_sum") > 0, F.floor(seats(more) + 0.5)).otherwise(F.lit(0)).cast("long") for more in (-1, 1))
    held = checkpointed(join_plan(rows, groups, by).withColumn("_sure", sure).withColumn("_most", F.least(most, "seats")).drop("_sum", "_n"))
    left = held.groupBy(by).agg((F.max("seats") - F.sum("_sure")).alias("_left"), F.sum(F.col("_most") - F.col("_sure")).alias("n"))
    open_ = held.where("_most > _sure").select(by, F.col(place).alias("_at"), F.col(votes).alias("_v"), F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_k"))
    listed = placed(open_.select(by, "_at", (F.col("_v") / (2 * F.col("_k") + 1)).alias("_q")), [by], [F.desc("_q"), F.col("_at")])
    won = join_plan(listed, checkpointed(left), by).where("place < _left").groupBy(by, F.col("_at").alias(place)).agg(F.count("*").alias("_won"))
    return held.join(won, [by, place], "left").withColumn("blocks", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop("_sure", "_most", "_won")


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, doc_id, source, size (words of the whole text; null: 0) and a seeded order key of each row."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    seeded = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))
    return docs.select(*keep, F.col("doc_id"), F.col("source"), size.alias("size"), seeded.alias("_order"))


def _key() -> Column:
    """The source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def plan_sources(rows: DataFrame) -> DataFrame:
    """(key, rank, source_size, target, blocks, shards, n) of each source of ``rows`` from sized(); n is its rows.

    Everything stays in tables, however many sources there are; the driver sees sums only.
    """
    found = checkpointed(rows.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.count("*").alias("rows")))
    wanted = checkpointed(with_targets(found.select("source", "n")))
    total = found.agg(F.sum("n")).first()[0]
    seats = F.lit(round(min(SHARE, REPEATS) * (total or 0) / BLOCK)).cast("long")
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / SHARD_WORDS)).cast("int")
    planned = with_seats(wanted.withColumn("mix", F.lit(0)).withColumn("seats", seats), "mix", "rank", "target").select(_key().alias("key"), "rank", F.col("n").alias("source_size"), "target", "blocks", shards.alias("shards"))
    return checkpointed(planned.join(found.select(_key().alias("key"), F.col("rows").alias("n")), "key"))


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's plan and their shard, a hash bucket, so that a source with a third of all rows is
    spread as far as its size asks."""
    both = join_plan(rows.withColumn("key", _key()), sources, "key")
    shard = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("_order"), F.col("doc_id")), F.col("shards")).cast("int")
    return both.withColumn("shard", shard).drop("key", "shards")


def plan_shards(spread: DataFrame) -> DataFrame:
    """(rank, shard, shard_size, take) of rows from with_source(): each source's blocks apportioned to its shards."""
    held = checkpointed(spread.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"), F.max("blocks").alias("seats")))
    take = F.least(F.col("blocks") * BLOCK, REPEATS * F.col("shard_size"))
    return with_seats(held, "rank", "shard", "shard_size").select("rank", "shard", "shard_size", take.alias("take"))


def mixed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` of sized(), with source_size, target, taken (words, repeats counted) and the part of the text they are.

    In each shard the documents stand in seeded order as one stream of words, cut into equal blocks; the shard's quota
    is that many whole passes of the stream and then its first blocks. So a document is taken whole ``passes`` times
    and by its first ``extra`` words once more, and only the last document of a shard's quota is cut.
    """
    spread = with_source(rows, sources)
    quota = broadcast_if_small(checkpointed(plan_shards(spread)))
    spread = spread.join(quota, ["rank", "shard"])
    order = Window.partitionBy("rank", "shard").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("size").over(order) - F.col("size")
    whole = F.when(F.col("shard_size") > 0, F.expr("take div shard_size")).otherwise(F.lit(0))
    left = F.col("take") - F.col("passes") * F.col("shard_size")
    out = spread.withColumn("_before", before).withColumn("passes", whole)
    out = out.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_before"))))
    return out.withColumn("taken", F.col("passes") * F.col("size") + F.col("extra")).drop("_before", "shard_size", "take", "blocks")


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``.

    Null texts have size 0, null sources are one source that comes last; repeated rows each count; reruns agree, as
    rows are ordered by a seeded hash of id and text (equal rows may change places, which changes nothing but which of
    them is cut). An empty table gives an empty result.
    """
    rows = checkpointed(sized(docs))
    return mixed(rows, plan_sources(rows)).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: a document once for each whole pass and once more with its first extra words.

    Each shard's choice comes down to a point in its order, so the texts are joined to one row a source and one a shard
    and are not shuffled, unless these are too many to broadcast. Equal rows at such a point share its words evenly, rounded down. The columns stay as they are and
    n_chars is counted again. Documents without words, and those of which nothing is taken, do not come back.
    """
    names = docs.columns
    counts = checkpointed(sized(docs))
    sources = plan_sources(counts)
    chosen = mixed(counts, sources).groupBy("rank", "shard", "_order", "doc_id", "passes")
    chosen = chosen.agg(F.sum("extra").alias("extra"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    open_at = F.when(F.col("extra") < F.col("size"), F.struct(F.col("_order").alias("o"), F.col("doc_id").alias("d"), F.expr("extra div rows").alias("part")))
    cuts = chosen.groupBy("rank", "shard").agg(F.first("passes").alias("_passes"), F.min(open_at).alias("_cut"))
    cuts = broadcast_if_small(checkpointed(cuts))
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), "doc_id", "source", "text")
    rows = rows.withColumn("_order", F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    both = with_source(rows, sources).join(cuts, ["rank", "shard"])
    here, cut = F.struct(F.col("_order"), F.col("doc_id")), F.struct(F.col("_cut.o"), F.col("_cut.d"))
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    more = (
        F.when(F.col("_cut").isNull() | (here < cut), F.array("text"))
        .when((here == cut) & (F.col("_cut.part") > 0), F.array(F.array_join(F.slice(words, F.lit(1), F.col("_cut.part").cast("int")), "")))
        .otherwise(F.array().cast("array<string>"))
    )
    out = both.select("_row", F.explode(F.concat(F.array_repeat(F.col("text"), F.col("_passes").cast("int")), more)).alias("_part"))
    new = {"text": F.col("_part"), "n_chars": F.length("_part").cast("long")}
    return out.select(*[new.get(n, F.col(f"_row.`{n}`")).alias(n) for n in names])
