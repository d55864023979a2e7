"""Secret scans in native expressions: fixed base patterns, and a randomness test battery over long tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import checkpointed

# The base patterns, in the order of their kinds.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: Shortest second group of an assignment.
ASSIGN_CHARS = 6
KINDS = ("assign", "access", "hex", "random")

#: Tokens that the battery judges: at least this long.
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Lengths at which a band of tokens ends; each band and encoding has a threshold of its own.
BANDS = (24, 32, 40, 48, 64, 96)
#: Bins of the combined p-value in a band's histogram, and the share of false discoveries that a band may keep.
BINS, FALSE_SHARE = 200, 0.1
#: What a band is taken to hold before any token of it is seen: PRIOR random tokens above the edge of its length (in BINS) and
#: as many others right below it. Slugs of words pass an edge more rarely the longer they are, so longer tokens need a lower one.
PRIOR, PRIOR_EDGES = 100, (10, 10, 4, 2, 1, 1, 1)


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Array of (start, end, kind, value) of the matches of ``pattern``; offsets in code points, end exclusive.

    The pieces between matches and the matches alternate, so the offsets are running sums of their lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<s:int,e:int,k:int,v:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("s"), end.alias("e"), F.lit(kind).alias("k"), x["m"].alias("v"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    spans = F.aggregate(pairs, state, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _assign_spans(text: Column) -> Column:
    value = lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2))
    return F.filter(_spans(text, ASSIGN, 0), lambda x: value(x) >= ASSIGN_CHARS)


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of a standard normal deviate, by the Abramowitz-Stegun rational approximation (7.1.26)."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), poly * F.exp(-x * x)))


def _battery(value: Column) -> tuple[Column, Column]:
    """(encoding, p): the inferred encoding of a token and its combined p-value under "characters drawn uniformly".

    The encoding is the smallest alphabet that holds all characters: digits, hex of either case, Base32, else Base64 in
    the standard or the URL alphabet. Three tests: chi-squared of the character counts against the uniform alphabet
    (Wilson-Hilferty, in the tail where counts are too uneven), Wald-Wolfowitz runs above and below the middle of the
    alphabet, and the serial correlation of neighbours. Fisher's sum of the three logs follows chi-squared with six
    degrees of freedom.
    """
    body = F.rtrim(value, F.lit("="))
    kinds = (("dec", "^[0-9]+$", "0123456789"), ("hex", "^[0-9a-f]+$", "0123456789abcdef"), ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"), ("b32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    encoding, alphabet = F.lit("b64"), F.when(value.rlike("[-_]"), F.lit(letters + "-_")).otherwise(F.lit(letters + "+/"))
    for name, pattern, symbols in reversed(kinds):
        encoding = F.when(body.rlike(pattern), F.lit(name)).otherwise(encoding)
        alphabet = F.when(body.rlike(pattern), F.lit(symbols)).otherwise(alphabet)
    return encoding, F.struct(body.alias("body"), alphabet.alias("alphabet"))


def judged_tokens(tokens: DataFrame) -> DataFrame:
    """``tokens`` (with a column v) plus encoding, band and p of the battery; one row in, one row out."""
    encoding, parts = _battery(F.col("v"))
    t = tokens.withColumn("encoding", encoding).withColumn("_p", parts)
    codes = F.transform(F.split(F.col("_p.body"), ""), lambda c: F.position(c, F.col("_p.alphabet")) - 1)
    t = t.withColumn("_x", F.filter(codes, lambda c: c >= 0)).withColumn("_n", F.size("_x").cast("double")).withColumn("_k", F.length("_p.alphabet").cast("double"))
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, b: a + b)
    # chi-squared from the run lengths of the sorted characters: sum of squared counts
    sorted_codes = F.array_sort("_x")
    squares = F.aggregate(
        sorted_codes,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
        lambda a, c: F.struct(c.alias("last"), F.when(c == a["last"], a["run"] + 1).otherwise(F.lit(1.0)).alias("run"), (a["sum"] + F.when(c == a["last"], 2 * a["run"] + 1).otherwise(F.lit(1.0))).alias("sum")),
        lambda a: a["sum"],
    )
    t = t.withColumn("_chi", F.col("_k") / F.col("_n") * squares - F.col("_n"))
    free = F.col("_k") - 1
    cube = (F.pow(F.col("_chi") / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    p_chi = F.when(cube > 0, _normal_tail(cube) / 2).otherwise(1 - _normal_tail(cube) / 2)
    # runs above and below the middle of the alphabet
    high = F.transform("_x", lambda c: (c >= F.col("_k") / 2).cast("int"))
    t = t.withColumn("_h", high)
    pairs = F.zip_with(F.slice("_h", F.lit(1), F.size("_h") - 1), F.slice("_h", F.lit(2), F.size("_h") - 1), lambda a, b: (a != b).cast("double"))
    t = t.withColumn("_runs", 1 + total(pairs)).withColumn("_ups", F.aggregate("_h", F.lit(0.0), lambda a, b: a + b))
    downs = F.col("_n") - F.col("_ups")
    mean = 2 * F.col("_ups") * downs / F.col("_n") + 1
    variance = (mean - 1) * (mean - 2) / F.greatest(F.lit(1.0), F.col("_n") - 1)
    p_runs = F.when(variance > 0, _normal_tail((F.col("_runs") - mean) / F.sqrt(variance))).otherwise(F.lit(0.0))
    # serial correlation of neighbours
    average = total(F.transform("_x", lambda c: c.cast("double"))) / F.col("_n")
    t = t.withColumn("_m", average)
    spread = total(F.transform("_x", lambda c: (c - F.col("_m")) * (c - F.col("_m"))))
    lagged = total(F.zip_with(F.slice("_x", F.lit(1), F.size("_x") - 1), F.slice("_x", F.lit(2), F.size("_x") - 1), lambda a, b: (a - F.col("_m")) * (b - F.col("_m"))))
    p_serial = F.when(spread > 0, _normal_tail((lagged / spread + 1 / F.col("_n")) * F.sqrt(F.col("_n")))).otherwise(F.lit(0.0))
    half = lambda p: -F.log(F.greatest(p, F.lit(1e-12)))  # noqa: E731  half of Fisher's term
    y = half(p_chi) + half(p_runs) + half(p_serial)
    p = F.exp(-y) * (1 + y + y * y / 2)
    band = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        band = F.when(F.length("v") < BANDS[i], F.lit(i)).otherwise(band)
    out = t.withColumn("p", F.coalesce(p, F.lit(0.0))).withColumn("band", band)
    return out.drop("_p", "_x", "_n", "_k", "_chi", "_h", "_runs", "_ups", "_m")


def thresholds(judged: DataFrame) -> DataFrame:
    """(encoding, band, least): the smallest p from which tokens of a band count as random; a row for each band.

    Each distinct token is one test, however often it stands in the corpus. Random tokens have uniform p, all others
    pile up near 0. As many random ones as the upper half of p shows twice are expected; a threshold is the least edge
    above which the tokens beyond what uniform p accounts for stay within FALSE_SHARE, the band's PRIOR tokens counted in.
    So one rule holds for bands of any size: a band with few tokens has the edge of its length, and the more there are the
    less the prior weighs. Short tokens give the tests little power, so their bands need a higher edge: the control
    follows the length. Where no edge stays within the share, the threshold is above all tokens. Built on a histogram of at
    most BINS rows a band, summed over the whole corpus.
    """
    by = ("encoding", "band")
    distinct = judged.select(*by, "v", "p").distinct()
    bins = distinct.groupBy(*by, F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    above = Window.partitionBy(*by).orderBy(F.desc("bin"))
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(Window.partitionBy(*by))
    edge = F.element_at(F.array(*map(F.lit, PRIOR_EDGES)), F.col("band") + 1)
    others = F.when(F.col("bin") < edge, PRIOR).otherwise(0)
    kept = F.sum("n").over(above)
    false = kept - 2 * upper * (1 - F.col("bin") / BINS) + others
    least = F.when(false <= FALSE_SHARE * (kept + PRIOR + others), F.col("bin"))
    found = bins.withColumn("_least", least).groupBy(*by).agg(F.coalesce(F.min("_least"), F.greatest(F.max(edge), F.max("bin") + 1)).alias("_bin"))
    return found.select(*by, (F.col("_bin") / BINS).alias("least"))


def scanned(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, base (spans of the three patterns) and tokens (spans for the battery) of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_assign_spans(text), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    return docs.select(*carry, F.array_sort(base).alias("base"), _spans(text, TOKEN, 3).alias("tokens"))


def found_secrets(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The ``carry`` columns of each row of ``docs``, its base spans and all its spans, sorted by start, then kind.

    The battery adds the tokens that pass their band's threshold and are not wholly inside a base span. One pass over
    the texts; what it finds is small and is written to the checkpoint folder under a key of its own for each row.
    """
    rows = checkpointed(scanned(docs, *carry).withColumn("_at", F.monotonically_increasing_id()))
    judged = checkpointed(judged_tokens(rows.select("_at", F.explode("tokens").alias("t")).select("_at", "t", F.col("t.v").alias("v"))))
    # at most one row for each encoding and band
    passed = judged.join(F.broadcast(thresholds(judged)), ["encoding", "band"]).where("p >= least")
    more = passed.groupBy("_at").agg(F.collect_list("t").alias("more"))
    out = rows.join(more, "_at", "left")
    added = F.filter(F.coalesce("more", F.array().cast("array<struct<s:int,e:int,k:int,v:string>>")), lambda x: ~F.exists("base", lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"])))
    by_kind = F.transform(F.concat("base", added), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return out.select(*carry, "base", F.array_sort(by_kind).alias("spans"))


def spans_text(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of ``docs``.

    Null and empty texts have no spans (base_sha256 is that of the empty string); repeated rows each come back; null
    ids stay null; an empty table gives an empty result; other columns are not looked at.
    """
    found = found_secrets(docs, ["doc_id"])
    base = F.array_sort(F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span replaced by ``mark`` and n_chars counted again; overlapping spans become one mark.

    Null and empty texts stay as they are, repeated rows each come back with equal texts, an empty table stays empty.
    """
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), "text")
    # rows without any candidate, nearly all, pass by; only the others are written and joined
    looked = scanned(held, "_row", "text").withColumn("_any", F.size("base") + F.size("tokens") > 0)
    found = found_secrets(looked.where("_any").select("_row", "text"), ["_row"])
    others = looked.where("NOT _any").select(*[F.col(f"_row.`{n}`").alias(n) for n in names])
    text = F.coalesce(F.col("_row.text"), F.lit(""))

    def step(acc: Column, x: Column) -> Column:
        piece = F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), piece.alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col("_row.text"))
    out = {"text": F.col("_new"), "n_chars": F.length("_new").cast("long")}
    marked = found.withColumn("_new", new).select(*[out.get(n, F.col(f"_row.`{n}`")).alias(n) for n in names])
    return others.unionAll(marked)
