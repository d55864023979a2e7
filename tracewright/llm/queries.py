"""The opN_ queries over the driver's tables: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import bpe, bytecnn, codes, decontaminate, licenses, media, merkle, mixing, secrets, simhash, toxicity, trie, urls
from tracewright.llm.common import table

#: Rank file of op9, by its name among the public tokenizers.
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.fingerprint_text(groups["fp"]).alias("fingerprint"), "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_urls(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints_and_edits(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_mixing, op3_url_filter, op4_toxicity, op5_secrets, op6_licenses, op7_media, op8_quality, op9_bpe, op10_merkle, op11_conversation_trie, op12_decontamination, op13_vector_codes)}


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows of ten words, found by a join on their text; each document word has the list of the ten words from it on.
OP12_SQL = f"""
with d as materialized (select row_number() over () rn, doc_id, {_WORDS} w from documents),
p as (select rn, unnest(w) word, generate_subscripts(w, 1) i from d),
g as (select rn, i, [word, {', '.join(f"lead(word, {k}) over x" for k in range(1, 10))}] as l from p window x as (partition by rn order by i)),
b as (select item_id, {_WORDS} w from benchmark),
n as (select item_id, w, unnest(range(greatest(len(w) - 9, 1))) i from b where len(w) > 0),
win as materialized (select distinct item_id, least(len(w), 10) k, array_to_string(w[i + 1 : i + 10], ' ') s from n),
k as (select distinct k from win),
o as materialized (select rn, i, k.k, item_id from g join k on l[k.k] is not null join win on win.k = k.k and s = array_to_string(l[1 : k.k], ' ')),
h as (select rn, count(distinct spot) n_hit from (select rn, unnest(range(i, i + k)) as spot from o) group by rn),
m as (select rn, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct rn, item_id::varchar item from o) group by rn)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(items, '')) items_sha256, n_hit is not null as contaminated
from d left join h using (rn) left join m using (rn)"""


#: CRC-32 of an id's decimal bit by bit; a node is its depth and the turns' digests up to it, end to end.
OP11_SQL = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role, text) pos from conversations where conv_id is not null),
b as (select distinct conv_id, conv_id::varchar s from t),
c as (select conv_id, (4294967295 - list_reduce(list_prepend(4294967295::ubigint, flatten(list_transform(string_split(s, ''), lambda ch: list_transform(range(8), lambda k: ((ascii(ch) >> k::int) & 1)::ubigint)))),
  lambda x, y: case when xor(x & 1, y) = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)) % 4 as h from b),
r as (select c.conv_id, 0 part, t.pos, role, text from c join t on t.conv_id = c.conv_id - c.conv_id % 20 and pos <= h union all select c.conv_id, 1, t.pos, role, text from c join t on t.conv_id = c.conv_id and pos > h),
o as (select conv_id, row_number() over (partition by conv_id order by part, pos) d, md5(length(role) || ':' || role || text) k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) w from r),
p as materialized (select conv_id, d, string_agg(k, '') over (partition by conv_id order by d) as key, w from o union all select conv_id, 0, '', 0 from c),
n as materialized (select d, key, min(conv_id) m, count(*) n, min(w) w from p group by d, key),
x as (select conv_id, max(d) d from p group by conv_id),
e as (select d, key, string_agg(conv_id::varchar, ',' order by conv_id) ids from x join p using (conv_id, d) group by d, key),
u as materialized (select n.d, n.key, up.d ud, up.key ukey, n.n, n.w from n join p up on up.conv_id = n.m and up.d <= n.d),
ch as (select ud d, ukey as key, count(*) n_children from u where d = ud + 1 group by ud, ukey),
lv as (select ud d, ukey as key, count(*) n_leaves from u anti join ch on u.d = ch.d and u.key = ch.key group by ud, ukey),
sv as (select ud d, ukey as key, sum((n - 1) * w)::bigint saved_tokens from u group by ud, ukey),
pa as (select u.d, u.key, n.m from u join n on n.d = u.ud and n.key = u.ukey where u.ud = u.d - 1)
select n.m conv_id, d as depth, pa.m parent_conv_id, n.n n_convs, coalesce(n_children, 0) n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) ends_sha256
from n join lv using (d, key) join sv using (d, key) left join ch using (d, key) left join pa using (d, key) left join e using (d, key)"""


def oracle_sql() -> dict[str, str]:
    """SQL of the last three; each result of the first ten has parts that SQL cannot express (XXH64, learned scores,
    tokenizers, seeded choices)."""
    return {"op11_conversation_trie": OP11_SQL, "op12_decontamination": OP12_SQL}
