"""The prefix trie against a plain one and SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tracewright.llm import queries as Q
from tracewright.llm import trie

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c], key=lambda x: x[0])]
    made = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(int(c / 20) * 20, [])[:h] + mine[h:]  # the remainder has the sign of c
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in kids.get(key, [])) or 1
        saved[key] = sum(saved[k] for k in kids.get(key, [])) + (len(nodes[key]) - 1) * (words(key[-1][1]) if key else 0)
    out = []
    for key, cs in nodes.items():
        ends = sorted(c for c in cs if len(made[c]) == len(key))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(cs), len(key), min(nodes[key[:-1]]) if key else None, len(cs), len(kids.get(key, [])), leaves[key], saved[key], sha))
    return sorted(out, key=str)


def got(spark, rows, partitions=8):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
        assert df.columns == COLUMNS
        return sorted((tuple(r) for r in df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def talk(r, n, kinds=3, longest=6):
    return [(c, k, r.choice(["user", "assistant"]) if kinds > 2 else "user", f"say {r.randrange(kinds)} " * r.randrange(1, 3)) for c in range(n) for k in range(r.randrange(1, longest))]


@pytest.mark.parametrize(("seed", "kinds", "partitions"), [(1, 3, 8), (2, 2, 40), (3, 1, 25), (4, 2, 1)])
def test_equal_to_a_plain_trie(spark, seed, kinds, partitions):
    r = random.Random(seed)
    rows = talk(r, 160, kinds, 8)
    rows += [(1000 + c, k, "user", f"say {k} ") for c in range(70) for k in range(5)]  # copies over many blocks
    r.shuffle(rows)
    assert got(spark, rows, partitions) == plain(rows)


def test_deep_and_nested(spark):
    rows = [(20 * c, k, "user", "same words") for c in range(40) for k in range(c + 1)]  # each a prefix of the next
    rows += [(20_000, k, "user", "same words" if k < 300 else f"other {k}") for k in range(500)]
    assert got(spark, rows, 12) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (0, None, "system", "first"), (0, 1, None, None), (0, 2, "user", ""), (1, 5, "u", "only one"), (2, 1, "user", "a"), (3, 1, "user", "a"), (23, 1, "user", "absent head"), (23, 2, "user", "b"), (24, 0, "x", "y"), (-7, 1, "user", "minus"), (40, 1, "user", "long " * 50_000), (41, 1, "user", "Ä b\x1fc d"), (60, 1, "a", "bc"), (80, 1, "ab", "c")]
    assert got(spark, rows) == plain(rows)
    same = [(5, 1, "user", "x y"), (5, 1, "user", "x y"), (5, 1, "user", "x y"), (5, 1, "user", "x y")]  # repeated rows are repeated turns
    assert got(spark, same) == plain(same)
    assert got(spark, [(c, 1, "user", "x") for c in range(3)], 5) == plain([(c, 1, "user", "x") for c in range(3)])
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = talk(random.Random(9), 30)
    more = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("x", "tokens", "key", "words", "block", "_h", "_base", "depth", "value", "side")})
    assert sorted((tuple(r) for r in trie.conversation_trie(more).collect()), key=str) == plain(rows)


def test_nearest_smaller():
    r = random.Random(3)
    for _ in range(50):
        v = [r.randrange(4) for _ in range(r.randrange(1, 30))]
        left, right, first = trie.nearest_smaller(v)
        for i, x in enumerate(v):
            assert left[i] == max((j for j in range(i) if v[j] < x), default=-1)
            assert right[i] == min((j for j in range(i + 1, len(v)) if v[j] < x), default=len(v))
            assert first[i] == min(j for j in range(len(v)) if v[j] == x and left[j] == left[i])
    assert trie.common(b"a" * 48, b"a" * 32 + b"b" * 16) == 2 and trie.common(b"", b"a" * 16) == 0 and trie.common(b"b" * 16, b"a" * 32) == 0


def test_query_equals_plain_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = Q.op11_conversation_trie(spark, SMALL)
    result = sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)
    assert result == plain(rows)
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    assert sorted(c.execute(f"select {', '.join(COLUMNS)} from ({Q.OP11_SQL})").fetchall(), key=str) == result
