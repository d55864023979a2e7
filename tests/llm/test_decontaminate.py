"""Benchmark windows in documents against plain Python and SQL."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from tracewright.llm import decontaminate as D
from tracewright.llm import queries as Q

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
SMALL = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        for a in range(max(len(w) - 9, 1 if w else 0)):
            windows.setdefault(tuple(w[a : a + 10]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit.update(range(a, a + k))
                    found |= windows[tuple(w[a : a + k])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    df = D.contamination(d, b)
    assert df.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_text(r, n, vocabulary="a b c A é 中 x9".split(), marks=(" ", "\n", ". ", "-", "  ", "\x00", "~")):
    return "".join(r.choice(vocabulary) + r.choice(marks) for _ in range(n))


def test_equal_to_plain_search(spark):
    r = random.Random(5)
    items = [(i, random_text(r, r.choice([1, 2, 3, 5, 9, 10, 11, 14]), ["a", "B", "é"])) for i in range(25)]
    docs = [(i, random_text(r, r.choice([0, 1, 2, 9, 10, 30, 700]), ["a", "b", "É", "é"])) for i in range(80)]
    docs += [(100 + i, random_text(r, 5) + random_text(random.Random(i % 7), 30, ["a", "b", "c"]) + items[i % 25][1]) for i in range(40)]
    assert found(spark, docs, items) == plain(docs, items)


def test_long_windows_only(spark):
    r = random.Random(6)
    many = [f"w{i}" for i in range(40)]
    items = [(i, random_text(r, 30, many)) for i in range(30)]
    docs = [(i, random_text(r, 400, many) + items[i % 30][1][5:120] + random_text(r, 900, many)) for i in range(60)]
    docs += [(7, docs[7][1])] * 20  # copies are rows of their own
    assert found(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark, odd_rows):
    docs = [(i, t) for i, t in odd_rows]
    items = [(1, None), (2, ""), (3, " .\n"), (4, "word"), (None, "two WORDS"), (5, "one two three four. Five six seven!\nEight nine ten."), (5, "long text of many words here"), (10, "tis it"), (9, "a" * 5000), (2, "中文 \U0001f600")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, []) == plain(docs, [])
    assert found(spark, [], items) == []


def test_blocks_of_windows_give_the_same(spark, odd):
    items = spark.createDataFrame([(1, "one two three"), (2, "three four"), (2, "nine ten"), (3, "of many words here long"), (4, "one two three")], "item_id long, text string")
    whole = sorted(map(str, D.occurrences(odd, items).collect()))
    assert sorted(map(str, D.occurrences(odd, items, block=2).collect())) == whole
    assert any("start" in r for r in whole)


def test_clashing_columns_and_cleaning(spark, clashing, odd):
    items = spark.createDataFrame([(1, "three four five")], "item_id long, text string")
    from pyspark.sql import functions as F

    more = clashing.withColumns({c: F.lit("x") for c in ("_words", "_spans", "_items", "w", "window", "item")})
    assert sorted(map(str, D.contamination(more, items).collect())) == sorted(map(str, D.contamination(odd, items).collect()))
    kept = D.without_passages(more, items)
    assert kept.columns == [c for c in more.columns if not c.startswith("_")] + [c for c in more.columns if c.startswith("_")] or set(kept.columns) == set(more.columns)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()}.isdisjoint({6, 10})


def test_search_skips_places():
    r = random.Random(1)
    text = " ".join(f"w{r.randrange(5000)}" for _ in range(50_000)).encode()
    windows = [" ".join(f"v{r.randrange(5000)}" for _ in range(10)).encode() for _ in range(500)]
    search = D.Search(windows, list(range(500)), 10)
    at, number, looked = search.found(D.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    assert not len(at) and not len(number) and looked < 50_000 / 7


@pytest.mark.parametrize("texts", [["ab", "cd", "", "e f", " g", "é"], ["", ""], ["Ab"]])
def test_words_end_with_their_text(texts):
    raw = [t.encode() for t in texts]
    w = D.Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = [[w.raw[w.start[k] : w.end[k]].tobytes().decode() for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [words(t) for t in texts]


def test_query_equals_sql(spark):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = Q.op12_decontamination(spark, SMALL)
    want = c.execute(f"select {', '.join(df.columns)} from ({Q.OP12_SQL})").fetchall()
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(want)
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(*cols).collect()] for t, cols in (("documents", ["doc_id", "text"]), ("benchmark", ["item_id", "text"])))
    assert sorted(got, key=str) == plain(docs, items)
    assert any(r[-1] for r in got)
