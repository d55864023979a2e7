"""The corpus pipeline stage by stage."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tracewright.llm import bytecnn, mixing, secrets

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "secret scans", "mixing sources", "byte-level BPE"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        assert out.count() > 0
        if k < 4:
            assert out.columns == docs.columns
            docs = out.cache()
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0


def test_stages_on_odd_and_empty_tables(spark, odd, make):
    for docs in (odd, make([])):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SMALL)
        assert corpus_pipeline.STAGES[4][1](spark, docs, SMALL).count() <= 2 * n


def test_content_of_each_stage(spark):
    """Each stage against a brute-force version on what its predecessor kept."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    quality, dedup, scan, mix, encode = (s for _, s in corpus_pipeline.STAGES)
    scores = {r.doc_id: r.score for r in bytecnn.quality(docs, labels).collect()}
    good = quality(spark, docs, SMALL).cache()
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= bytecnn.KEEP_FROM}

    rows = sorted((r.doc_id, r.text or "") for r in good.collect())
    sets = []
    for _, text in rows:
        w = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        w = re.findall("[^\x20\x09-\x0d]+", w)
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    kept = dedup(spark, good, SMALL).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[g][0] for g in group}) and len(set(group)) < len(rows)

    planted = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" password = hunter2pass and more"))).otherwise(F.col("text"))
    kept = kept.withColumn("text", planted).cache()  # the small table has no secrets of its own
    clean = scan(spark, kept, SMALL).cache()
    spans = {r.doc_id: r.spans for r in secrets.secret_scan(kept).collect()}
    before = {r.doc_id: r.text or "" for r in kept.collect()}
    marked = 0
    for r in clean.collect():
        text, at, out = before[r.doc_id], 0, ""
        for _, s, e in sorted((x.split(":") for x in filter(None, spans[r.doc_id].split(","))), key=lambda x: int(x[1])):
            out += text[at : int(s)] + "[SECRET]" if int(s) >= at else ""
            at = max(at, int(e))
        assert (r.text or "") == out + text[at:]
        marked += bool(at)
    assert marked

    mixed = mix(spark, clean, SMALL).cache()
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    taken, got = {r.doc_id: r.taken for r in mixing.mix(clean).collect()}, Counter()
    for r in mixed.collect():
        got[r.doc_id] += words(r.text)
    assert got == Counter({i: n for i, n in taken.items() if n})

    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    rows = encode(spark, mixed, SMALL).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == want and all(r.n_tokens > 0 for r in rows)


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} and out.count() > 0
