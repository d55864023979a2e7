"""The ten operators against brute force, exact round trips and odd inputs."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracewright.llm import bpe, bytecnn, licenses, media, merkle, mixing, secrets, simhash, toxicity, urls
from tracewright.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"
WHITE = "[^\x20\x09-\x0d]+"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---- 1


def slow_simhash(text):
    w = re.findall(WHITE, lower(text))
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(rows):
    fps = [(i, slow_simhash(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 2:
                parent[find(a)] = find(b)
    low = defaultdict(list)
    for a, (i, _) in enumerate(fps):
        low[find(a)] += [] if i is None else [i]
    return sorted(((i, f, min(low[find(a)], default=None)) for a, (i, f) in enumerate(fps)), key=str)


def unsigned(rows):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in rows), key=str)


def test_simhash_groups(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert unsigned(simhash.near_duplicate_groups(docs).collect()) == slow_groups(rows)


def test_simhash_odd(odd, odd_rows, clashing, make):
    want = slow_groups(odd_rows)
    assert unsigned(simhash.near_duplicate_groups(odd).collect()) == want == unsigned(simhash.near_duplicate_groups(clashing).collect())
    assert simhash.near_duplicate_groups(make([])).count() == 0


@pytest.mark.parametrize("cap", [2, 64])
def test_links_of_full_buckets(spark, monkeypatch, cap):
    monkeypatch.setattr(simhash, "PAIR_CAP", cap)
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(6)]
    marks = set(base)
    for _ in range(150):
        x = rng.choice(sorted(marks))
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        marks.add(x)
    df = spark.createDataFrame([(int(np.uint64(m).view(np.int64)),) for m in marks], "fp long")
    got = {r.id: r.label for r in simhash.connected(simhash.links(df)).collect()}
    signed = sorted(int(np.uint64(m).view(np.int64)) for m in marks)
    label = {m: m for m in signed}
    for _ in signed:
        for a in signed:
            for b in signed:
                if bin((a ^ b) % 2**64).count("1") <= 2:
                    label[a] = min(label[a], label[b])
        if all(label[label[a]] == label[a] for a in signed):
            pass
    assert all(got.get(m, m) == label[m] for m in signed)


def test_keep_one_of_each(odd, clashing):
    kept = simhash.keep_one_of_each(odd).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([1, 4, 5, 6, 7, 8, 9, 12, None], key=str)
    assert simhash.keep_one_of_each(clashing).columns == clashing.columns
    assert simhash.keep_one_of_each(odd.where("false")).count() == 0


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = str(rng.random())
    return out


def near_labels(sets):
    """Smallest index reachable over pairs at a Jaccard similarity of 0.8 or more."""
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4 and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return label


def families(rng):
    """Families of copies with up to a fifth of their words edited, cut or added, some of copies of copies, some without their base."""
    texts = []
    for size in (80, 40, 25, 8, 2, 1, 1, 1):
        base = [str(rng.randrange(3000)) for _ in range(rng.randint(40, 150))]
        for k in range(size):
            own = edited(rng, base, rng.randint(0 if size > 30 else 1, 1 + len(base) // 45))
            own = own[: len(own) - rng.randint(0, 3)] if k % 3 == 0 else own + [str(rng.random()) for _ in range(rng.randint(0, 2))] if k % 3 == 1 else own
            texts.append(own)
            base = edited(rng, base, 1) if rng.random() < 0.1 else base
    return sorted({" ".join(t) for t in texts})


@pytest.mark.parametrize("cap", [2, 16])
@pytest.mark.parametrize("one_bucket", [True, False])
def test_near_copies_of_families_against_brute_force(spark, make, monkeypatch, cap, one_bucket):
    monkeypatch.setattr(simhash, "WIDE_PAIRS", cap)
    texts = families(random.Random(cap))
    want = near_labels([shingles(t) for t in texts])
    assert 15 < len(set(want)) < len(want) - 50
    if not one_bucket:
        kept = simhash.keep_one_of_each(make(list(enumerate(texts)))).collect()
        assert sorted(r.doc_id for r in kept) == sorted(set(want))
        return
    own = [simhash.shingle_set(t) for t in texts]
    nodes = spark.createDataFrame([(i, np.packbits(simhash.wide_simhash(x)).view(np.int64).tolist(), len(x)) for i, x in enumerate(own)], "fp long, wide array<long>, size int")
    sets = spark.createDataFrame([(i, x.view(np.int64).tolist()) for i, x in enumerate(own)], "fp long, shingles array<long>")
    shared = spark.createDataFrame([(i, 7, len(texts)) for i in range(len(texts))], "fp long, key long, n long")
    got = {r.fp: r.label for r in simhash.near_copy_labels(nodes, sets, shared).collect()}
    assert [got.get(i, i) for i in range(len(texts))] == want


def test_family_pairs_grow_with_its_size(spark, monkeypatch):
    rng, counts = random.Random(9), []
    for size in (200, 800):
        base = [str(rng.randrange(10**6)) for _ in range(120)]
        own = [simhash.shingle_set(" ".join(edited(rng, base, k % 9))) for k in range(size)]
        sets = spark.createDataFrame([(i, x.view(np.int64).tolist()) for i, x in enumerate(own)], "fp long, shingles array<long>")
        shared = spark.createDataFrame([(i, 7, size) for i in range(size)], "fp long, key long, n long")
        nodes = spark.createDataFrame([(i, np.packbits(simhash.wide_simhash(x)).view(np.int64).tolist(), len(x)) for i, x in enumerate(own)], "fp long, wide array<long>, size int")
        made = []

        def counted(pairs, nodes=nodes, sets=sets, made=made):
            made.append(pairs.count())
            return simhash._overlaps(pairs, nodes, sets)

        simhash.linked_components(shared, nodes, sets, counted)
        counts.append(sum(made))
    assert counts[0] <= 2 * 200 and counts[1] <= 2 * 800


def test_keep_one_of_near_copies(make):
    rng, rows = random.Random(3), []
    for i in range(20):
        base = [str(rng.randrange(3000)) for _ in range(200)]
        rows += [(10 * i + 1, " ".join(base)), (10 * i + 2, " ".join(edited(rng, base, 2))), (10 * i + 3, " ".join(edited(rng, base, 150)))]
    kept = sorted(r.doc_id for r in simhash.keep_one_of_each(make(rows)).collect())
    assert kept == sorted(10 * i + k for i in range(20) for k in (1, 3))


def shingles(text):
    w = text.split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_copies_are_exact(make):
    rng, rows = random.Random(4), []
    for i in range(150):  # pairs at 0.8 to 0.9, and at 0.7 to below 0.8, by the share of words at the end that differ
        base = [str(rng.randrange(10**6)) for _ in range(rng.randint(10, 120))]
        for k in range(1, len(base)):
            other = base[:-k] + [str(rng.randrange(10**6)) for _ in range(k)]
            a, b = shingles(" ".join(base)), shingles(" ".join(other))
            if len(a & b) < (0.9 if i % 2 else 0.8) * len(a | b):
                break
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other[: len(base)]))]
    near = [len(shingles(a) & shingles(b)) * 5 >= len(shingles(a) | shingles(b)) * 4 for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)]
    want = sorted([2 * i for i in range(150)] + [2 * i + 1 for i in range(150) if not near[i]])
    assert 30 < sum(near) < 120 and sorted(r.doc_id for r in simhash.keep_one_of_each(make(rows)).collect()) == want


# ---- 2


def slow_seats(seats, votes):
    got = [0] * len(votes)
    for _ in range(seats if any(votes) else 0):
        got[max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_seats_are_highest_quotients(spark):
    """Groups of every shape in one table: no votes, ties, one row with nearly all votes, fewer seats than rows."""
    rng = random.Random(4)
    groups = [(rng.randint(0, 40), [rng.choice([0.0, 1.0, 7.0, rng.random() * 100]) for _ in range(rng.randint(1, 9))]) for _ in range(60)]
    groups += [(5, [0.0, 0.0]), (0, [3.0, 1.0]), (7, [1.0] * 50), (120, [1.0] * 50), (90, [1e6, *[1.0] * 60]), (1, [2.0, 2.0])]
    table = spark.createDataFrame([(g, i, v, seats) for g, (seats, votes) in enumerate(groups) for i, v in enumerate(votes)], "g int, i int, v double, seats long")
    got = {(r.g, r.i): r.blocks for r in mixing.with_seats(table.repartition(5), "g", "i", "v").collect()}
    for g, (seats, votes) in enumerate(groups):
        assert [got[g, i] for i in range(len(votes))] == slow_seats(seats, votes)
    assert mixing.with_seats(table.limit(0), "g", "i", "v").count() == 0


def test_shards_follow_the_size(make, monkeypatch):
    """A hot source is cut into as many shards as its words ask for; what the mix takes still comes near the targets."""
    df = make([(i, "word " * (i % 40)) for i in range(1200)]).withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise("rare"))
    monkeypatch.setattr(mixing, "SHARD_WORDS", 20)
    rows = mixing.sized(df)
    spread = mixing.with_source(rows, mixing.plan_sources(rows))
    shards = mixing.plan_shards(spread).collect()
    assert len(shards) > 500 and all(0 <= r["take"] <= 2 * r.shard_size for r in shards)
    blocks = {r["rank"]: r.blocks for r in spread.select("rank", "blocks").distinct().collect()}
    for k, n in blocks.items():
        own = sorted((r for r in shards if r["rank"] == k), key=lambda r: r.shard)
        assert [r["take"] for r in own] == [min(16 * b, 2 * r.shard_size) for b, r in zip(slow_seats(n, [float(r.shard_size) for r in own]), own, strict=True)]
    out = mixing.mix(df).collect()
    assert all(0 <= r.taken <= 2 * r["size"] for r in out)


def slow_targets(sizes):
    rest, out, weight = 1.5 * sum(sizes), [0.0] * len(sizes), [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    free = set(range(len(sizes)))
    while free:
        total = sum(weight[i] for i in free)
        full = [i for i in free if rest * weight[i] / total > 2 * sizes[i]]
        for i in full or free:
            out[i] = 2.0 * sizes[i] if full else rest * weight[i] / total
        if not full:
            break
        free -= set(full)
        rest -= sum(out[i] for i in full)
    return out


def test_targets_and_seats_against_the_list(spark):
    rng = random.Random(6)
    for sizes in ([100, 100, 100], [10, 1000], [], [rng.choice([0, 3, 50, rng.randrange(10**6)]) for _ in range(300)], [7] * 40):
        names = [None, "", *(f"s{i:03}é" for i in range(len(sizes)))][: len(sizes)]
        names.sort(key=lambda s: (s is None, (s or "").encode()))
        found = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, n long")
        rows = mixing.with_targets(found).orderBy("rank").collect()
        assert [r.source for r in rows] == names and [r["rank"] for r in rows] == list(range(len(sizes)))
        assert [r.target for r in rows] == pytest.approx(slow_targets(sizes))
        for seats in (1, 1000):
            table = spark.createDataFrame([(0, r["rank"], r.target, seats) for r in rows], "mix int, rank long, target double, seats long")
            got = [r.blocks for r in mixing.with_seats(table, "mix", "rank", "target").orderBy("rank").collect()]
            assert got == slow_seats(seats, [r.target for r in rows])


def test_mix_with_more_sources_than_are_broadcast(make, monkeypatch):
    rows = make([(i, "word " * (i % 50)) for i in range(300)]).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 40).cast("string"))))
    want = sorted(mixing.mix(rows).collect())
    assert want and sorted(map(str, mixing.mixed_documents(rows).collect()))
    texts = sorted(map(str, mixing.mixed_documents(rows).collect()))
    monkeypatch.setattr("tracewright.llm.common.BROADCAST_ROWS", 3)
    assert sorted(mixing.mix(rows).collect()) == want and sorted(map(str, mixing.mixed_documents(rows).collect())) == texts


@pytest.mark.parametrize("which", ["docs", "odd", "clashing"])
def test_mix(request, which):
    df = request.getfixturevalue(which)
    rows = mixing.mix(df).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df.repartition(3)).collect()))
    size = {(r.doc_id, r.text): len(re.findall(WHITE, r.text or "")) for r in df.collect()}
    assert Counter(r["size"] for r in rows) == Counter(size[r.doc_id, r.text] for r in df.collect())
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by = defaultdict(lambda: [0, 0.0, 0])
    source = df.select("doc_id", "source").distinct()
    for r in mixing.mixed(mixing.sized(df), mixing.plan_sources(mixing.sized(df))).collect():
        by[r.source][0] += r.taken
        by[r.source][1], by[r.source][2] = r.target, r.source_size
    assert len(by) == source.select("source").distinct().count()
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    assert [by[s][1] for s in names] == pytest.approx(slow_targets([by[s][2] for s in names]))
    assert all(abs(t - want) <= mixing.BLOCK * 2 for t, want, _ in by.values())


def test_mixed_documents_holds_the_taken_words(docs, clashing, make):
    for df in (docs, clashing):
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        got = Counter()
        for r in out.collect():
            got[r.doc_id] += len(re.findall(WHITE, r.text))
        want = Counter()
        for r in mixing.mix(df).collect():
            want[r.doc_id] += r.taken
        assert all(abs(got[k] - v) <= (1 if k == 6 and df is clashing else 0) for k, v in want.items())
    assert mixing.mixed_documents(make([])).count() == 0 and mixing.mix(make([])).count() == 0


# ---- 3

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = lower(re.split("[/?#]", rest, maxsplit=1)[0])
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    fits = [r for _, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark):
    odd = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/", "http://com/x", "http://com", "http://x.net/es/1", "http://x.net/es", "http://evilcom/a", "http://a.com://b/c", "http://a.com?x/en/", "http://é.com/\n/é#q"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(odd)] + [(3, "http://q.org/a", "h")], "page_id long, url string, verdict string")
    pages = pages.unionByName(spark.read.parquet(f"{SMALL}/pages.parquet").withColumnRenamed("html", "verdict"))
    rows = urls.judged_urls(pages).collect()
    src = defaultdict(list)
    for r in pages.collect():
        src[r.page_id].append(slow_rule(r.url))
    verdict = {r: v for v, r in RULES}
    for r in rows:
        assert (r.host, r.path, r.rule) in src[r.page_id] and (r.rule is None or r.verdict == verdict[r.rule]) and r.verdict in ("allow", "block")
    assert len(rows) == pages.count()
    assert urls.judged_urls(pages.limit(0)).count() == 0


def symbols(url):
    return [0] * urls.ORDER + [int(urls._TABLE[b]) for b in url.split("://", 1)[-1].encode()]


def slow_probability(counts, context, x):
    """Witten-Bell over dictionaries: counts[context][symbol], contexts as tuples."""
    lower = 1 / urls.SYMBOLS if not context else slow_probability(counts, context[1:], x)
    if context == () or context in counts:
        own = counts[context]
        return (own[x] + len(own) * lower) / (sum(own.values()) + len(own)) if own else lower
    return lower


def slow_ratio(good, bad, url):
    models = []
    for some in (good, bad):
        counts = defaultdict(Counter)
        for u in some:
            c = symbols(u)
            for i in range(urls.ORDER, len(c)):
                for k in range(urls.ORDER + 1):
                    counts[tuple(c[i - k : i])][c[i]] += 1
        models.append(counts)
    c = symbols(url)
    logs = [np.log(slow_probability(models[0], tuple(c[i - urls.ORDER : i]), c[i])) - np.log(slow_probability(models[1], tuple(c[i - urls.ORDER : i]), c[i])) for i in range(urls.ORDER, len(c))]
    return float(np.mean(logs)) if logs else 0.0


@pytest.mark.parametrize("most", [200_000, 3])
def test_url_model_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr("tracewright.llm.common.BROADCAST_ROWS", most)
    good = [f"http://g{i}.com/news/{i}" for i in range(40)] + ["http://é.com/%20?a=b&c"]
    bad = [f"http://win-{i}.biz/casino/{i}" for i in range(40)] * 2
    new = ["http://h.com/news/7", "http://bet-7.biz/casino/8", "x", "", "http://"]
    rows = spark.createDataFrame([(u, 1) for u in good] + [(u, 0) for u in bad] + [(u, None) for u in [*new, None]], "url string, kind int")
    model = urls.train(rows.where("url IS NOT NULL"))
    got = {r.url: r.ratio for r in urls.with_ratio(rows, model).collect()}
    for u in [*new, good[3], bad[5], good[-1]]:
        assert got[u] == pytest.approx(slow_ratio(good, bad, u), abs=1e-5), u
    assert got[None] is None and got[new[0]] > 0 > got[new[1]]
    least = urls.calibrate(urls.with_ratio(rows, model).where("kind IS NOT NULL"))
    assert got[new[0]] >= least > got[new[1]]
    assert urls.train(rows.where("kind = 1")) is None


def test_undecided_urls_follow_the_held_back_threshold(spark):
    some = [f"http://www.site{i}.com/docs/{i}" for i in range(120)] + [f"http://shop{i}.net/es/oferta/{i}" for i in range(120)] + ["http://a.org/docs/1", "http://b.org/oferta/es/2"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(some)], "page_id long, url string")
    rows = {r.page_id: r for r in urls.judged_urls(pages).collect()}
    kinds = {i: 1 if i < 120 else 0 for i in range(240)}
    held = [i for i in kinds if spark.sql(f"SELECT pmod(xxhash64('{some[i]}'), {urls.CALIBRATE}) h").first().h == 0]
    good, bad = ([some[i] for i in kinds if kinds[i] == k and i not in held] for k in (1, 0))
    assert held and all(rows[i].ratio == pytest.approx(slow_ratio(good, bad, some[i]), abs=1e-5) for i in (held[0], 240, 241))
    assert rows[240].verdict == "allow" and rows[241].verdict == "block" and rows[240].rule is None


# ---- 4 and 8


def clause_weight(model, text):
    sums = [sum(w * np.exp(sum(v for k, v in model.modifiers.items() if marks & k)) for w, marks in found) for found in model.matches(text)]
    return max(sums, default=0.0)


def test_grammar():
    m = toxicity.ToxicityModel()
    f = lambda t: clause_weight(m, t)
    assert f("you idiot") > f("idiot") > f("someone said idiot") > 0 and f("idiot") > f("not an idiot") > 0 and f("idiot scum") > f("idiot") + f("scum")
    assert f("idiots. not") == 0 and f("not. idiot") == f("idiot") == f("no one two three idiot") and f("idiot like you") > 2 * f("idiot")
    assert f("kill time") == f("kill") == 0 < f("never kill you") < f("I kill you") and f("kill. you") == 0
    assert f("") == f(None) == 0.0 and f("idiotic") == 0.0
    assert m.score("you idiot") > m.score("idiot") > m.score("not an idiot") > m.score("") == m.score("kill")
    a, b = toxicity._machine(2, lambda s, c: (1 - s, 1)), toxicity._machine(3, lambda s, c: ((s + 1) % 3, 2 * (c % 2)))
    assert len(a.compose(b).arcs) == 6 and a.compose(b).arcs[0][3][1] == 3 and a.compose(b).arcs[0][2][1] == 1


def slow_marks(classes):
    """(place, marks) of each match in one clause, from its definition."""
    t = toxicity
    out = []
    for i, c in enumerate(classes):
        before = lambda kind, reach: any(classes[j] == kind and t.TARGET not in classes[j + 1 : i] for j in range(max(0, i - reach), i))  # noqa: B023, E731
        marks = 0
        if c == t.INSULT:
            marks = t.HIT | (t.PILED if before(t.INSULT, t.REACH) else 0) | (t.AIMED if t.TARGET in classes[:i] else 0) | (t.OWN if before(t.SELF, t.REACH) else 0)
        elif c == t.TARGET and (before(t.INSULT, t.REACH) or before(t.THREAT, t.REACH)):
            marks = t.HIT | t.AIMED
        if marks:
            reach = t.REACH + (2 if c == t.TARGET else 0)
            marks |= (t.NEGATED if t.NEGATION in classes[max(0, i - reach) : i] else 0) | (t.REPORTED if t.REPORT in classes[:i] else 0)
            out.append((i, marks))
    return out


def test_grammar_against_brute_force():
    rng, arcs = random.Random(5), toxicity.grammar().arcs
    for _ in range(3000):
        classes = [rng.choice(toxicity.CLASSES) for _ in range(rng.randint(0, 12))]
        state, got = 0, []
        for i, c in enumerate(classes):
            state, marks = arcs[state][c]
            if marks & toxicity.HIT:
                got.append((i, marks))
        assert got == slow_marks(classes), classes


def _hinted(seed, n=400):
    """Texts of made-up words; toxic ones hold two of a family of words close together, four in ten others two far apart."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ru", "te", "sna"]) for _ in range(rng.randrange(2, 5)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(250, 400))]
        mark = int(i % 5 == 0)
        at = rng.randrange(100)
        for k in sorted(rng.sample(range(30), 2)) if mark else [0, 100] if rng.random() < 0.4 else []:
            w[at + k] = "zorgum" + word()
        out.append((" ".join(x + ("." if rng.random() < 0.1 else "") for x in w), mark))
    return out


def test_one_state_machine_loses_against_the_grammar():
    """A machine that only says that a word is in the lexicon, refitted, tells the same texts apart clearly worse."""
    train, test = _hinted(1), _hinted(2)

    def right(model):
        model.fit(train)
        found = [(model.score(t) >= toxicity.THRESHOLD, y) for t, y in test]
        return sum(f for f, y in found if y), sum(f for f, y in found if not y)

    found, flagged = right(toxicity.ToxicityModel())
    plain = toxicity.ToxicityModel()
    plain.grammar = [[(0, toxicity.HIT if c <= toxicity.HINT else 0) for c in toxicity.CLASSES]]
    plain.runs = [[(0, 0) for _ in toxicity.CLASSES]] * (toxicity.SPAN + 1)
    low, high = right(plain)
    assert found >= 70 and flagged <= 2
    assert low <= found - 20 or high >= flagged + 20


def test_modifiers_of_matches():
    model = toxicity.ToxicityModel().fit([(f"some words here you idiot number{i}", 1) for i in range(40)] + [(f"some words here and more number{i}", 0) for i in range(120)])
    score = lambda t: model.score("some words here. " + t)
    assert score("you idiot") >= score("idiot") > score("i am idiot") and score("idiot") > score("never idiot") and score("idiot") > score("wrote idiot")
    hint = toxicity.ToxicityModel()
    hint.starts = {"zorgum": (toxicity.HINT, 5.0)}
    far = " ka" * (toxicity.SPAN + 1)
    assert hint.matches("zorgumka lo mi") == [] and hint.matches("zorgumka" + far + " zorgumlo") == []
    assert len(hint.matches("zorgumka. lo mi\nzorgumlo ru")) == 1 and len(hint.matches("idiot. lo zorgumlo")) == 2


def test_score_needs_the_grammar(docs, labels):
    y = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.text, y[r.doc_id]) for r in docs.collect() if r.doc_id in y and r.text]
    model = toxicity.ToxicityModel().fit(rows)
    toxic = [t for t, mark in rows if mark]
    assert np.mean([model.score(t) >= toxicity.THRESHOLD for t in toxic]) > 0.5 and min(model.weights[1:]) >= 0
    model.grammar, model.runs = [[(0, 0)] * 8], [[(0, 0)] * 8] * (toxicity.SPAN + 1)
    assert not any(model.score(t) >= toxicity.THRESHOLD for t, _ in rows)


def fold(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.mark.parametrize("run,label", [(toxicity.toxicity, "toxic"), (bytecnn.quality, "quality")])
def test_classifiers_never_see_the_held_out_fold(spark, docs, labels, run, label, make):
    twisted = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col(label)).otherwise(F.col(label)))
    a, b = (sorted(map(str, run(docs, x).collect())) for x in (labels, twisted))
    assert a == b
    for r in run(docs, labels).collect():
        assert r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= (0.7 if label == "toxic" else 0.5))
    assert run(make([]), labels).count() == 0


@pytest.mark.parametrize("run", [toxicity.toxicity, bytecnn.quality])
def test_classifiers_odd(odd, clashing, labels, run):
    a, b = (sorted(run(x, labels).collect(), key=str) for x in (odd, clashing))
    assert a == b and len(a) == 14 and all(r.held_out is not None and 0 <= r.score <= 1 for r in a)
    assert len({r.score for r in a if r.doc_id in (1, 2, 11)}) == 1
    assert all(0 <= r.score <= 1 for r in run(odd, labels.limit(0)).collect())


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    d, y = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    got = bytecnn.quality(d, y).join(y, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93
    got = toxicity.toxicity(d, y).join(y, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.97


def test_network_against_plain_loops():
    """Every window of every chunk by loops over bytes and filters, with whole texts in training."""
    rng = random.Random(3)
    rows = [("good words here " * rng.randint(1, 400), 1) for _ in range(6)] + [("$$ %% ## " * rng.randint(1, 90), 0) for _ in range(6)]
    net = bytecnn.ByteCNN().fit(rows, 2)
    for text in ("", "short", "plain words " * 60, "é$" * 700, None):
        raw = (text or "").encode()
        raw += bytes(max(0, bytecnn.WIDTH - len(raw)))
        chunks = []
        for start in range(0, len(raw) - bytecnn.WIDTH + 1, bytecnn.CHUNK):
            stop = min(len(raw) - bytecnn.WIDTH + 1, start + bytecnn.CHUNK)
            most = [max(sum(float(net.conv[k][raw[i + k], f]) for k in range(bytecnn.WIDTH)) for i in range(start, stop)) for f in range(bytecnn.FILTERS)]
            chunks.append([max(0.0, m + float(b)) for m, b in zip(most, net.bias, strict=True)])
        z = float(net.shift)
        for f in range(bytecnn.FILTERS):
            column = [c[f] for c in chunks]
            z += sum(column) / len(column) * float(net.mean_weight[f]) + max(column) * float(net.max_weight[f])
        assert net.score(text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_added_columns_replace_clashing_ones(spark, odd, labels):
    more = odd.withColumns({n: F.lit("x") for n in ("quality_score", "_text", "ids", "token_bytes")})
    assert bytecnn.score_documents(more, bytecnn.ByteCNN().freeze()).where("quality_score BETWEEN 0 AND 1").count() == odd.count()
    got = bpe.encoded(more, tokenizer_path()).select("ids", "token_bytes").collect()
    assert len(got) == odd.count() and all(len(r.ids) == len(r.token_bytes) for r in got)
    images = spark.createDataFrame([(media.media_tile(b"P5 1 1 255 a", None, None), "x", "y")], "content binary, tile string, error string")
    assert media.decoded_images(images.where("false"), "content").count() == 0 and media.decoded_images(images, "content").columns[0] == "content"


def test_network_sees_whole_texts():
    net = bytecnn.ByteCNN().freeze()
    text = "plain words here " * 200
    for at in (0, 511, 512, 1700):
        assert net.score(text[:at] + "%%%$$$&&&" + text[at:]) != net.score(text)
    raw = net.bytes_of(text)
    fast = net.pooled(raw)[0]
    net.pairs = None
    assert np.allclose(fast, net.pooled(raw)[0], atol=1e-5)


# ---- 5

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def slow_secrets(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)), [sum(x[1] == k for x in out) for k in range(3)]


EDGES = ["token=secret=abcdefg", "token=token :password=xx", "PassWord'  :  'AbCdEf1", "AKIAAKIA" + "A" * 20 + " AKIA", "\U0001f600é token: zzzzzz9 " + "f" * 24, "ſecret=abcdefgh toKen=abcdefgh", "api_key=123456,apikey:abcdef", "secret=a.b=c-d"]


def test_base_secrets(docs, odd, clashing, make):
    for df in (docs, odd, clashing, make(list(enumerate(EDGES)))):
        want = Counter()
        for r in df.collect():
            text, n = slow_secrets(r.text)
            want[r.doc_id, *n, hashlib.sha256(text.encode()).hexdigest()] += 1
        rows = secrets.secret_scan(df).collect()
        assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
        texts = {r.doc_id: slow_secrets(r.text)[0] for r in df.collect()}
        assert all(set(filter(None, texts[r.doc_id].split(","))) <= set(r.spans.split(",")) for r in rows)
    assert secrets.secret_scan(make([])).count() == 0


def test_battery_tells_random_tokens(spark):
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    tokens = [("".join(rng.choice(letters) for _ in range(40)), 1) for _ in range(300)] + [(f"section_{'the_of_and_in'.split('_')[i % 4] * 7}_{i % 7}aaaa", 0) for i in range(300)]
    df = spark.createDataFrame(tokens, "v string, y int")
    judged = secrets.judged_tokens(df)
    kept = judged.join(secrets.thresholds(judged), ["encoding", "band"]).where("p >= least").groupBy("y").count().collect()
    n = {r.y: r["count"] for r in kept}
    assert n.get(1, 0) > 240 and n.get(0, 0) < 15
    p = [r.p for r in judged.where("y = 1").collect()]
    assert 0.3 < np.mean(p) < 0.75


def slow_p(token):
    """(encoding, p) of a token, test by test in plain Python."""
    body = token.rstrip("=")
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [("dec", digits), ("hex", digits + "abcdef"), ("HEX", digits + "ABCDEF"), ("b32", upper + "234567"), ("b64", upper + upper.lower() + digits + ("-_" if set(token) & set("-_") else "+/"))]
    name, alphabet = next((n, a) for n, a in alphabets if n == "b64" or (body and set(body) <= set(a)))
    x = [alphabet.index(c) for c in body if c in alphabet]
    n, k = len(x), len(alphabet)
    tail = lambda z: math.erfc(abs(z) / math.sqrt(2))
    chi = sum((x.count(c) - n / k) ** 2 / (n / k) for c in range(k))
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    ps = [tail(z) / 2 if z > 0 else 1 - tail(z) / 2]
    high = [2 * c >= k for c in x]
    ups, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * ups * (n - ups) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    ps.append(tail((runs - mean) / math.sqrt(variance)) if variance > 0 else 0.0)
    m = sum(x) / n
    spread = sum((c - m) ** 2 for c in x)
    ps.append(tail((sum((a - m) * (b - m) for a, b in zip(x, x[1:])) / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 0.0)
    y = -sum(math.log(max(p, 1e-12)) for p in ps)
    return name, math.exp(-y) * (1 + y + y * y / 2)


def test_battery_against_plain_python(spark):
    rng = random.Random(21)
    sets = ["0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCXYZabcxyz0189+/", "abcdefghijklmnopqrstuvwxyz0123456789-_", "ab", "a"]
    tokens = {"".join(rng.choice(s) for _ in range(rng.randint(20, 130))) + "=" * rng.randint(0, 2) for s in sets for _ in range(25)}
    judged = secrets.judged_tokens(spark.createDataFrame([(t,) for t in sorted(tokens)], "v string")).collect()
    assert len(judged) == len(tokens)
    for r in judged:
        name, p = slow_p(r.v)
        assert r.encoding == name and r.p == pytest.approx(p, rel=2e-3, abs=2e-6), r.v
        assert r.band == sum(len(r.v) >= b for b in secrets.BANDS)


def slow_threshold(band, ps):
    """The least bin from which the false share, prior tokens counted in, is small enough."""
    at = [min(int(p * secrets.BINS), secrets.BINS - 1) for p in ps]
    upper, edge = sum(b >= secrets.BINS // 2 for b in at), secrets.PRIOR_EDGES[band]
    for b in sorted(set(at)):
        kept, others = sum(x >= b for x in at), secrets.PRIOR * (b < edge)
        if kept - 2 * upper * (1 - b / secrets.BINS) + others <= secrets.FALSE_SHARE * (kept + secrets.PRIOR + others):
            return b / secrets.BINS
    return max(edge, max(at) + 1) / secrets.BINS


def test_thresholds_have_one_rule_for_all_sizes(spark):
    """Against plain Python, from one token to thousands; more tokens of the same shares move the edge step by step."""
    rng = random.Random(22)
    bands = {}
    for i, (band, n, false) in enumerate((b, n, f) for b in (0, 3, 6) for n in (1, 5, 60, 199, 201, 3000) for f in (0.0, 0.5, 0.95)):
        bands[f"e{i}", band] = [rng.random() ** (6 if rng.random() < false else 1) for _ in range(n)]
    bands["bad", 2] = [0.6 + i * 1e-6 for i in range(1000)]
    rows = [(e, b, f"{e}-{i}", p) for (e, b), ps in bands.items() for i, p in enumerate(ps)]
    got = {(r.encoding, r.band): r.least for r in secrets.thresholds(spark.createDataFrame(rows, "encoding string, band int, v string, p double")).collect()}
    assert got == pytest.approx({k: slow_threshold(k[1], ps) for k, ps in bands.items()})
    assert got["bad", 2] > 0.6


def passed(spark, rows):
    judged = spark.createDataFrame(rows, "encoding string, band int, v string, p double")
    return {r.v for r in judged.join(secrets.thresholds(judged), ["encoding", "band"]).where("p >= least").collect()}


def test_copies_of_a_token_are_one_test(spark):
    slugs, keys = [("b64", 3, f"slug{i}", 0.001) for i in range(1000)], [("b64", 3, f"key{i}", (i + 0.5) / 1000) for i in range(1000)]
    assert passed(spark, [("b64", 3, "copied", 0.6)] * 3000 + slugs) == {"copied"}
    assert passed(spark, [("b64", 3, "copied", 0.2)] * 3000 + keys) >= {f"key{i}" for i in range(20, 1000)}


def test_lone_random_tokens(spark, make):
    for p in (0.1, 0.45, 0.6, 0.99):
        assert passed(spark, [("b64", 6, "lone", p), ("b64", 0, "words", 0.001)]) == {"lone"}
    rng = random.Random(12)
    lone = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(44))
    rows = secrets.secret_scan(make([(1, f"a key {lone} here"), (2, "the_name_of_a_function_of_many_words_in_it")])).collect()
    assert {r.doc_id: r.spans for r in rows} == {1: "random:6:50", 2: ""}


def test_redacted(odd, clashing):
    for df in (odd, clashing):
        out = secrets.redacted(df)
        assert out.columns == df.columns and out.count() == df.count()
        t = next(r for r in out.collect() if r.doc_id == 12)
        assert "hunter2pass" not in t.text and "AKIA" not in t.text and "0123456789abcdef" not in t.text and t.n_chars == len(t.text) and t.text.startswith('secret: "abc" ')
        assert Counter(r.text for r in out.collect() if r.doc_id not in (8, 12)) == Counter(r.text for r in df.collect() if r.doc_id not in (8, 12))


# ---- 6


def test_licenses(docs, odd, clashing, make):
    extra = make([(1, "CC-BY, cc  by. ccby cc by-sa All rights reserved General PUBLIC license"), (2, "Licensed under the Apache License, Version 2.0. éall rights reserved")])
    for df in (docs, odd, clashing, extra):
        want = Counter()
        for r in df.collect():
            w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(r.text))
            at = [(i, x) for p, x in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            where = [i for i, _ in at]
            want[r.doc_id, len(w), len(at), min(where, default=None), max(where, default=None), ",".join(sorted({x for _, x in at}))] += 1
        rows = licenses.license_scan(df).collect()
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    assert licenses.license_scan(make([])).count() == 0


@pytest.mark.parametrize(
    "text,label",
    [
        ("GNU General Public License version 3.0", "gpl,gpl-3.0"), ("GNU General Public License, version 2.0", "gpl,gpl-2.0"), ("GNU General Public License v2.0 or later", "gpl,gpl-2.0"), ("GNU General Public License version 2.1", "gpl"),
        ("GNU LGPL v2.1", "lgpl-2.1"), ("GNU AGPL v3", "agpl-3.0"), ("GNU LGPL version 3.0", "lgpl-3.0"), ("the GNU LGPL", "lgpl"), ("GNU GPL version 2", "gpl-2.0"), ("GPL version 2", "gpl-2.0"), ("GPLv3", "gpl-3.0"),
        ("CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"), ("CC BY-NC-ND 3.0", "cc-by,cc-by-nc-nd"), ("CC-BY-ND-4.0", "cc-by,cc-by-nd"), ("CC-BY-NC 4.0", "cc-by,cc-by-nc"), ("CC BY-SA", "cc-by,cc-by-sa"), ("Creative Commons Attribution 4.0", "cc-by"),
        ("MPL-2.0", "mpl-2.0"), ("MPL 1.1", "mpl-1.1"), ("EPL-2.0", "epl-2.0"), ("EPL v1.0", "epl-1.0"), ("Eclipse Public License 2.0", "epl-2.0"), ("Eclipse Public License - v 2.0", "epl-2.0"), ("Eclipse Public License", "epl"),
        ("MIT/X11", "mit"), ("mit-licensed", "mit"), ("MIT OR Apache-2.0", "apache-2.0,mit"), ("Apache-2.0 OR MIT", "apache-2.0,mit"), ("MIT/Apache-2.0", "apache-2.0,mit"), ("GPL-2.0-or-later AND BSD-3-Clause", "bsd-3-clause,gpl-2.0"), ("(MIT OR ISC) AND Zlib", "isc,mit,zlib"), ("Mozilla Public License 2.0", "mpl-2.0"), ("Mozilla Public License, v. 2.0", "mpl-2.0"), ("Unlicense", "unlicense"), ("an unlicensed copy", ""), ("mit or without", ""),
    ],
)
def test_license_names_in_use(text, label):
    assert licenses.scan_text(text)[5] == label


def test_license_rules():
    assert len(licenses.rules()) > 200 and len({(r.label, r.kind, r.pattern.pattern) for r in licenses.rules()}) == len(licenses.rules())
    label = lambda t: licenses.scan_text(t)[5]
    assert label("Licensed under the Apache License, Version 2.0.") == "apache-2.0"
    assert label("SPDX-License-Identifier: GPL-2.0-or-later") == "gpl-2.0"
    assert label("under the GNU Lesser General Public License") == "gpl,lgpl"
    assert label("GNU Affero General Public License") == "agpl,gpl"
    assert label("tous droits réservés") == "reserved" and label("das mit dem") == "" and label("Released under the MIT License.") == "mit"
    kept = licenses.detections(b"released under the mit license, gnu general public license v3")
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:], strict=False))
    score = lambda t: licenses.scan_text(t)[6]
    assert score("the MIT License") < score("licensed under the terms of the MIT License") == 1.0


@pytest.mark.parametrize(
    "text,label",
    [
        ("gplv3", "gpl-3.0"), ("gpl 3", "gpl-3.0"), ("GPL v3", "gpl-3.0"), ("gpl3", "gpl-3.0"), ("agplv3", "agpl-3.0"), ("agpl-3.0", "agpl-3.0"), ("lgplv2.1", "lgpl-2.1"),
        ("bsd-3-clause", "bsd-3-clause"), ("under the BSD 3-Clause License", "bsd-3-clause"), ("Licensed under GPLv3", "gpl-3.0"), ("Apache-2.0 license", "apache-2.0"),
        ("Affero General Public License version 3", "agpl-3.0,gpl"), ("https://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"), ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"), ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"), ("either version 2 of the License, or (at your option) any later version", "gpl-2.0"), ("mozilla.org/MPL/2.0", "mpl-2.0"),
    ],
)
def test_license_spellings(text, label):
    assert licenses.scan_text(text)[5] == label


def test_suppression_against_brute_force():
    rng, some = random.Random(8), licenses.rules()
    for _ in range(400):
        found = [(s, s + rng.randint(1, 9), rng.choice(some[:12])) for s in (rng.randrange(40) for _ in range(rng.randint(0, 14)))]
        alone = [a for a in found if not any((b[0] <= a[0] and a[1] <= b[1]) and ((b[0], b[1]) != (a[0], a[1]) or b[2].priority < a[2].priority) for b in found)]
        want = []
        for a in sorted(set(alone), key=lambda x: (x[2].priority, x[0])):
            if all(a[1] <= b[0] or b[1] <= a[0] for b in want):
                want.append(a)
        assert licenses.suppressed(found) == sorted(want, key=lambda x: x[0])


def test_many_detections_take_linear_time():
    text = "released under the mit license. gplv3 and apache-2.0 license; "
    times = []
    for n in (1500, 6000):
        began = time.perf_counter()
        assert licenses.scan_text(text * n)[5] == "apache-2.0,gpl-3.0,mit"
        times.append(time.perf_counter() - began)
    assert times[1] < 10 * times[0]


def alternatives(tree):
    """Each text of a license's pattern, with a space for a gap: all branches, with and without optional parts."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "IN":
            some = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])]
        elif name == "BRANCH":
            some = [x for branch in arg[1] for x in alternatives(branch)]
        elif name == "SUBPATTERN":
            some = alternatives(arg[3])
        else:
            some = alternatives(arg[2]) + ([""] if arg[0] == 0 else [])
        out = [a + b for a in out for b in some]
    return out


def test_every_alternative_passes_the_gate():
    seen = 0
    for label, keywords, pattern, _ in licenses.LICENSES:
        for text in alternatives(re._parser.parse(pattern.replace("~", " "))):
            assert any(k in text for k in keywords.split("|")) and licenses.detections(text.encode()), (label, text)
            seen += 1
    assert seen > 150
    for text, label in (("Server Side Public License", "sspl-1.0"), ("Zero-Clause BSD License", "bsd-0-clause"), ("University of Illinois Open Source License", "ncsa"), ("reproduction is strictly prohibited", "no-redistribution")):
        assert label in licenses.scan_text(text)[5].split(","), text


def test_names_over_wide_gaps():
    assert "gpl-3.0" in licenses.scan_text("GNU General\n        *        Public License, version 3")[5].split(",")
    assert licenses.scan_text("gpl" + " " * 300000 + "x")[5] == ""


# ---- 7


def test_media_round_trips():
    rng = np.random.default_rng(1)
    for shape in ((1, 1), (5, 7), (8, 64), (3, 5, 3)):
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (media.decode(media.encode_bmp(image)) == image).all()
        assert (media.read_npy(media.write_npy(image)) == image).all()
        if image.ndim == 2:
            assert (media.decode(media.encode_pgm(image)) == image).all()
    assert media.decode(b"P1\n# c\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P2 2 1 255 7 9").tolist() == [[7, 9]] and media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P4\n9 1\n\x80\x80").tolist() == [[0] + [255] * 7 + [0]]
    assert media.decode(b"P5 2 1 65535\n\x01\x02\x03\x04").tolist() == [[0x102, 0x304]]
    for bad in (b"", b"P5", b"P5 2 2 255\n1", b"BMx", b"P5 0 1 255\n"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize():
    rng = np.random.default_rng(2)
    image = rng.random((6, 9))
    assert np.allclose(media.area_resize(image, 2, 3), image.reshape(2, 3, 3, 3).mean(axis=(1, 3)))
    fine = np.kron(image, np.ones((4, 5)))
    assert np.allclose(media.area_resize(image, 4, 5), fine.reshape(4, 6, 5, 9).mean(axis=(1, 3)))
    assert media.difference_hash(np.tile(np.arange(64), (8, 1))) == "ff" * 8 and media.difference_hash(np.zeros((1, 64))) == "00" * 8


def test_text_media(docs, odd, clashing, make):
    for df in (docs, odd, clashing):
        want = Counter()
        for r in df.collect():
            raw = (r.text or "").encode()
            p = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
            want[r.doc_id, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
        rows = media.text_media(df).collect()
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    same = [r for r in media.text_media(odd).collect() if r.doc_id in (1, 2, 11)]
    assert len({r[1:] for r in same}) == 1 and media.text_media(make([])).count() == 0


def test_decoded_images(spark):
    image = np.arange(64, dtype=np.uint8).reshape(8, 8)
    rows = spark.createDataFrame([(1, bytearray(media.encode_bmp(image))), (2, bytearray(b"junk")), (3, None)], "id int, content binary")
    got = {r.id: r for r in media.decoded_images(rows, "content", 4, 4).collect()}
    assert media.read_npy(bytes(got[1].tile)).shape == (4, 4) and got[2].tile is None and got[2].error and got[3].dhash is None


# ---- 9


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(tiktoken_encoding):
    v = bpe.Vocabulary(tokenizer_path())
    rng = random.Random(3)
    parts = [*"aZé中ß1٣²!'\"-._ \t\n\r\x1c\x85\0", "\u00a0", "\u3000", "'s", "'re", "'ll", " ", "  ", "'", "ve", "d", "\U0001d400", "😀", "ا", "the", " quick"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["", "ab" * 9000, " " * 500, "'" * 77, "a" * 49, "it's we'll 'tis"]
    for part in bpe._batches(texts, 20_000):
        for t, (ids, decimal, offsets) in zip(part, v.encode(part), strict=True):
            assert ids == tiktoken_encoding.encode_ordinary(t) and v.decode(ids) == t.encode() and decimal == ",".join(map(str, ids))
            assert offsets == sorted(set(offsets))


def test_scan_equals_the_loop():
    rng = np.random.default_rng(7)
    nxt = bpe.transitions()[0]
    for n in (0, 1, 63, 64, 65, 5000, 70_000):
        s = rng.integers(0, 10, n).astype(np.uint8)
        state, want = 0, []
        for x in s:
            want.append(state)
            state = nxt[x, state]
        assert bpe.scan(s).tolist() == want


def test_bpe_table(docs, odd, clashing, make, tiktoken_encoding):
    for df in (docs.limit(40), odd, clashing):
        want = Counter()
        for r in df.collect():
            ids = tiktoken_encoding.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert Counter(map(tuple, bpe.token_digests(df, tokenizer_path()).collect())) == want
    e = bpe.encoded(odd, tokenizer_path()).where("doc_id = 7").first()
    assert sum(e.token_bytes) == len(e.text.encode()) and len(e.ids) == len(e.token_bytes)
    assert bpe.token_digests(make([]), tokenizer_path()).count() == 0


# ---- 10


def slow_edits(rows):
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda x: x[:2])
    out = {}
    for k, (some, i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][2]
        m = len(t) // 4
        out[(i if some else None, t)] = (len(t), hashlib.sha256((t[: len(t) - m] + nxt[:m]).encode()).hexdigest())
    return out


def test_merkle(docs, odd, clashing, odd_rows, make):
    for df, rows in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (odd, odd_rows), (clashing, odd_rows)):
        want = slow_edits(rows)
        got = merkle.fingerprints_and_edits(df).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter((i, *want[i, t or ""]) for i, t in rows)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    got = merkle.fingerprints_and_edits(docs).collect()
    assert np.mean([r.near_edited for r in got]) > 0.5 and np.mean([r.near_next for r in got]) < 0.1
    assert merkle.fingerprints_and_edits(make([])).count() == 0
    only = merkle.fingerprints_and_edits(make([(5, "alone. here.")])).first()
    assert only.near_next == 1.0


def slow_tree(text):
    """Sections of paragraphs of sentences."""
    lines, sections = [x for x in re.split("(?<=\n)", text) if x], []
    for i, line in enumerate(lines):
        blank = i > 0 and not lines[i - 1].strip(" \t\r\n") and line.strip(" \t\r\n")
        if not sections or (blank and i > 1) or re.match("#{1,6} ", line):
            sections.append([])
        sections[-1].append([x for x in re.findall(r"[^.!?|]{0,200}[.!?|]*[ \t\n\x0b\f\r]*", line) if x])
    return sections


def slow_likeness(a, b):
    x, y = (Counter(leaf for s in slow_tree(t) for p in s for leaf in p) for t in (a, b))
    if a == b:
        return 1.0, None
    both, most = sum((x & y).values()), max(x.total(), y.total())
    pa, pb = ([tuple(p) for s in slow_tree(t) for p in s] for t in (a, b))
    first = next((i for i, (p, q) in enumerate(zip(pa, pb, strict=False)) if p != q), min(len(pa), len(pb)))
    return both / (most + 1 if both == most else most), first


def test_merkle_against_brute_force(spark):
    rng, pairs = random.Random(7), []
    bits = ["One. ", "Two!", "Three", "\n", "\n\n", " \n", "# Head\n", "x" * 450, "é? ", "a|b|", "Four. Five.\n", "\n\n\n"]
    for _ in range(250):
        a = [rng.choice(bits) for _ in range(rng.randint(0, 14))]
        b = [x for x in a if rng.random() < 0.9] + ([rng.choice(bits)] if rng.random() < 0.5 else [])
        pairs.append(("".join(a), "".join(b if rng.random() < 0.8 else rng.sample(a, len(a)))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for c in "ab":
        df = merkle.with_tree(df, c, f"t{c}")
    for r in merkle.with_likeness(df, "ta", "tb", "x", "at").withColumn("text", merkle.fingerprint_text(F.col("ta"))).collect():
        want, first = slow_likeness(r.a, r.b)
        assert r.x == pytest.approx(want), (r.a, r.b)
        assert [[len(p) for p in s] for s in r.ta.sections] == [[len(p) for p in s] for s in slow_tree(r.a)], r.a
        assert (r.ta.root == r.tb.root) == (r.a == r.b) and (r["at"] is None) == (r.a == r.b)
        shape = [[len(p) // 8 for p in s.split(",")] for s in r.text.split("|")[1].split("/")] if r.a else []
        assert shape == [[len(p) for p in s] for s in r.ta.sections]
        if r["at"] is not None:
            sections = slow_tree(r.a)
            assert r["at"].section <= len(sections) and sum(map(len, sections[: r["at"].section])) <= r["at"].paragraph >= first - 1


def test_merkle_places_and_repeats(spark):
    text = "".join(f"Paragraph number {i}. It goes on.\n" + ("\n" if i % 10 == 9 else "") for i in range(200))
    edited = text.replace("number 124.", "number one hundred twenty-four.")
    df = spark.createDataFrame([(text, edited)], "a string, b string")
    for c in "ab":
        df = merkle.with_tree(df, c, f"t{c}")
    r = merkle.with_likeness(df, "ta", "tb", "x", "at").first()
    assert len(r.ta.sections) == 20 and 0.99 < r.x < 1.0
    assert (r["at"].section, r["at"].paragraph, r["at"].paragraphs) == (12, 124 + 12, 1)
    line, new = "The same line.\n", "".join(f"New sentence {i}.\n" for i in range(100))
    pairs = [(line * 400, line * 300 + new, 0.75), (line * 5, line * 5000, 0.001), ("One.\nTwo.\nThree.\n", "Three.\nOne.\nTwo.\n", 0.75), (line, line, 1.0), ("", "", 1.0), ("", line, 0.0)]
    df = spark.createDataFrame(pairs, "a string, b string, want double")
    for c in "ab":
        df = merkle.with_tree(df, c, f"t{c}")
    for r in merkle.with_likeness(merkle.with_likeness(df, "ta", "tb", "x"), "tb", "ta", "y").collect():
        assert r.x == r.y == pytest.approx(r.want)
