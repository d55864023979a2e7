"""Vector codes against plain rounds in Python's integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tracewright.llm import codes
from tracewright.llm import queries as Q

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=6):
    """Contract's rows, worked out with loops."""
    kept = [(i, [math.floor(float(np.float32(c)) * 4096) for c in v], y) for i, v, y in rows if v and all(c is not None and math.isfinite(c) for c in v) and len(v) % 8 == 0]
    if not [r for r in kept if r[0] is not None]:
        return []
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1]))
    size = len(order[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    d = size // 8
    starts = [r for r in order if len(r[1]) == size][:16]
    book = [[r[1][p * d : (p + 1) * d] for r in starts] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((far(v[p * d : (p + 1) * d], e), k) for k, e in enumerate(book[p]))
    for _ in range(rounds):
        new = [list(b) for b in book]
        for p in range(8):
            mine = defaultdict(list)
            for _, v, _ in kept:
                mine[near(v, p)[1]].append(v[p * d : (p + 1) * d])
            for k, vs in mine.items():
                new[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
        book = new
    sha = hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for i, v, y in kept:
        found = [near(v, p) for p in range(8)]
        e = min(sum(f[0] for f in found), codes.MOST)
        out.append([i, "".join(f"{f[1]:02x}" for f in found), e, y])
        sums[y] += e
    return sorted(((i, c, e, min(sums[y], codes.MOST), sha) for i, c, e, y in out), key=str)


def coded(spark, rows):
    df = codes.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, size, seed, spread=0.1):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    return [(i, [m + r.gauss(0, spread) for m in r.choice(middles)], r.choice([None, 1, 2])) for i in range(n)]


def test_codes_equal_plain_rounds(spark):
    rows = vectors(400, 16, 1)
    same = [(1000 + i, rows[3][1], 2) for i in range(150)]  # a third of all are one vector
    ties = [(2000 + i, [((i >> b) & 1) / 4096 for b in range(16)], None) for i in range(200)]  # whole-number ties
    for case in (rows, rows + same, ties, rows[:5], [(-i, v, y) for i, v, y in rows]):
        assert coded(spark, case) == plain(case)


def test_codes_of_odd_rows(spark):
    rows = vectors(40, 8, 2)
    odd = [(None, [0.5] * 8, 1), (3, None, 1), (4, [], 1), (5, [1.0] * 7 + [None], 1), (6, [float("nan")] * 8, 1), (7, [float("inf")] + [0.0] * 7, 1), (8, [0.0] * 12, 2), (9, [0.25] * 16, 2), (10, [0.1] * 8, None), (10, [0.1] * 8, None), (10, [0.2] * 8, 1)]
    assert coded(spark, rows + odd) == plain(rows + odd)
    assert coded(spark, odd) == plain(odd)
    assert coded(spark, [(1, None, 1), (None, [1.0] * 8, 1)]) == []
    assert coded(spark, []) == []


def test_codes_of_huge_components(spark):
    rows = [(i, [c * 1e5 for c in v], y) for i, v, y in vectors(60, 8, 3)]
    assert coded(spark, rows) == plain(rows)
    far = [(i, [c * 1e12 for c in v], y) for i, v, y in vectors(60, 8, 4, 0.3)]
    assert [r[1:4] for r in coded(spark, far)] == [r[1:4] for r in plain(far)]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(vectors(50, 8, 5), SCHEMA)
    more = df.withColumns({c: F.lit("x") for c in ("id", "v", "near", "upper", "lower", "sums", "code", "error", "n")})
    assert sorted(map(tuple, codes.vector_codes(more).collect())) == sorted(map(tuple, codes.vector_codes(df).collect()))


def test_bounds_pass_over_most_distances():
    r = np.random.default_rng(0)
    x = (r.normal(size=(2000, 8)) * 200 + r.integers(0, 16, 2000)[:, None] * 4000).astype(np.int64)
    book = x[:16].copy()
    near, upper, lower = np.zeros(2000, np.int64), np.full(2000, codes.FAR), np.zeros((2000, 16), np.int64)
    codes.settle(x, book, near, upper, lower)
    again = book + 1
    upper += 3
    lower = np.maximum(lower - 3, 0)
    done = codes.settle(x, again, near, upper, lower)
    assert (near == ((x[:, None] - again) ** 2).sum(-1).argmin(1)).all()
    assert done < 2000 * 16 / 4
    assert (upper**2 >= ((x - again[near]) ** 2).sum(-1)).all() and (lower**2 <= ((x[:, None] - again) ** 2).sum(-1)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_roots(kind):
    x = np.array([0, 1, 2, 3, 4, 8, 9, 10, (1 << 29) ** 2 - 1, (1 << 29) ** 2, (1 << 29) ** 2 + 1], dtype=kind)
    assert list(codes.root_floor(x)) == [math.isqrt(int(v)) for v in x]
    assert list(codes.root_ceil(x)) == [math.isqrt(int(v) - 1) + 1 if v else 0 for v in x]


def test_query_on_the_table(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in Q.op13_vector_codes(spark, small).collect()), key=str)
    assert got == plain(rows)
