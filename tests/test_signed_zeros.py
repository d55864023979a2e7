"""Vector queries whose values round to zero, against their SQL with the signs of zeros."""

import random

import duckdb
import pytest

from tracewright.plans.queries import ORACLES, QUERIES

VALUES = [-3e-7, 3e-7, -0.0, 0.0, 0.25, 0.2499998, -0.5]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """60 vectors of VALUES with null labels among them; each quaternion has a length."""
    pick, out = random.Random(5), tmp_path_factory.mktemp("zeros")
    rows = []
    for i in range(60):
        v = [pick.choice(VALUES) for _ in range(64)]
        v[6], v[14] = pick.choice((0.25, -0.5)), pick.choice((0.25, -0.5))
        rows.append((i, v, i % 4 or None))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{out}/embeddings.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["episode_rows", "flat_vectors", "hybrid_relative_action", "quat_multiply", "quat_normalize", "state_slices"])
def test_signs_of_zeros(spark, folder, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    with duckdb.connect() as c:
        c.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
        rel = c.execute(ORACLES[name])
        names = [d[0] for d in rel.description]
        want = sorted(repr([r[names.index(k)] for k in columns]) for r in rel.fetchall())
    assert any("-0.0" in r for r in want)
    assert sorted(repr([r[k] for k in columns]) for r in df.collect()) == want
