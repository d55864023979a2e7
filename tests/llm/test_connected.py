"""Components by contraction of edges, and what they read."""

import random

from tracewright.llm import simhash


def made(spark, since):
    """Rows that the joins of executions from ``since`` on returned."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    runs = store.executionsList()
    for run in (runs.apply(i) for i in range(runs.size())):
        if run.executionId() < since:
            continue
        values, nodes = store.executionMetrics(run.executionId()), store.planGraph(run.executionId()).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if "Join" in node.name():
                for m in (node.metrics().apply(i) for i in range(node.metrics().size())):
                    if m.name() == "number of output rows" and (v := values.get(m.accumulatorId())).isDefined():
                        total += int(v.get().replace(",", ""))
    return total


def executions(spark):
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max([0, *(runs.apply(i).executionId() for i in range(runs.size()))]) + 1


def expected(pairs):
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        group[high] = low
    return {x: root(x) for x in group}


def test_edges_of_a_family_are_not_read_in_every_round(spark):
    pick = random.Random(3)
    hubs = [pick.getrandbits(60) for _ in range(20)]
    members = [pick.getrandbits(60) for _ in range(400)]
    pairs = [(h, m) for m in members for h in pick.sample(hubs, 12)]  # each text is near a dozen centres
    chain = [pick.getrandbits(60) for _ in range(40)]
    pairs += list(zip(chain, chain[1:], strict=False)) + [(hubs[0], chain[0])]
    edges = spark.createDataFrame(pairs, "u long, v long")
    since = executions(spark)
    got = {r.id: r.label for r in simhash.connected(edges).collect()}
    rows = made(spark, since)
    assert got == expected(pairs)
    assert len(pairs) < rows < 3.5 * len(pairs)


def test_chains_loops_and_repeats(spark, monkeypatch):
    pairs = [(i, i + 1) for i in range(300)] + [(1001, 1000), (1000, 1001), (1001, 1000), (2000, 2000), (-5, 3000), (3001, 3000)]
    want = expected(pairs)
    edges = spark.createDataFrame(pairs, "u long, v long")
    assert {r.id: r.label for r in simhash.connected(edges).collect()} == want
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", 0)  # as for tables too large to broadcast
    assert {r.id: r.label for r in simhash.connected(edges).collect()} == want
    assert simhash.connected(edges.limit(0)).collect() == []
