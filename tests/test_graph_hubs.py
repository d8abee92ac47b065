"""A hub's edges are split over many keys, and hops are those of a plain search."""

from collections import Counter, defaultdict

from caseflow.operators import graph as G
from caseflow.sources.landing import work_dir


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "source_node_id string, target_node_id string")


def brute(seeds, pairs, hops, directed):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        if not directed:
            near[b].add(a)
    seen, here = dict.fromkeys(seeds, 0), set(seeds)
    for h in range(1, hops + 1):
        here = {y for x in here for y in near[x]} - set(seen)
        seen |= dict.fromkeys(here, h)
    return seen


def test_reach_through_a_hub(spark):
    pairs = [("hub", f"n{i}") for i in range(400)] + [(f"n{i}", f"m{i % 7}") for i in range(0, 400, 50)] + [("z", "hub")]
    seeds = spark.createDataFrame([("n3",), ("n3",), ("lost",)], "node_id string")
    for directed in (False, True):
        got = G.reach(spark, seeds, edges_of(spark, pairs), 3, directed, hub_degree=50)
        rows = [(r.node_id, r.hops) for r in got.collect()]
        assert dict(rows) == brute({"n3", "lost"}, pairs, 3, directed) and len(rows) == len(dict(rows))


def test_hub_edges_lie_under_many_keys(spark):
    """A hub with half of all edges: no key has more than three times the mean of its salts."""
    pairs = [("hub", f"n{i}") for i in range(4000)] + [(f"a{i}", f"b{i}") for i in range(2000)]
    adj = G.write_adjacency(edges_of(spark, pairs), work_dir(spark, "hub-test"), hub_degree=500)
    keys = Counter((r.node_id, r.salt) for r in adj.collect())
    assert sum(keys.values()) == 2 * len(pairs)
    hub = [n for (node, _), n in keys.items() if node == "hub"]
    assert len(hub) == G.HUB_SALTS and max(hub) <= 3 * 4000 / G.HUB_SALTS
    assert {salt for (node, salt) in keys if node != "hub"} == {0}
