"""Repeated edges go before the join, so no sum above it tells incidents apart."""

import pytest

from caseflow.operators import graph as G

ROWS = [("i1", "a1", "A"), ("i1", "a1", "A"), ("i2", "a1", "A"), ("i3", "a1", "A"), ("i3", "a2", "A"), ("i4", None, "A"),
        ("i1", "b1", "B"), ("i1", "b2", "B"), ("i2", "b1", "B"), ("i2", "b1", "B"), ("i3", "b2", "B"), ("i4", "b1", "B")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(ROWS, "source_node_id string, target_node_id string, relationship_type string")


def _above_join(df, capsys) -> list[str]:
    df.explain()
    plan = capsys.readouterr().out.splitlines()
    return plan[:next(i for i, x in enumerate(plan) if "Join" in x)]


def test_links_are_counted_once_and_without_incidents(edges, capsys):
    out = G.co_link_counts(edges, None, "A", "B")
    assert not [x for x in _above_join(out, capsys) if "Aggregate(keys" in x and "incident_node_id" in x]
    assert {tuple(r) for r in out.collect()} == {("a1", "b1", 2), ("a1", "b2", 2), ("a2", "b2", 1), (None, "b1", 1)}
    only = edges.where("source_node_id <> 'i1'").selectExpr("source_node_id AS node_id").distinct()
    assert {tuple(r) for r in G.co_link_counts(edges, only, "A", "B").collect()} == \
        {("a1", "b1", 1), ("a1", "b2", 1), ("a2", "b2", 1), (None, "b1", 1)}


def test_groups_are_counted_once_and_without_incidents(edges, capsys):
    out = G.shared_neighbour_groups(edges, "A", "B")
    above = [x.split("functions=")[0] for x in _above_join(out, capsys) if "Aggregate(key" in x]
    assert above and not [x for x in above if "incident_node_id" in x]
    assert {tuple(r) for r in out.collect()} == {("a1", "b1", 2, "i1"), ("a1", "b2", 2, "i1")}
