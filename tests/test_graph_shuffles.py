"""Edges are told apart without shuffling their hashes, and counted before they meet nodes."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from caseflow.operators import graph as G
from caseflow.sources.domain import TicketModel, graph_inputs


def test_edge_ids_are_not_shuffled(spark, sf_dir):
    e = G.build_edges(graph_inputs(TicketModel(spark, sf_dir))).select("edge_id", "source_node_id", "target_node_id")
    text = io.StringIO()
    with redirect_stdout(text):
        e.explain()
    wide = [line for line in text.getvalue().splitlines() if "hashpartitioning" in line and "edge_id" in line]
    assert not wide, wide


def test_one_edge_of_each_id(spark):
    rows = [("R", "a|b", "c"), ("R", "a", "b|c"), ("R", "a", "c"), ("R", "a", "c"), ("S", "a", "c"), ("S", "", "x"),
            ("S", "ü|😀", "ß")]
    df = spark.createDataFrame(rows, "relationship_type string, source_node_id string, target_node_id string") \
        .withColumn("edge_id", F.sha2(F.concat_ws("|", "relationship_type", "source_node_id", "target_node_id"), 256)) \
        .withColumn("properties_json", F.lit("{}"))
    have = G._one_of_each(df).select(*G.EDGE_COLUMNS).collect()
    given = {tuple(r) for r in df.select(*G.EDGE_COLUMNS).collect()}
    assert len({r.edge_id for r in have}) == len(have) == df.select("edge_id").distinct().count()
    assert {tuple(r) for r in have} <= given


def test_integrity_counts_each_dangling_end(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("b",)], "node_id string")
    edges = spark.createDataFrame([("R", "a", "b"), ("R", "a", "x"), ("R", "y", "x"), ("S", "z", "a"), ("T", "a", "a")],
                                  "relationship_type string, source_node_id string, target_node_id string")
    have = {tuple(r) for r in G.graph_integrity(nodes, edges).collect()}
    assert have == {("R", 3, 1, 2), ("S", 1, 1, 0), ("T", 1, 0, 0)}
    assert G.graph_integrity(nodes, edges.limit(0)).count() == 0
