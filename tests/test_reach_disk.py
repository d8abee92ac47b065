"""A walk writes an edge once and doesn't shuffle the edges for a small frontier."""

from pyspark.sql import functions as F

from caseflow.operators import graph as G
from caseflow.sources.landing import work_dir


def test_an_edge_is_written_once(spark):
    edges = spark.range(1000).select(F.concat(F.lit("a"), "id").alias("source_node_id"), F.concat(F.lit("b"), "id").alias("target_node_id"))
    folder = work_dir(spark, "reach-test")
    both = G.write_adjacency(edges, folder)
    assert both.count() == 2000 and spark.read.parquet(f"{folder}/ends").count() == 1000
    assert {tuple(r) for r in both.select("node_id", "next_id").collect()} == \
        {p for i in range(1000) for p in ((f"a{i}", f"b{i}"), (f"b{i}", f"a{i}"))}


def test_a_small_frontier_is_written_before_it_meets_the_edges(spark, monkeypatch, tmp_path):
    folder = str(tmp_path / "walk")
    monkeypatch.setattr(G, "work_dir", lambda *_: folder)
    edges = spark.createDataFrame([("s", "h"), *[("h", f"x{i}") for i in range(50)], ("x1", "y")],
                                  "source_node_id string, target_node_id string")
    out = G.reach(spark, spark.createDataFrame([("s",)], "node_id string"), edges, 2, hub_degree=10)
    assert sorted(map(tuple, out.collect())) == sorted([("s", 0), ("h", 1), *[(f"x{i}", 2) for i in range(50)]])
    assert spark.read.parquet(f"{folder}/frontier=2").count() == G.HUB_SALTS  # the hub, under each salt
    adj = spark.read.parquet(f"{folder}/ends").withColumn("salt", F.lit(0))
    plan = spark.read.parquet(f"{folder}/frontier=2").join(adj, ["node_id", "salt"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
