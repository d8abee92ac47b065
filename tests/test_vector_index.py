"""The product-quantised index finds what exact search finds, with few full comparisons."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.operators import retrieve as R
from caseflow.operators import vector_index as VI
from caseflow.plans.retrieval_queries import index_report
from caseflow.sources.landing import work_dir

SF = "/root/testdata/sf0.01"


def clustered(spark, n, dim=16, groups=40, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    rows = [(i, (middles[i % groups] + 0.15 * rng.normal(size=dim)).astype(np.float32).tolist(), "ab"[i % 2])
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, dvec array<float>, part string")


def ranked(df):
    return sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_recall_and_comparisons_on_the_test_vectors(spark):
    rows = index_report(spark, SF).collect()
    assert rows and sum(r.found for r in rows) == sum(r.expected for r in rows)
    assert sum(r.compared for r in rows) <= 0.05 * sum(r.documents for r in rows)


@pytest.mark.parametrize("parts,part_dims", [([], 1), (["part"], 1), ([], 4)])
def test_search_equals_exact_search(spark, monkeypatch, parts, part_dims):
    """With many cells: a query scans some first, then those that may hold a better document."""
    monkeypatch.setattr(VI, "FIRST_CELLS", 2)
    d = clustered(spark, 3000)
    q = d.where("doc_id % 97 = 0").select(F.col("doc_id").alias("query_id"), F.col("dvec").alias("qvec"), *parts)
    index = VI.build_vector_index(d, work_dir(spark, "vector-test"), parts, cell_rows=75, part_dims=part_dims)
    assert len(index.codec.centres) == 40
    assert ranked(index.search(q, 7)) == ranked(R.vector_topk(q, d, 7, parts))
    scanned = index.near_cells(F.col("qvec"), F.col("floor"))
    first = VI._kth(index.scan(q.withColumn("floor", F.lit(None).cast("double"))
                               .withColumn("cells", index.near_cells(F.col("qvec"))), 7), 7)
    floors = first.select("query_id", "floor").distinct()
    n = q.join(floors, "query_id").select(F.avg(F.size(scanned))).first()[0]
    assert n < 20  # of 40 cells


def test_written_index_is_searched_later(spark):
    d = clustered(spark, 400)
    q = d.limit(5).select(F.col("doc_id").alias("query_id"), F.col("dvec").alias("qvec"))
    folder = work_dir(spark, "vector-test")
    built = VI.build_vector_index(d, folder)
    assert ranked(VI.open_vector_index(d, folder).search(q, 3)) == ranked(built.search(q, 3))
    code = built.codes.first().code
    assert len(code) == 16  # a byte a dimension


def test_zero_missing_and_equal_vectors(spark):
    rows = [(i, [0.0, 0.0]) for i in range(5)] + [(10 + i, [1.0, 1.0]) for i in range(300)] + [(900, None)]
    d = spark.createDataFrame(rows, "doc_id long, dvec array<float>")
    q = spark.createDataFrame([(1, [2.0, 2.0]), (2, [0.0, 0.0]), (3, None)], "query_id long, qvec array<float>")
    index = VI.build_vector_index(d, work_dir(spark, "vector-test"))
    got = ranked(index.search(q, 2))
    assert got == [(1, 1, 10, 1.0), (1, 2, 11, 1.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0)]
    assert index.candidates(q.where("query_id = 1"), 2).count() == 2  # of 300 equal ones
