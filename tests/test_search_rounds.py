"""Many queries are asked in rounds: same hits, nothing dealt twice, and similar tickets are searched once a session."""

import pytest
from pyspark.sql import functions as F

from caseflow.operators import retrieve as R
from caseflow.operators import vector_index as VI
from caseflow.plans import question_queries as QQ
from caseflow.plans import retrieval_queries as RQ
from caseflow.plans import search_store as SS
from caseflow.sources.domain import TicketModel, narrowed
from caseflow.sources.landing import work_dir
from tests.test_disk_freed import _shuffled
from tests.test_keyword_scale import _brute, _docs, _got, _texts
from tests.test_vector_index import clustered, ranked


@pytest.mark.parametrize("block,profiled,named", [(2_000_000, False, False), (300, False, True), (300, True, False)])
def test_rounds_give_the_hits_of_brute_force(spark, monkeypatch, block, profiled, named):
    texts, asked = _texts(300, 11), _texts(60, 12) + ["nothing alike", ""]
    docs = _docs(spark, texts)
    if named:  # ids are texts
        docs = docs.withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    post = R.build_postings(docs, "doc_id", {"content": "text"})
    queries, profile, wanted = _docs(spark, asked).withColumnRenamed("doc_id", "query_id"), None, lambda q, d: True
    if profiled:
        queries = queries.select("query_id", "text", F.expr("if(query_id % 4 = 0, null, cast(query_id as string))").alias("ticket"),
                                 (F.col("query_id") % 2 + 1).alias("kinds"))
        profile = _docs(spark, texts).select(
            "doc_id", F.expr("if(doc_id % 5 = 0, null, cast(doc_id % 30 as string))").alias("owner"), (F.col("doc_id") % 4).alias("kind"))

        def wanted(q, d):
            return not (d % 5 and q % 4 and d % 30 == q) and (q % 2 + 1) & (d % 4)
    monkeypatch.setattr(R, "BLOCK_TERMS", 100)
    monkeypatch.setattr(R, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(R, "ROUND_BATCH", 16)
    dealt = []
    monkeypatch.setattr(R, "in_rounds", lambda q, n, f, plain=R.in_rounds: dealt.append(n) or plain(q, n, f))
    before = _shuffled(spark)
    got = R.bm25_topk(post, queries, 5, profile=profile)
    assert dealt and dealt[0] > 3
    number = F.substring("doc_id", 2, 9).cast("long") if named else F.col("doc_id")
    assert _got(got.withColumn("doc_id", number)) == _brute(texts, asked, 5, wanted)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert len(_shuffled(spark) - before) < 100


def test_vector_rounds_give_the_hits_of_one_search(spark, monkeypatch):
    d = clustered(spark, 1500)
    named = d.withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    q = d.where("doc_id % 7 = 0").select(F.col("doc_id").alias("query_id"), F.col("dvec").alias("qvec"),
                                         F.explode(F.array(F.lit("a"), F.lit("b"))).alias("part"))
    index = VI.build_vector_index(named, work_dir(spark, "vector-test"), ["part"], cell_rows=75)
    once = ranked(index.search(q, 6))
    monkeypatch.setattr(VI, "ROUND_QUERIES", 60)
    calls = []
    monkeypatch.setattr(VI, "in_rounds", lambda q, n, f, plain=VI.in_rounds: calls.append(n) or plain(q, n, f))
    assert ranked(index.search(q, 6)) == once and calls and calls[0] > 5


def test_an_empty_block_of_queries_gives_no_hits(spark, monkeypatch):
    """Blocks by hash may be empty on either side; ids are texts."""
    monkeypatch.setattr(VI, "QUERY_BLOCK", 1)
    monkeypatch.setattr(VI, "DOC_BLOCK", 2)
    d = clustered(spark, 40).withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    q = d.limit(9).select(F.monotonically_increasing_id().alias("query_id"), F.col("dvec").alias("qvec"))
    got = VI.build_vector_index(d, work_dir(spark, "vector-test")).search(q, 1).select("query_id", "score").collect()
    assert len(got) == 9 and {r.score for r in got} == {1.0}


def test_similar_tickets_are_searched_once_a_session(spark, sf_dir, monkeypatch):
    hits = RQ.similar_incidents(spark, sf_dir)
    searched = []
    monkeypatch.setattr(RQ, "hybrid_search", lambda *a, **k: searched.append(a))
    again = RQ.similar_incidents(spark, sf_dir)
    assert not searched and again.columns == hits.columns and again.count() == hits.count()
    assert QQ.m18(spark, sf_dir).count() >= 0 and not searched


def test_search_documents_read_only_tickets_with_texts(spark, sf_dir, monkeypatch):
    tm = TicketModel(spark, sf_dir)
    ids = {r[0] for t, c in (("documents", "doc_id"), ("conversations", "conv_id")) for r in tm.raw(t).select(c).collect()}
    few = narrowed(tm, "documents", "conversations")
    kept = {r[0] for r in few.raw("orders").select("o_orderkey").collect()}
    assert kept == ids & {r[0] for r in tm.raw("orders").select("o_orderkey").collect()}
    narrow = SS.incident_docs(tm)
    monkeypatch.setattr(SS, "narrowed", lambda tm, *_: tm)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, SS.incident_docs(tm).collect()))
