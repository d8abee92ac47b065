"""Postings without a shuffle, block scores against brute force, and what a search leaves out before it deals blocks."""

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from caseflow.operators import retrieve as R


def _texts(n: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{min(int(x), 60)}" for x in rng.exponential(9, rng.integers(1, 40))) for _ in range(n)]


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_postings_need_no_shuffle(spark, capsys):
    docs = _docs(spark, ["b a b", "", None, "a"])
    post = R.build_postings(docs, "doc_id", {"content": "text"})
    post.explain()
    assert "Exchange" not in capsys.readouterr().out
    rows = {(r.doc_id, r.field, r.term, r.tf, r.dl) for r in post.collect()}
    assert rows == {(0, "content", "a", 1, 3), (0, "content", "b", 2, 3), (3, "content", "a", 1, 1)}


def test_rows_that_share_an_id_are_summed(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "b b c"), (2, "b")], "doc_id long, text string")
    post = R.build_postings(docs, "doc_id", {"content": "text"})
    assert sorted((r.doc_id, r.term, r.tf, r.dl) for r in post.collect()) == \
        [(1, "a", 1, 2), (1, "b", 3, 3), (1, "c", 1, 3), (2, "b", 1, 1)]


def _brute(texts, queries, k, wanted=lambda q, d: True, pool=None):
    pool = [d for d in range(len(texts)) if texts[d].split()] if pool is None else pool
    tf = {d: Counter(texts[d].split()) for d in pool}
    df = Counter(t for c in tf.values() for t in c)
    mean = sum(len(texts[d].split()) for d in pool) / len(pool)
    out = set()
    for q, text in enumerate(queries):
        scores = []
        for d, c in tf.items():
            s = sum(math.log(1 + (len(pool) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2
                    / (c[t] + 1.2 * (0.25 + 0.75 * len(texts[d].split()) / mean)) for t in set(text.split()) if t in c)
            if s > 0 and wanted(q, d):
                scores.append((-round(s, 6), d))
        out |= {(q, d, i + 1, -s) for i, (s, d) in enumerate(sorted(scores)[:k])}
    return out


def _got(df):
    return {(r.query_id, r.doc_id, r["rank"], r.score) for r in df.collect()}


def test_scores_are_those_of_brute_force(spark, monkeypatch):
    texts, asked = _texts(300, 1), _texts(40, 2)
    post = R.build_postings(_docs(spark, texts), "doc_id", {"content": "text"})
    queries = _docs(spark, asked).withColumnRenamed("doc_id", "query_id")
    want = _brute(texts, asked, 5)
    for cells, terms in ((R.BATCH_CELLS, R.BROADCAST_TERMS), (500, 0)):
        monkeypatch.setattr(R, "BATCH_CELLS", cells)
        monkeypatch.setattr(R, "BROADCAST_TERMS", terms)
        assert _got(R.bm25_topk(post, queries, 5)) == want
    pool = [d for d in range(300) if d % 3 and texts[d].split()]
    cand = spark.createDataFrame([(d,) for d in pool], "doc_id long")
    assert _got(R.keyword_topk(post, queries, 5, candidates=cand)) == _brute(texts, asked, 5, pool=pool)


def test_owners_kinds_and_large_hashes(spark):
    texts, asked = _texts(120, 3), _texts(30, 4)
    post = R.build_postings(_docs(spark, texts), "doc_id", {"content": "text"})
    queries = _docs(spark, asked).select(F.col("doc_id").alias("query_id"), "text",
                                         F.expr("if(doc_id % 4 = 0, null, cast(doc_id as string))").alias("ticket"),
                                         (F.col("doc_id") % 2 + 1).alias("kinds"))
    profile = _docs(spark, texts).select("doc_id", F.expr("if(doc_id % 5 = 0, null, cast(doc_id % 30 as string))").alias("owner"),
                                         (F.col("doc_id") % 4).alias("kind"))

    def wanted(q, d):
        own = d % 5 and q % 4 and d % 30 == q
        return not own and (q % 2 + 1) & (d % 4)
    assert _got(R.bm25_topk(post, queries, 4, profile=profile)) == _brute(texts, asked, 4, wanted)


def test_documents_that_no_query_may_have_are_not_dealt(spark, monkeypatch):
    texts = _texts(200, 5)
    post = R.build_postings(_docs(spark, texts), "doc_id", {"content": "text"})
    seen = spark.sparkContext.accumulator(0)
    plain = R._score_block

    def counting(*args):
        fn = plain(*args)

        def counted(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            seen.add(len(rows))
            return fn(queries, rows)
        return counted
    monkeypatch.setattr(R, "_score_block", counting)
    profile = _docs(spark, texts).select("doc_id", (F.col("doc_id") % 10 == 0).cast("long").alias("kind"))
    queries = _docs(spark, texts[:20]).withColumnRenamed("doc_id", "query_id")
    R.bm25_topk(post, queries, 3, profile=profile).collect()
    assert 0 < seen.value < post.count() / 5


def test_few_hits_shuffle_no_documents(spark, sf_dir, capsys):
    from caseflow.plans.retrieval_queries import format_hits
    from caseflow.plans.search_store import SearchIndex
    ids = [r.doc_id for r in SearchIndex(spark, sf_dir, "kb").docs.select("doc_id").limit(2).collect()] + ["none"]
    hits = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "query_id long, doc_id string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")  # hits fit, documents don't
    try:
        out = format_hits(spark, sf_dir, hits)
        rows = {(r.doc_id, r.source_type, r.title == r.doc_id) for r in out.collect()}
        out.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert rows == {(ids[0], "kb_article", False), (ids[1], "kb_article", False), ("none", "unknown", True)}
    assert "BroadcastHashJoin [doc_id" in capsys.readouterr().out
