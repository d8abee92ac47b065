"""Registered retrieval queries.

Search queries are the benchmark texts (whole texts).  Query vectors stand in
for a hosted embedder: the embedding whose id equals the benchmark item id;
document vectors are the embeddings whose id equals the document id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import retrieve as R
from caseflow.operators import searchdocs as SD
from caseflow.operators import vector_index as VI
from caseflow.plans.oracles import ASSET_TYPE_SQL, initcap_sql, sql
from caseflow.plans.registry import register
from caseflow.plans.retrieval_sql import bm25_ctes, embed_ctes, fuse_ctes, hybrid_ctes, vector_ctes
from caseflow.plans.search_store import FIELDS, KINDS, SearchIndex, asset_docs, hybrid_search, incident_docs
from caseflow.sources.domain import TicketModel, is_open, is_resolved
from caseflow.sources.landing import work_dir

K = 10
K_FUSED = 5


# ---- shared inputs ---------------------------------------------------------------------------------

def bench_queries(tm: TicketModel) -> DataFrame:
    return tm.raw("benchmark").select(F.col("item_id").alias("query_id"), "text")


def doc_texts(tm: TicketModel) -> DataFrame:
    return tm.raw("documents").select("doc_id", "text")


def query_vectors(tm: TicketModel) -> DataFrame:
    e = tm.raw("embeddings")
    return bench_queries(tm).join(e, F.col("query_id") == e.vec_id).select("query_id", F.col("embedding").alias("qvec"))


def doc_vectors(tm: TicketModel) -> DataFrame:
    e = tm.raw("embeddings")
    return doc_texts(tm).join(e, F.col("doc_id") == e.vec_id).select("doc_id", F.col("embedding").alias("dvec"))


def doc_postings(tm: TicketModel) -> R.TermIndex:
    """The document index, written once for the session."""
    return SearchIndex(tm.spark, tm.sf_dir, "documents").terms()


Q_SQL = "SELECT item_id AS query_id, text FROM benchmark"
D_SQL = "SELECT doc_id, text FROM documents"
QV_SQL = "SELECT b.item_id AS query_id, e.embedding AS qvec FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id"
DV_SQL = "SELECT d.doc_id, e.embedding AS dvec FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id"

BM25_DOCS = bm25_ctes("b", D_SQL, {"content": "text"}, Q_SQL, K)
VEC_DOCS = vector_ctes("v", QV_SQL, DV_SQL, K)


# ---- J6 / J7 / J8 ------------------------------------------------------------------------------------

@register("j06_bm25_documents", sql(f"WITH {BM25_DOCS}\nSELECT query_id, doc_id, score, rank FROM b_top"))
def bm25_documents(spark, sf_dir):
    """BM25 top 10 documents per benchmark query (whole query and document texts)."""
    tm = TicketModel(spark, sf_dir)
    return R.keyword_topk(doc_postings(tm), bench_queries(tm), K).select("query_id", "doc_id", "score", "rank")


KB_DOCS_SQL = "SELECT kb_article_id AS doc_id, title_raw AS title, content_text AS content FROM kb"


@register("j07_bm25_kb_field_weights", sql(
    f"WITH {bm25_ctes('b', KB_DOCS_SQL, {'title': 'title', 'content': 'content'}, Q_SQL, K, R.KB_FIELD_WEIGHTS)}\n"
    "SELECT query_id, doc_id, score, rank FROM b_top", "kb"))
def bm25_kb_fields(spark, sf_dir):
    """Field-weighted BM25 over KB documents (title x2, content x1)."""
    tm = TicketModel(spark, sf_dir)
    kb = tm.kb_articles().select(F.col("kb_article_id").alias("doc_id"), "title",
                                 F.col("content_text").alias("content"))
    post = R.build_index(kb, "doc_id", {"title": "title", "content": "content"})
    return R.keyword_topk(post, bench_queries(tm), K, R.KB_FIELD_WEIGHTS).select("query_id", "doc_id", "score",
                                                                                  "rank")


@register("j08_vector_documents", sql(f"WITH {VEC_DOCS}\nSELECT query_id, doc_id, score, rank FROM v_top"))
def vector_documents(spark, sf_dir):
    """Exact cosine top 10 documents per query vector (blocked matrix products)."""
    tm = TicketModel(spark, sf_dir)
    return R.vector_topk(query_vectors(tm), doc_vectors(tm), K).select("query_id", "doc_id", "score", "rank")


@register("j09_vector_lsh_approx", sql(f"WITH {VEC_DOCS}\nSELECT query_id, doc_id, score, rank FROM v_top"))
def vector_approx(spark, sf_dir):
    """Cosine top 10 by the product-quantised index; its bounds make the result that of exact search."""
    tm = TicketModel(spark, sf_dir)
    return VI.vector_topk_approx(query_vectors(tm), doc_vectors(tm), K).select("query_id", "doc_id", "score", "rank")


@register("j09_index_recall", sql(f"""WITH {VEC_DOCS},
n AS (SELECT (SELECT count(*) FROM v_vq) AS queries, (SELECT count(*) FROM v_vd) AS documents)
SELECT query_id, CAST(least(10, documents) AS BIGINT) AS expected, CAST(count(*) AS BIGINT) AS found
FROM v_top, n GROUP BY 1, 2"""))
def index_recall(spark, sf_dir):
    """J9 report: of each query's exact top 10, how many the index finds."""
    return index_report(spark, sf_dir).select("query_id", "expected", "found")


def index_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, expected, found, compared, documents): the index against exact search, query by query.

    ``compared`` counts the documents that the index compares in full.
    """
    tm = TicketModel(spark, sf_dir)
    q, d = query_vectors(tm), doc_vectors(tm)
    index = VI.build_vector_index(d, work_dir(spark, "vector-index"))
    exact, found = (x.select("query_id", "doc_id") for x in (R.vector_topk(q, d, K), index.search(q, K)))
    n = index.codes.agg(F.count(F.lit(1)).alias("documents"))
    return exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("expected")) \
        .join(exact.join(found, ["query_id", "doc_id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("found")),
              "query_id", "left") \
        .join(index.candidates(q, K).groupBy("query_id").agg(F.count(F.lit(1)).alias("compared")), "query_id", "left") \
        .withColumn("documents", F.lit(n.first().documents)).fillna(0, ["found", "compared"])


@register("j15_b10_filter_then_search", sql(
    f"WITH {bm25_ctes('b', "SELECT doc_id, text FROM documents WHERE lang = 'en'", {'content': 'text'}, Q_SQL, K)}\n"
    "SELECT query_id, doc_id, score, rank FROM b_top"))
def filter_then_search(spark, sf_dir):
    """J15 + B10: filters limit the candidates before ranking, so k results remain (English only)."""
    from caseflow.operators.listing import filter_from_dict
    tm = TicketModel(spark, sf_dir)
    cand = tm.raw("documents").where(filter_from_dict({"lang": "en"})).select("doc_id")
    return R.keyword_topk(doc_postings(tm), bench_queries(tm), K, candidates=cand).select(
        "query_id", "doc_id", "score", "rank")


# ---- J10-J14 -------------------------------------------------------------------------------------------

def _hybrid(spark: SparkSession, sf_dir: str, k: int = K_FUSED, index: R.TermIndex | None = None) -> DataFrame:
    tm = TicketModel(spark, sf_dir)
    kw = R.keyword_topk(index or doc_postings(tm), bench_queries(tm), 2 * k)
    vec = R.vector_topk(query_vectors(tm), doc_vectors(tm), 2 * k)
    return R.fuse_linear(kw, vec, k)


@register("j10_j11_hybrid_documents", sql(
    f"WITH {bm25_ctes('b', D_SQL, {'content': 'text'}, Q_SQL, 2 * K_FUSED)},"
    f"{vector_ctes('v', QV_SQL, DV_SQL, 2 * K_FUSED)},{fuse_ctes('h', 'b_top', 'v_top', K_FUSED)}\n"
    "SELECT query_id, doc_id, bm25_norm, cosine, score, rank FROM h_top"))
def hybrid_documents(spark, sf_dir):
    """J10 + J11: keyword and vector candidates (2k each), 0.6 / 0.4 fusion, top 5."""
    return _hybrid(spark, sf_dir).select("query_id", "doc_id", "bm25_norm", "cosine", "score", "rank")


@register("j12_rrf_documents", sql(
    f"WITH {bm25_ctes('b', D_SQL, {'content': 'text'}, Q_SQL, K)},{vector_ctes('v', QV_SQL, DV_SQL, K)}\n"
    """SELECT query_id, doc_id, score, rank FROM (
  SELECT query_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS INTEGER) AS rank
  FROM (SELECT query_id, doc_id, round(sum(1.0e0 / (60 + rank)), 6) AS score
        FROM (SELECT query_id, doc_id, rank FROM b_top UNION ALL SELECT query_id, doc_id, rank FROM v_top)
        GROUP BY query_id, doc_id)) WHERE rank <= 5"""))
def rrf_documents(spark, sf_dir):
    """Reciprocal rank fusion of keyword and vector top 10, top 5."""
    tm = TicketModel(spark, sf_dir)
    kw = R.keyword_topk(doc_postings(tm), bench_queries(tm), K)
    vec = R.vector_topk(query_vectors(tm), doc_vectors(tm), K)
    return R.fuse_rrf([kw, vec], K_FUSED).select("query_id", "doc_id", "score", "rank")


@register("j13_j14_kb_boosted", sql(
    f"WITH {bm25_ctes('b', KB_DOCS_SQL, {'title': 'title', 'content': 'content'}, Q_SQL, K, R.KB_FIELD_WEIGHTS)}\n"
    """SELECT query_id, doc_id, score, rank FROM (
  SELECT query_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS INTEGER) AS rank
  FROM (SELECT t.query_id, t.doc_id,
          round((0.6e0 * t.bm25 / m.best
                 + CASE WHEN kb.useful_count > 50 THEN 0.2e0 ELSE 0.0e0 END
                 + CASE WHEN kb.view_count > 100 THEN 0.15e0 ELSE 0.0e0 END)
                * (1.0e0 + 1.0e0 * least(1.0e0, greatest(0.0e0, (kb.useful_count - 50.0e0) / 450.0e0))
                         + 0.5e0 * least(1.0e0, greatest(0.0e0, (kb.view_count - 100.0e0) / 900.0e0))), 6) AS score
        FROM b_sc t JOIN (SELECT query_id, max(bm25) AS best FROM b_sc GROUP BY query_id) m USING (query_id)
        JOIN kb ON kb.kb_article_id = t.doc_id)) WHERE rank <= 5""", "kb"))
def kb_boosted(spark, sf_dir):
    """J13 + J14: signal boosts and the magnitude profile belong to the score of every matching article."""
    tm = TicketModel(spark, sf_dir)
    kb = tm.kb_articles()
    docs = kb.select(F.col("kb_article_id").alias("doc_id"), "title", F.col("content_text").alias("content"))
    post = R.build_index(docs, "doc_id", {"title": "title", "content": "content"})
    best = R.bm25_topk(post, bench_queries(tm), 1, R.KB_FIELD_WEIGHTS) \
        .select("query_id", (F.lit(R.FUSION_KEYWORD_WEIGHT) / F.col("bm25")).alias("scale"))
    mul = R.scoring_profile(F.lit(1.0), F.col("useful_count"), F.col("view_count"))
    add = mul * R.signal_boosts(useful_count=F.col("useful_count"), view_count=F.col("view_count"))
    profile = kb.select(F.col("kb_article_id").alias("doc_id"), mul.alias("mul"), add.alias("add"))
    return R.bm25_topk(post, bench_queries(tm).join(best, "query_id"), K_FUSED, R.KB_FIELD_WEIGHTS, profile).select(
        "query_id", "doc_id", "score", "rank")


# ---- J23 / J24 / J25 ----------------------------------------------------------------------------------

J23_Q = """
  SELECT e.vec_id AS query_id, e.embedding AS qvec, e.label FROM embeddings e JOIN inc ON inc.incident_id = e.vec_id
  WHERE lower(inc.state) IN ('new', 'in progress', 'on hold')"""
J23_D = """
  SELECT e.vec_id AS doc_id, e.embedding AS dvec, e.label FROM embeddings e JOIN inc ON inc.incident_id = e.vec_id
  WHERE lower(inc.state) IN ('resolved', 'closed')"""


@register("j23_similar_resolved_by_label", sql(
    f"WITH {vector_ctes('v', J23_Q, J23_D, 5, partition='label')}\nSELECT query_id, doc_id, score, rank FROM v_top",
    "inc"))
def similar_resolved_by_label(spark, sf_dir):
    """J23 on J9: for every open ticket with a vector, its 5 nearest resolved tickets of the same label."""
    tm = TicketModel(spark, sf_dir)
    e = tm.raw("embeddings")
    inc = tm.incidents_base().select("incident_id", "state")
    tv = e.join(inc, e.vec_id == inc.incident_id)
    q = tv.where(is_open(F.col("state"))).select(F.col("vec_id").alias("query_id"),
                                                  F.col("embedding").alias("qvec"), "label")
    d = tv.where(is_resolved(F.col("state"))).select(F.col("vec_id").alias("doc_id"),
                                                      F.col("embedding").alias("dvec"), "label")
    return VI.vector_topk_approx(q, d, 5, ["label"]).select("query_id", "doc_id", "score", "rank")


@register("j24_relevance_judgments", sql("""
SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"""))
def relevance_judgments(spark, sf_dir):
    """J24 input: documents containing a benchmark passage (rarest-token candidates, exact check)."""
    tm = TicketModel(spark, sf_dir)
    return R.contains_judgments(bench_queries(tm), doc_texts(tm), doc_postings(tm))


def _quality_sql(label: str, ranked: str) -> str:
    return f"""{label}_m AS (SELECT j.query_id, count(*) AS n_relevant,
    round(count(r.doc_id) / count(*), 6) AS {label}_recall,
    round(COALESCE(1.0e0 / min(r.rank), 0.0e0), 6) AS {label}_mrr
  FROM judged j LEFT JOIN (SELECT * FROM {ranked} WHERE rank <= {K_FUSED}) r USING (query_id, doc_id)
  GROUP BY j.query_id)"""


@register("j24_search_quality", sql(
    f"WITH {bm25_ctes('b', D_SQL, {'content': 'text'}, Q_SQL, 2 * K_FUSED)},"
    f"{vector_ctes('v', QV_SQL, DV_SQL, 2 * K_FUSED)},{fuse_ctes('h', 'b_top', 'v_top', K_FUSED)},\n"
    "judged AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b "
    "JOIN documents d ON contains(d.text, b.text)),\n"
    f"{_quality_sql('keyword', 'b_top')},\n{_quality_sql('hybrid', 'h_top')}\n"
    "SELECT k.*, h.hybrid_recall, h.hybrid_mrr, h.hybrid_mrr > k.keyword_mrr AS hybrid_beats_keyword "
    "FROM keyword_m k JOIN hybrid_m h USING (query_id)"))
def search_quality(spark, sf_dir):
    """Keyword vs hybrid recall@5 and MRR per judged query."""
    tm = TicketModel(spark, sf_dir)
    idx = doc_postings(tm)
    judg = R.contains_judgments(bench_queries(tm), doc_texts(tm), idx)
    kw = R.keyword_topk(idx, bench_queries(tm), K_FUSED)
    hy = _hybrid(spark, sf_dir, index=idx)
    a = R.ranking_quality(kw, judg, K_FUSED, "keyword")
    b = R.ranking_quality(hy, judg, K_FUSED, "hybrid").drop("n_relevant")
    return a.join(b, "query_id").withColumn(
        "hybrid_beats_keyword", F.col("hybrid_mrr") > F.col("keyword_mrr"))


@register("j25_index_health", sql("""
SELECT CAST(count(*) AS BIGINT) AS documents,
       CAST(count(e.embedding) AS BIGINT) AS with_vector,
       CAST(count(*) FILTER (WHERE e.embedding IS NULL OR len(e.embedding) = 0 OR len(e.embedding) <> 64) AS BIGINT)
         AS missing_or_bad_vector,
       round(count(e.embedding) / count(*), 6) AS coverage
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id"""))
def index_health(spark, sf_dir):
    """Document coverage by vectors and empty or wrong-sized vectors."""
    tm = TicketModel(spark, sf_dir)
    return R.index_health(doc_texts(tm), doc_vectors(tm), dim=64)


# ---- J1-J5: search documents ---------------------------------------------------------------------------

@register("j01_kb_search_docs", sql(f"""
SELECT 'kb_' || CAST(kb_article_id AS VARCHAR) AS id, CAST(kb_article_id AS VARCHAR) AS article_id,
       {initcap_sql('title_raw')} AS title,
       content_text AS content, category_name AS category, category_subcategory AS subcategory,
       view_count, useful_count, 'https://tickets.example.invalid/kb/' || CAST(kb_article_id AS VARCHAR) AS source_url
FROM kb""", "kb"))
def kb_docs(spark, sf_dir):
    """KB index documents."""
    return SD.kb_search_docs(TicketModel(spark, sf_dir).kb_articles())


def _incident_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incident_docs(TicketModel(spark, sf_dir))


INC_DOCS_SQL = """
WITH wn AS (SELECT incident_id, string_agg(note_text, chr(10) ORDER BY created_at, note_id) AS work_notes
            FROM notes WHERE NOT is_resolution AND trim(note_text) <> '' GROUP BY incident_id),
rn AS (SELECT incident_id, string_agg(note_text, chr(10) ORDER BY created_at, note_id) AS resolution_notes
       FROM notes WHERE is_resolution AND trim(note_text) <> '' GROUP BY incident_id),
ds AS (SELECT doc_id AS incident_id, text AS description FROM documents WHERE text IS NOT NULL),
ks AS (SELECT incident_id FROM ds UNION SELECT incident_id FROM wn UNION SELECT incident_id FROM rn),
base AS (SELECT i.*, concat_ws(' ', i.category_name, 'issue reported by', i.requester_name) AS short_description,
                ds.description, wn.work_notes, rn.resolution_notes, reo.reopen_count
         FROM ks JOIN incd i USING (incident_id) LEFT JOIN ds USING (incident_id) LEFT JOIN wn USING (incident_id)
              LEFT JOIN rn USING (incident_id) LEFT JOIN reo USING (incident_id)),
st AS (SELECT *, 'description' AS content_type, description AS body FROM base
       UNION ALL SELECT *, 'work_notes', work_notes FROM base
       UNION ALL SELECT *, 'resolution_notes', resolution_notes FROM base),
idocs AS (SELECT 'incident_' || number || '_' || content_type AS id, CAST(incident_id AS VARCHAR) AS incident_id,
          state AS incident_state, short_description AS incident_summary, description, work_notes, resolution_notes,
          content_type, priority, category_name AS category, category_subcategory AS subcategory,
          assignment_group_name AS assigned_group, opened_at AS created_date, resolved_at AS closed_date,
          CAST(date_diff('minute', opened_at, resolved_at) AS INTEGER) AS resolution_time_minutes,
          CAST(reopen_count AS INTEGER) AS reopen_count,
          'https://tickets.example.invalid/incident/' || CAST(incident_id AS VARCHAR) AS incident_url
          FROM st WHERE body IS NOT NULL AND trim(body) <> '')"""


@register("j02_incident_search_docs", sql(INC_DOCS_SQL + "\nSELECT * FROM idocs", "incd", "notes", "reo"))
def incident_search_docs(spark, sf_dir):
    """Up to three documents per incident, blank ones skipped, all texts on each."""
    return _incident_docs(spark, sf_dir)


ATT_DOCS_SQL = f"""
SELECT 'attachment_' || asset_id AS id, asset_id AS attachment_id, file_name,
       lower(regexp_extract(file_name, '\\.([^.]*)$', 1)) AS file_type, description,
       CAST(incident_id AS VARCHAR) AS incident_id,
       {ASSET_TYPE_SQL} AS attachment_type,
       CAST(file_size_kb AS BIGINT) * 1024 AS size_bytes, mock_url,
       'https://tickets.example.invalid/incident/' || CAST(incident_id AS VARCHAR) AS incident_url
FROM (SELECT attachment_id AS asset_id, incident_id, file_name, description, file_size_kb, mock_url FROM att
      UNION ALL SELECT image_id, incident_id, file_name, description, NULL, mock_url FROM img)"""


def _asset_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asset_docs(TicketModel(spark, sf_dir))


@register("j03_i17_attachment_search_docs", sql(ATT_DOCS_SQL, "att", "img"))
def attachment_docs(spark, sf_dir):
    """J3 + I17: attachment index documents with asset type from the extension."""
    return _asset_docs(spark, sf_dir)


@register("j04_embed_text_attachments", sql(f"""
SELECT id, concat_ws(' ', CASE WHEN trim(file_name) <> '' THEN file_name END,
                     CASE WHEN trim(description) <> '' THEN description END) AS embed_text
FROM ({ATT_DOCS_SQL})""", "att", "img"))
def embed_text_attachments(spark, sf_dir):
    """Text to embed per attachment document (whole text)."""
    d = _asset_docs(spark, sf_dir)
    return d.select("id", SD.embed_text("attachment", d).alias("embed_text"))


EMBED_KB_SQL = """concat_ws(' ', CASE WHEN trim(title_raw) <> '' THEN title_raw END,
                     CASE WHEN trim(content_text) <> '' THEN content_text END)"""


@register("j05_embed_batches", sql(f"WITH {embed_ctes('e', f'SELECT {EMBED_KB_SQL} AS text FROM kb')}" + f"""
SELECT 'kb_' || CAST(kb_article_id AS VARCHAR) AS id, CAST(i AS INTEGER) AS place,
       COALESCE(round(vec[i + 1] / sqrt(nullif(list_sum(list_transform(vec, lambda x: x * x)), 0)), 6), 0.0e0) AS value
FROM kb JOIN e_v ON e_v.text = {EMBED_KB_SQL}, (SELECT unnest(range(64)) AS i)""", "kb"))
def embed_batches(spark, sf_dir):
    """(id, place, value) of the unit vector of every KB document, embedded into a new store."""
    kb = R.spread(SD.kb_search_docs(TicketModel(spark, sf_dir).kb_articles()))
    kb = kb.withColumn("embed_text", SD.embed_text("kb", kb))
    store = SD.VectorStore(spark, work_dir(spark, "embedded"))
    vectors = store.vectors(kb, "id", "embed_text").withColumn("vector", SD.unit_length(F.col("vector")))
    return vectors.select("id", F.posexplode("vector").alias("place", "x")) \
        .select("id", "place", F.round("x", 6).alias("value"))


# ---- J16-J22: uniform hits, multi-index search, knowledge search, similar incidents, assets -------------------

INCIDENT_FIELDS = FIELDS["incident"]


def _multi_index(spark: SparkSession, sf_dir: str, k: int,
                 indexes: tuple[str, ...] = ("kb", "incident", "attachment")) -> DataFrame:
    """Keyword top k per (query, index) over the given indexes."""
    queries = bench_queries(TicketModel(spark, sf_dir))
    found = [(name, SearchIndex(spark, sf_dir, name)) for name in indexes]
    return reduce(DataFrame.unionByName, [
        R.keyword_topk(index.terms(), queries, k, index.weights).withColumn("index_name", F.lit(name))
        for name, index in found])


def _multi_sql(k: int) -> str:
    """CTEs ending in hits(query_id, doc_id, score, rank, index_name): top ``k`` of each index."""
    kb = bm25_ctes("bk", "SELECT 'kb_' || CAST(kb_article_id AS VARCHAR) AS doc_id, title_raw AS title, "
                         "content_text AS content FROM kb",
                   {"title": "title", "content": "content"}, Q_SQL, k, R.KB_FIELD_WEIGHTS)
    inc = bm25_ctes("bi", "SELECT id AS doc_id, incident_summary, description, work_notes, resolution_notes "
                          "FROM idocs", INCIDENT_FIELDS, Q_SQL, k, R.INCIDENT_FIELD_WEIGHTS)
    att = bm25_ctes("ba", "SELECT id AS doc_id, file_name, description FROM adocs",
                    {"file_name": "file_name", "description": "description"}, Q_SQL, k)
    return (INC_DOCS_SQL + f",\nadocs AS ({ATT_DOCS_SQL}),{kb},{inc},{att},\n"
            """hits AS (SELECT query_id, doc_id, score, rank, 'kb' AS index_name FROM bk_top
         UNION ALL SELECT query_id, doc_id, score, rank, 'incident' FROM bi_top
         UNION ALL SELECT query_id, doc_id, score, rank, 'attachment' FROM ba_top)""")


MULTI_SQL = _multi_sql(3)


@register("j22_multi_index_search", sql(MULTI_SQL + "\nSELECT query_id, doc_id, score, rank, index_name FROM hits",
                                        "incd", "notes", "reo", "kb", "att", "img"))
def multi_index_search(spark, sf_dir):
    """Top 3 per (query, index) over the three indexes, combined."""
    return _multi_index(spark, sf_dir, 3).select("query_id", "doc_id", "score", "rank", "index_name")


def format_hits(spark: SparkSession, sf_dir: str, hits: DataFrame) -> DataFrame:
    """J16 + J17 + J18: the hits' columns with source_type, source_id, title, snippet, url and metadata.

    Hits meet the written documents of each index; metadata holds what the kind
    of source has, without nulls.  Hits are written first, so the planner knows
    how few they are and doesn't shuffle and sort all documents for them.
    """
    c = F.col
    folder = work_dir(spark, "hits")
    hits.write.parquet(folder)
    hits = spark.read.parquet(folder)

    def shaped(name: str, source: str, title: Column, snippet: Column, url: Column, **metadata: Column) -> DataFrame:
        docs = SearchIndex(spark, sf_dir, name).docs
        return docs.select("doc_id", F.struct(
            R.infer_source_type(c("doc_id"), docs).alias("source_type"), c(source).alias("source_id"),
            title.alias("title"), snippet.alias("snippet"), url.alias("url"),
            R.present(**metadata).alias("metadata")).alias("shape"))

    body = R.snippet(F.coalesce(*[F.nullif(x, F.lit("")) for x in ("resolution_notes", "work_notes", "description")]))
    shapes = [
        shaped("kb", "article_id", c("title"), R.snippet(c("content")), c("source_url"),
               **{x: c(x) for x in ("category", "subcategory", "view_count", "useful_count")}),
        shaped("incident", "incident_id", c("incident_summary"),
               F.when(body.startswith(c("content_type")), body)
                .otherwise(F.concat(F.lit("["), c("content_type"), F.lit("] "), body)), c("incident_url"),
               **{x: c(x) for x in ("incident_state", "content_type", "priority", "category", "subcategory",
                                    "assigned_group", "created_date", "closed_date", "resolution_time_minutes",
                                    "reopen_count")}),
        shaped("attachment", "attachment_id", c("file_name"), R.snippet(c("description")),
               F.coalesce("mock_url", "incident_url"),
               **{x: c(x) for x in ("file_type", "attachment_type", "incident_id", "size_bytes")}),
    ]
    found = reduce(DataFrame.unionByName, shapes).join(hits.select("doc_id").distinct(), "doc_id")
    return hits.join(found, "doc_id", "left").select(
        *[c(x) for x in hits.columns],
        F.coalesce("shape.source_type", R.infer_source_type(c("doc_id"))).alias("source_type"),
        F.coalesce("shape.source_id", "doc_id").alias("source_id"), F.coalesce("shape.title", "doc_id").alias("title"),
        F.coalesce("shape.snippet", F.lit("")).alias("snippet"), F.coalesce("shape.url", F.lit("")).alias("url"),
        F.coalesce("shape.metadata", F.create_map().cast("map<string,string>")).alias("metadata"))


def listed(metadata: Column) -> Column:
    """A map as 'name=value; ...' in the order it was made."""
    return F.array_join(F.transform(F.map_entries(metadata), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")


def _listed_sql(*names: str) -> str:
    return "concat_ws('; ', " + ", ".join(f"'{n}=' || CAST({n} AS VARCHAR)" for n in names) + ")"


SHAPES_SQL = f"""
shapes AS (
  SELECT 'kb_' || CAST(kb_article_id AS VARCHAR) AS doc_id, 'kb_article' AS source_type,
         CAST(kb_article_id AS VARCHAR) AS source_id, {initcap_sql('title_raw')} AS title,
         substr(COALESCE(content_text, ''), 1, 300) AS snippet,
         'https://tickets.example.invalid/kb/' || CAST(kb_article_id AS VARCHAR) AS url,
         {_listed_sql('category', 'subcategory', 'view_count', 'useful_count')} AS metadata
  FROM (SELECT *, category_name AS category, category_subcategory AS subcategory FROM kb)
  UNION ALL
  SELECT id, 'incident', incident_id, incident_summary,
         CASE WHEN starts_with(body, content_type) THEN body ELSE '[' || content_type || '] ' || body END, incident_url,
         {_listed_sql('incident_state', 'content_type', 'priority', 'category', 'subcategory', 'assigned_group',
                      'created_date', 'closed_date', 'resolution_time_minutes', 'reopen_count')}
  FROM (SELECT *, substr(COALESCE(nullif(resolution_notes, ''), nullif(work_notes, ''), nullif(description, ''), ''),
                         1, 300) AS body FROM idocs)
  UNION ALL
  SELECT id, 'attachment', attachment_id, file_name, substr(COALESCE(description, ''), 1, 300),
         COALESCE(mock_url, incident_url), {_listed_sql('file_type', 'attachment_type', 'incident_id', 'size_bytes')}
  FROM adocs)"""


@register("j16_j17_j18_uniform_hits", sql(MULTI_SQL + f""",{SHAPES_SQL}
SELECT h.query_id, h.index_name, h.rank, s.source_type, s.source_id, s.title, s.snippet, s.url, s.metadata,
       round(h.score, 4) AS score
FROM hits h JOIN shapes s USING (doc_id)""", "incd", "notes", "reo", "kb", "att", "img"))
def uniform_hits(spark, sf_dir):
    """Multi-index hits mapped to one uniform result shape, metadata listed."""
    return format_hits(spark, sf_dir, _multi_index(spark, sf_dir, 3)).select(
        "query_id", "index_name", "rank", "source_type", "source_id", "title", "snippet", "url",
        listed(F.col("metadata")).alias("metadata"), F.round("score", 4).alias("score"))


def search_knowledge(spark: SparkSession, sf_dir: str, queries: DataFrame, k: int = K_FUSED) -> DataFrame:
    """Hybrid search of the KB and incident indexes, merged: the k best hits of each query as citations.

    ``queries``: (query_id, text, ticket, content_types); a null list of
    content types asks for all, ``ticket`` is left out of the results.
    """
    bits = F.create_map(*[x for n, b in KINDS.items() for x in (F.lit(n), F.lit(b))])
    kinds = F.when(F.col("content_types").isNull(), F.lit(-1)).otherwise(F.aggregate(
        "content_types", F.lit(0), lambda s, n: s.bitwiseOR(F.coalesce(F.try_element_at(bits, n), F.lit(0)))))
    q = queries.select("query_id", "text", F.col("ticket").cast("string").alias("ticket"), kinds.alias("kinds"))
    hits = reduce(DataFrame.unionByName, [
        hybrid_search(SearchIndex(spark, sf_dir, name), q, k).withColumn("index_name", F.lit(name))
        for name in ("kb", "incident")])
    top = R.rank_top(hits.select("query_id", "doc_id", "index_name", "score"), R.clamp_k(k))
    return format_hits(spark, sf_dir, top).withColumn("confidence", R.confidence(F.col("score")))


def knowledge_queries(tm: TicketModel) -> DataFrame:
    """The benchmark texts, each asked for the ticket of its number: all content, articles alone, or notes alone."""
    turn = F.col("query_id") % 3
    types = F.when(turn == 1, F.array(F.lit("kb_article"))) \
        .when(turn == 2, F.array(F.lit("work_note"), F.lit("resolution_note")))
    return bench_queries(tm).select("query_id", "text", F.col("query_id").alias("ticket"), types.alias("content_types"))


EMBED_INC_SQL = "concat_ws(' ', " + ", ".join(
    f"CASE WHEN trim({c}) <> '' THEN {c} END" for c in INCIDENT_FIELDS) + ")"
KIND_SQL = "CASE content_type WHEN 'description' THEN 2 WHEN 'work_notes' THEN 4 WHEN 'resolution_notes' THEN 8 END"
INC_HYBRID_SQL = (f"SELECT id AS doc_id, incident_summary, description, work_notes, resolution_notes, "
                  f"{EMBED_INC_SQL} AS embed, {KIND_SQL} AS kind, incident_id AS owner FROM idocs")
KB_HYBRID_SQL = (f"SELECT 'kb_' || CAST(kb_article_id AS VARCHAR) AS doc_id, title_raw AS title, content_text AS content, "
                 f"{EMBED_KB_SQL} AS embed, 1 AS kind, '' AS owner FROM kb")
KNOWLEDGE_Q_SQL = ("SELECT item_id AS query_id, text, CAST(item_id AS VARCHAR) AS ticket, "
                   "CASE item_id % 3 WHEN 1 THEN 1 WHEN 2 THEN 12 ELSE -1 END AS kinds FROM benchmark")


@register("j19_search_knowledge", sql(INC_DOCS_SQL + f",\nadocs AS ({ATT_DOCS_SQL})," + hybrid_ctes(
    "k", KB_HYBRID_SQL, FIELDS["kb"], KNOWLEDGE_Q_SQL, K_FUSED, R.KB_FIELD_WEIGHTS) + "," + hybrid_ctes(
    "i", INC_HYBRID_SQL, INCIDENT_FIELDS, KNOWLEDGE_Q_SQL, K_FUSED, R.INCIDENT_FIELD_WEIGHTS) + f""",
hits AS (SELECT query_id, doc_id, score, 'kb' AS index_name FROM k_top
         UNION ALL SELECT query_id, doc_id, score, 'incident' FROM i_top),{SHAPES_SQL}
SELECT query_id, doc_id, index_name, source_type, source_id, title, snippet, url, score, rank,
       least(1.0e0, score / 4.0e0) AS confidence FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS INTEGER) AS rank
  FROM hits) JOIN shapes USING (doc_id) WHERE rank <= 5""", "incd", "notes", "reo", "kb", "att", "img"))
def knowledge(spark, sf_dir):
    """J19 + B12 + B14 + G5 + I21: hybrid search of articles and tickets by content type, own ticket left out."""
    return search_knowledge(spark, sf_dir, knowledge_queries(TicketModel(spark, sf_dir))).drop("metadata")


@register("j20_b12_b13_similar_incidents", sql(INC_DOCS_SQL + ",\n" + hybrid_ctes(
    "bs", INC_HYBRID_SQL.replace(KIND_SQL, f"CASE WHEN lower(incident_state) IN ('resolved', 'closed') THEN {KIND_SQL} "
                                           "ELSE 0 END"), INCIDENT_FIELDS,
    "SELECT d.doc_id AS query_id, d.text, CAST(d.doc_id AS VARCHAR) AS ticket, -1 AS kinds FROM documents d "
    "JOIN inc ON inc.incident_id = d.doc_id WHERE lower(inc.state) IN ('new', 'in progress', 'on hold')",
    K_FUSED, R.INCIDENT_FIELD_WEIGHTS) + """
SELECT query_id, doc_id, score, rank, incident_summary AS title, substr(COALESCE(i.resolution_notes, i.work_notes,
       i.description, ''), 1, 500) AS snippet, nullif(substr(COALESCE(i.resolution_notes, ''), 1, 500), '')
       AS resolution_note, incident_url AS url, incident_state AS state
FROM bs_top JOIN idocs i ON i.id = doc_id""",
    "incd", "notes", "reo", "inc"))
def similar_incidents(spark, sf_dir):
    """J20 + B12 + B13: for each open ticket with a description, the 5 most similar documents of other, resolved
    tickets by hybrid search, with their resolution text."""
    tm = TicketModel(spark, sf_dir)
    seeds = tm.incidents_base().where(is_open(F.col("state")))
    q = doc_texts(tm).join(seeds.select(F.col("incident_id").alias("doc_id")), "doc_id") \
        .select(F.col("doc_id").alias("query_id"), "text", F.col("doc_id").alias("ticket"))
    index = SearchIndex(spark, sf_dir, "incident")
    found = index.docs.select(
        "doc_id", F.col("incident_summary").alias("title"),
        R.snippet(F.coalesce("resolution_notes", "work_notes", "description"), 500).alias("snippet"),
        F.nullif(R.snippet(F.col("resolution_notes"), 500), F.lit("")).alias("resolution_note"),
        F.col("incident_url").alias("url"), F.col("incident_state").alias("state"))
    # the hits are a table of the index: queries of a session that build on them search once
    folder = index.table("similar", lambda to: hybrid_search(index, q, K_FUSED, resolved=True)
                         .select("query_id", "doc_id", "score", "rank").write.parquet(f"{to}/hits"))
    return spark.read.parquet(f"{folder}/hits").join(found, "doc_id")


@register("j21_attachment_lookup", sql(f"""
WITH req AS (SELECT incident_id AS request_id, incident_id AS ticket_id FROM inc
             WHERE lower(state) IN ('new', 'in progress', 'on hold')),
scope AS (SELECT request_id, ticket_id AS scope_ticket, true AS direct FROM req
          UNION ALL SELECT request_id, ticket_id - 1, false FROM req
          UNION ALL SELECT request_id, ticket_id + 1, false FROM req),
assets AS (SELECT attachment_id AS asset_id, incident_id, file_name, description, mock_url FROM att
           UNION ALL SELECT image_id, incident_id, file_name, description, mock_url FROM img),
hits AS (SELECT s.request_id, a.asset_id, {ASSET_TYPE_SQL} AS asset_type, a.incident_id AS related_ticket_id,
                a.file_name AS title, a.description AS summary, a.mock_url AS url, s.direct
         FROM scope s JOIN assets a ON a.incident_id = s.scope_ticket),
ranked AS (SELECT * FROM (
             SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY related_ticket_id, asset_id)
                            AS INTEGER) AS rank FROM hits) WHERE rank <= 10),
conf AS (SELECT request_id, CASE WHEN bool_or(direct) THEN 1.0e0 ELSE 0.6e0 END AS confidence
         FROM ranked GROUP BY request_id)
SELECT q.request_id, r.asset_id, r.asset_type, r.related_ticket_id, r.title, r.summary, r.url, r.rank,
       COALESCE(c.confidence, 0.0e0) AS confidence
FROM req q LEFT JOIN conf c USING (request_id) LEFT JOIN ranked r USING (request_id)""", "inc", "att", "img"))
def attachment_lookup(spark, sf_dir):
    """Assets of every open ticket and its related tickets, match-all keywords, ordered by
    ticket, top 10 per request; confidence 1.0 with a direct match, 0.6 with related only, 0 with none."""
    tm = TicketModel(spark, sf_dir)
    inc = tm.incidents_base()
    req = inc.where(is_open(F.col("state"))) \
        .select(F.col("incident_id").alias("request_id"), F.col("incident_id").alias("ticket_id"),
                F.array(F.col("incident_id") - 1, F.col("incident_id") + 1).alias("related_ticket_ids"))
    assets = tm.attachments().select(F.col("attachment_id").alias("asset_id"), "incident_id", "file_name",
                                     "description", "mock_url") \
        .unionByName(tm.images().select(F.col("image_id").alias("asset_id"), "incident_id", "file_name",
                                        "description", "mock_url"))
    return R.attachment_lookup(req, assets, k=10)

