"""DuckDB restatements of BM25, exact cosine top-k and fusion for the retrieval oracles."""

from __future__ import annotations

TOK = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def bm25_ctes(p: str, docs_sql: str, fields: dict[str, str], queries_sql: str, k: int,
              weights: dict[str, float] | None = None) -> str:
    """CTE chain ending in ``{p}_top(query_id, doc_id, bm25, score, rank)``.

    ``docs_sql`` yields doc_id plus the field columns; ``queries_sql`` yields
    (query_id, text).  Literals are doubles so DuckDB never uses decimals.
    """
    toks = "\n    UNION ALL ".join(
        f"SELECT doc_id, '{f}' AS field, {TOK.format(x=c)} AS toks FROM {p}_d" for f, c in fields.items())
    w = weights or {}
    wexpr = "1.0e0" if not w else "CASE " + " ".join(
        f"WHEN field = '{f}' THEN CAST({float(v)} AS DOUBLE)" for f, v in w.items()) + " ELSE 1.0e0 END"
    field_filter = "" if not w else "WHERE field IN (" + ", ".join(f"'{f}'" for f in w) + ")"
    return f"""
{p}_d AS ({docs_sql}),
{p}_q AS ({queries_sql}),
{p}_t AS (
    {toks}),
{p}_p AS (SELECT doc_id, field, term, count(*) AS tf, max(dl) AS dl
          FROM (SELECT doc_id, field, len(toks) AS dl, unnest(toks) AS term FROM {p}_t WHERE len(toks) > 0)
          GROUP BY doc_id, field, term),
{p}_s AS (SELECT field, count(*) AS n_docs, avg(dl) AS avgdl
          FROM (SELECT DISTINCT doc_id, field, dl FROM {p}_p) GROUP BY field),
{p}_qt AS (SELECT DISTINCT query_id, term
           FROM (SELECT query_id, unnest({TOK.format(x='text')}) AS term FROM {p}_q)),
{p}_df AS (SELECT field, term, count(*) AS df FROM {p}_p WHERE term IN (SELECT term FROM {p}_qt)
           GROUP BY field, term),
{p}_sc AS (SELECT query_id, doc_id,
                  sum(({wexpr}) * ln(1.0e0 + (n_docs - df + 0.5e0) / (df + 0.5e0))
                      * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / avgdl))) AS bm25
           FROM (SELECT * FROM {p}_qt JOIN {p}_p USING (term) JOIN {p}_df USING (field, term)
                 JOIN {p}_s USING (field) {field_filter})
           GROUP BY query_id, doc_id),
{p}_top AS (SELECT * FROM (
              SELECT query_id, doc_id, bm25, round(bm25, 6) AS score,
                     CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(bm25, 6) DESC, doc_id ASC)
                          AS INTEGER) AS rank
              FROM {p}_sc) WHERE rank <= {k})"""


def vector_ctes(p: str, queries_sql: str, docs_sql: str, k: int, partition: str | None = None,
                exclude_self: bool = False) -> str:
    """CTE chain ending in ``{p}_top(query_id, doc_id, cosine, score, rank)``.

    ``queries_sql`` yields (query_id, qvec[, part]); ``docs_sql`` (doc_id, dvec[, part]).
    """
    cond = []
    if partition:
        cond.append(f"q.{partition} = d.{partition}")
    if exclude_self:
        cond.append("q.query_id <> d.doc_id")
    where = ("WHERE " + " AND ".join(cond)) if cond else ""
    return f"""
{p}_vq AS ({queries_sql}),
{p}_vd AS ({docs_sql}),
{p}_cs AS (SELECT q.query_id, d.doc_id,
                  list_cosine_similarity(CAST(q.qvec AS DOUBLE[]), CAST(d.dvec AS DOUBLE[])) AS cosine
           FROM {p}_vq q, {p}_vd d {where}),
{p}_top AS (SELECT * FROM (
              SELECT query_id, doc_id, cosine, round(cosine, 6) AS score,
                     CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, doc_id ASC)
                          AS INTEGER) AS rank
              FROM {p}_cs) WHERE rank <= {k})"""


def fuse_ctes(p: str, kw: str, vec: str, k: int, boosts_sql: str | None = None) -> str:
    """CTE ending in ``{p}_top(query_id, doc_id, bm25_norm, cosine, score, rank)``: 0.6 / 0.4 fusion."""
    boost_join = f"LEFT JOIN ({boosts_sql}) bo USING (doc_id)" if boosts_sql else ""
    boost = " + COALESCE(bo.boost, 0.0e0)" if boosts_sql else ""
    return f"""
{p}_kn AS (SELECT t.query_id, t.doc_id, t.bm25 / m.best AS bm25_norm
           FROM {kw} t JOIN (SELECT query_id, max(bm25) AS best FROM {kw} GROUP BY query_id) m USING (query_id)),
{p}_j AS (SELECT COALESCE(a.query_id, b.query_id) AS query_id, COALESCE(a.doc_id, b.doc_id) AS doc_id,
                 a.bm25_norm, b.cosine
          FROM {p}_kn a FULL JOIN (SELECT query_id, doc_id, cosine FROM {vec}) b
            ON a.query_id = b.query_id AND a.doc_id = b.doc_id),
{p}_f AS (SELECT query_id, doc_id, round(bm25_norm, 6) AS bm25_norm, round(cosine, 6) AS cosine,
                 round(0.6e0 * COALESCE(bm25_norm, 0.0e0) + 0.4e0 * COALESCE(cosine, 0.0e0){boost}, 6) AS score
          FROM {p}_j {boost_join}),
{p}_top AS (SELECT * FROM (
              SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC)
                             AS INTEGER) AS rank FROM {p}_f) WHERE rank <= {k})"""


def embed_ctes(p: str, texts_sql: str, dim: int = 64) -> str:
    """CTE chain ending in ``{p}_v(text, vec)``: hashed vectors of the distinct texts of ``texts_sql`` (text)."""
    return f"""
{p}_c AS (SELECT DISTINCT COALESCE(text, '') AS text FROM ({texts_sql})),
{p}_n AS (SELECT text, ('0x' || md5(term)[1:8])::BIGINT % {dim} AS place,
                 sum(CASE WHEN md5(term)[9] >= '8' THEN 1 ELSE -1 END) AS n
          FROM (SELECT text, unnest({TOK.format(x='text')}) AS term FROM {p}_c) GROUP BY 1, 2),
{p}_v AS (SELECT c.text, list(CAST(COALESCE(n, 0) AS DOUBLE) ORDER BY place) AS vec
          FROM (SELECT text, unnest(range({dim})) AS place FROM {p}_c) c LEFT JOIN {p}_n USING (text, place)
          GROUP BY c.text)"""


def hybrid_ctes(p: str, docs_sql: str, fields: dict[str, str], queries_sql: str, k: int,
                weights: dict[str, float] | None = None) -> str:
    """CTE chain ending in ``{p}_top``: keyword and vector candidates (2k each) of the wanted documents, fused.

    ``docs_sql`` yields doc_id, the fields, embed (the text embedded), kind and
    owner; ``queries_sql`` yields query_id, text, kinds and ticket.
    """
    keyword = bm25_ctes(p, docs_sql, fields, queries_sql, 2 * k, weights).replace(f"{p}_top AS", f"{p}_any AS")
    wanted = "(q.kinds & d.kind) <> 0 AND (q.ticket IS NULL OR d.owner IS DISTINCT FROM q.ticket)"
    best = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS INTEGER) AS rank"
    return f"""{keyword},
{p}_kw AS (SELECT * FROM (SELECT *, {best} FROM (
             SELECT s.query_id, s.doc_id, bm25, round(bm25, 6) AS score
             FROM {p}_sc s JOIN {p}_d d USING (doc_id) JOIN {p}_q q ON q.query_id = s.query_id WHERE {wanted}))
           WHERE rank <= {2 * k}),
{embed_ctes(p + "e", f"SELECT embed AS text FROM {p}_d UNION ALL SELECT text FROM {p}_q").lstrip()},
{p}_cos AS (SELECT query_id, doc_id, CASE WHEN isnan(c) THEN 0.0e0 ELSE c END AS cosine FROM (
             SELECT q.query_id, d.doc_id, list_cosine_similarity(a.vec, b.vec) AS c
             FROM {p}_q q JOIN {p}_d d ON {wanted}
                  JOIN {p}e_v a ON a.text = COALESCE(q.text, '') JOIN {p}e_v b ON b.text = COALESCE(d.embed, ''))),
{p}_vec AS (SELECT * FROM (SELECT *, {best} FROM (
             SELECT query_id, doc_id, cosine, round(cosine, 6) AS score FROM {p}_cos)) WHERE rank <= {2 * k}),
{fuse_ctes(p, f"{p}_kw", f"{p}_vec", k).lstrip()}"""
