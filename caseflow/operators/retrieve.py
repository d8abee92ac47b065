"""Batch retrieval as Spark jobs (J6-J25): a table of queries in, ranked hits out.

* Keyword: an inverted index is a postings DataFrame (doc, field, term, tf, dl),
  tokenised in one pass.  Scoring weighs each (document, term) once, then a
  block of documents meets a block of queries in one ``cogroup`` task that adds
  the weights per query and document, frequent terms as a matrix product, and
  keeps its own top k; a window merges the partial lists.  No (query, document) pair leaves its task unranked.
* Vector: exact cosine top-k computed block-wise.  Queries and documents are
  hashed into blocks of bounded size; every (query block, document block)
  pair meets in one ``cogroup`` task that runs a NumPy matrix product and keeps
  only its partial top k; a window then merges partial top-k lists.  No task
  ever holds more than one block of each side, and no pair list is
  materialised.  ``vector_index`` (J9) scans one byte a dimension instead and
  compares few documents in full.
* Hybrid: full outer join of keyword and vector candidates per (query, doc),
  linear fusion (or reciprocal-rank fusion) plus signal boosts, then top k.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.session import freed, settings
from caseflow.sources.landing import remove, work_dir

# Fixed values (ours where the reference leaves them to a hosted ranker).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
FUSION_KEYWORD_WEIGHT = 0.6
FUSION_VECTOR_WEIGHT = 0.4
# Field weights from the index definitions.
KB_FIELD_WEIGHTS = {"title": 2.0, "content": 1.0}
INCIDENT_FIELD_WEIGHTS = {"incident_summary": 2.0, "resolution_notes": 1.5, "work_notes": 1.0,
                          "description": 1.0}
# Vector blocks: at most this many rows per side meet in one task.
QUERY_BLOCK = 2048
DOC_BLOCK = 8192
# Keyword blocks: postings of a document block and terms of a query block, about.
BLOCK_POSTINGS = 2_000_000
BLOCK_TERMS = 2_000_000
# Documents of an Arrow batch where queries are asked in rounds.
ROUND_BATCH = 1024
# Scores of a batch of queries for a block of documents, about; a term is a matrix product from this share of them on.
BATCH_CELLS = 2_000_000
DENSE_SHARE = 0.05
# Terms of all queries that are broadcast, at most (some 20 bytes each).
BROADCAST_TERMS = 300_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script (same rule in the SQL oracles)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


# ---- J6 / J7: inverted index and BM25 -------------------------------------------------------

def build_postings(docs: DataFrame, id_col: str, fields: dict[str, str]) -> DataFrame:
    """Postings (doc_id, field, term, tf, dl) for the given text fields.

    One pass over the documents and no shuffle: the tokens of a row are sorted,
    so a term's frequency is the distance between two beginnings.  Only rows
    that share their id with others are summed afterwards.
    """
    def of_rows(rows: DataFrame) -> DataFrame:
        texts = F.array(*[F.struct(F.lit(f).alias("field"), F.sort_array(tokens(F.col(c))).alias("toks"))
                          for f, c in fields.items()])
        u = rows.select(F.col(id_col).alias("doc_id"), F.explode(texts).alias("x")) \
            .select("doc_id", "x.field", "x.toks", F.size("x.toks").alias("dl")).where("dl > 0")
        # both arrays are columns of their own: named in a lambda, an expression would be computed for each token
        begins = F.expr("filter(sequence(0, dl - 1), i -> i = 0 or toks[i] != toks[i - 1])")
        runs = F.expr("transform(begins, (b, j) -> struct(toks[b] as term, coalesce(get(begins, j + 1), dl) - b as tf))")
        return u.withColumn("begins", begins).select("doc_id", "field", "dl", F.explode(runs).alias("run")) \
            .select("doc_id", "field", "run.term", F.col("run.tf").cast("long").alias("tf"), "dl")

    ids = docs.groupBy(F.col(id_col).alias("doc_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if ids.isEmpty():
        return of_rows(docs)
    shared = F.col(id_col).eqNullSafe(F.col("_id"))
    ids = ids.withColumnRenamed("doc_id", "_id")
    summed = of_rows(docs.join(ids, shared, "left_semi")).groupBy("doc_id", "field", "term") \
        .agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    return of_rows(docs.join(ids, shared, "left_anti")).unionByName(summed)


class TermIndex:
    """A written inverted index: postings, per-field statistics (scalars) and the number of postings."""

    def __init__(self, postings: DataFrame, stats: dict[str, tuple[float, float]], size: int | None = None):
        self.postings = postings
        self.stats = stats
        self.size = postings.count() if size is None else size


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many tasks as there are cores: a small file comes as one partition."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def build_index(docs: DataFrame, id_col: str, fields: dict[str, str], folder: str | None = None) -> TermIndex:
    """Write the postings below ``folder`` (a new shared one by default) and open them.

    Scoring, statistics and every query read the written table instead of
    tokenising the corpus again.
    """
    folder = folder or work_dir(docs.sparkSession, "postings")
    texts = spread(docs.select(F.col(id_col), *[F.col(c) for c in dict.fromkeys(fields.values())]))
    build_postings(texts, id_col, fields).write.parquet(f"{folder}/postings")
    return open_index(docs.sparkSession, folder)


def open_index(spark: SparkSession, folder: str) -> TermIndex:
    """The index that ``build_index`` wrote."""
    post = spark.read.parquet(f"{folder}/postings")
    return TermIndex(post, stat_rows(post))


def field_stats(postings: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Per field: number of documents (of the ``candidates``) with the field and mean field length."""
    per_doc = postings.select("doc_id", "field", "dl").distinct()
    if candidates is not None:
        per_doc = per_doc.join(candidates.select("doc_id"), "doc_id", "left_semi")
    return per_doc.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))


def stat_rows(postings: DataFrame, candidates: DataFrame | None = None) -> dict[str, tuple[float, float]]:
    return {r["field"]: (float(r["n_docs"]), float(r["avgdl"])) for r in field_stats(postings, candidates).collect()}


def query_terms(queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """Distinct tokens per query (search mode 'any': a document may match any term)."""
    return queries.select(F.col(id_col).alias("query_id"),
                          F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))


def term_weights(postings: "DataFrame | TermIndex", terms: DataFrame, weights: dict[str, float] | None = None,
                 k1: float = BM25_K1, b: float = BM25_B, few: bool = False,
                 candidates: DataFrame | None = None) -> tuple[DataFrame, int]:
    """((doc_id, term, c) for the given terms, a row per field; number of indexed documents).

    ``few`` says that the terms were counted and fit a broadcast
    (``BROADCAST_TERMS``): postings are then filtered and weighed where they
    are read; otherwise they meet the terms in a shuffle.  With ``candidates``
    (doc_id) only their postings count; they meet those of the terms.

    c = w_f * ln(1 + (N_f - df + 0.5) / (df + 0.5))
        * tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl_f))
    """
    if isinstance(postings, TermIndex):
        stats, postings = postings.stats, postings.postings
    else:
        stats = stat_rows(postings)
    w = weights or {}
    p = postings.where(F.col("field").isin(list(w))) if w else postings
    if few:
        p = p.join(F.broadcast(terms), "term", "left_semi")
    if candidates is not None:
        p = p.join(candidates.select("doc_id"), "doc_id", "left_semi")
    hits = p
    if few:
        dfs = F.broadcast(hits.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")))
    else:  # counted before they meet the terms, so postings are shuffled once
        dfs = p.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).join(terms, "term", "left_semi")
    # index statistics are a few scalars per field (the caller fixes the fields): inlined as literals
    n_docs, avgdl, wcol = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(1.0)
    for f, (n, length) in stats.items():
        n_docs = F.when(F.col("field") == f, F.lit(n)).otherwise(n_docs)
        avgdl = F.when(F.col("field") == f, F.lit(length)).otherwise(avgdl)
    for f, v in w.items():
        wcol = F.when(F.col("field") == f, F.lit(float(v))).otherwise(wcol)
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    contrib = wcol * idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl))
    per_term = hits.join(dfs, ["field", "term"]).select("doc_id", "term", contrib.alias("c"))
    return per_term, int(max([n for n, _ in stats.values()], default=0))


def _first_k(ids: np.ndarray, scores: np.ndarray, k: int, digits: int) -> np.ndarray:
    """Places of the k best: rounded score descending, then id; exactly k, however many tie."""
    some = np.flatnonzero(np.isfinite(scores))
    if len(some) > k:
        kth = -np.partition(-scores[some], k - 1)[k - 1]
        some = some[scores[some] >= kth - 10.0 ** -digits]
    return some[np.lexsort((ids[some], -np.round(scores[some], digits)))[:k]]


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] numbers), then those of begin[1], and so on."""
    return np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())


class _Postings:
    """One block of postings by term; ``rows`` may repeat a (document, term), whose weights add up."""

    def __init__(self, rows: pd.DataFrame, places: pd.Index):
        doc = places.get_indexer(rows["doc_id"])
        some = np.flatnonzero(doc >= 0)
        self.n = len(places)
        order = some[np.argsort(rows["term"].to_numpy()[some], kind="stable")]
        term, self.doc, self.c = rows["term"].to_numpy()[order], doc[order], rows["c"].to_numpy()[order]
        self.terms, self.begin = np.unique(term, return_index=True)
        self.size = np.diff(np.r_[self.begin, len(term)])

    def batches(self, owner: np.ndarray, terms: np.ndarray):
        """(first query, their scores by document) of some queries after the other; ``owner`` numbers the queries from 0, ascending.

        Terms that many documents have are a matrix product, the others are
        added posting by posting.  A batch's scores and postings are bounded.
        """
        n_queries = int(owner[-1]) + 1 if len(owner) else 0
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        found = np.flatnonzero(self.terms[at] == terms) if len(self.terms) else np.zeros(0, int)
        owner, at = owner[found], at[found]
        cost = np.bincount(owner, self.size[at], n_queries) + self.n
        batch = (np.cumsum(cost) // BATCH_CELLS).astype(int)
        for first, last in zip(starts := np.flatnonzero(np.r_[True, batch[1:] != batch[:-1]]), np.r_[starts[1:], n_queries]):
            lo, hi = np.searchsorted(owner, (first, last))
            own, term, m = owner[lo:hi] - first, at[lo:hi], int(last - first)
            many = self.size[term] > self.n * DENSE_SHARE if m > 8 else np.zeros(len(term), bool)
            rare_own, rare = own[~many], term[~many]
            rows = _ragged(self.begin[rare], self.size[rare])
            cell = np.repeat(rare_own, self.size[rare]) * self.n + self.doc[rows]
            total = np.bincount(cell, self.c[rows], m * self.n).astype(float).reshape(m, self.n)
            dense = np.unique(term[many])
            step = max(1, BATCH_CELLS // self.n)
            for i in range(0, len(dense), step):
                part = dense[i:i + step]
                of = np.searchsorted(part, term[many])
                of[of == len(part)] = 0
                here = part[of] == term[many]
                asked = np.zeros((m, len(part)))
                asked[own[many][here], of[here]] = 1.0
                rows = _ragged(self.begin[part], self.size[part])
                cell = np.repeat(np.arange(len(part)), self.size[part]) * self.n + self.doc[rows]
                total += asked @ np.bincount(cell, self.c[rows], len(part) * self.n).reshape(len(part), self.n)
            yield int(first), total


def in_rounds(queries: DataFrame, n: int, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``search`` of the queries, an n-th of them (by hash of query_id) at a time.

    Each round's result is written and its shuffles are gone before the next,
    so the disk holds what one round deals, however many queries there are.
    """
    spark = queries.sparkSession
    folder = work_dir(spark, "rounds")
    # another hash than the one that deals blocks, or a round's queries would share few of them
    of = F.pmod(F.xxhash64("query_id", F.lit("round")), F.lit(n)).cast("int")
    with freed(spark):
        # written once, so that no round makes the queries again
        queries.withColumn("_round", of).repartition("_round").write.partitionBy("_round").parquet(f"{folder}/queries")
        asked = spark.read.schema(T.StructType([*queries.schema.fields, T.StructField("_round", T.IntegerType())])) \
            .parquet(f"{folder}/queries")
        out = None
        for i in range(n):
            out = search(asked.where(F.col("_round") == i).drop("_round"))
            out.write.mode("append").parquet(f"{folder}/found")
    remove(spark, f"{folder}/queries")
    return spark.read.schema(out.schema).parquet(f"{folder}/found")


def _score_block(k: int, digits: int, columns: list[str], masked: bool, boosted: bool):
    def fn(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame([], columns=columns)
        if masked:  # rows without a weight are documents
            docs = rows[rows["c"].isna()].drop_duplicates("doc_id")
            mul, add, kind = (docs[c].to_numpy() for c in ("mul", "add", "kind"))
            places = pd.Index(docs["doc_id"])
            rows = rows[rows["c"].notna()]
        else:
            places = pd.Index(rows["doc_id"].unique())
        ids = places.to_numpy()
        names = ids.astype(str) if ids.dtype == object else ids
        number, query = pd.factorize(queries["query_id"])
        terms = queries["terms"].to_numpy()
        each = np.repeat(number, [len(t) for t in terms])
        order = np.argsort(each, kind="stable")
        first = queries.iloc[np.unique(number, return_index=True)[1]]
        scale, kinds = first["scale"].to_numpy(), first["kinds"].to_numpy()
        if masked:
            both = pd.factorize(pd.concat([docs["owner"], first["ticket"]], ignore_index=True))[0]
            owner, ticket = both[:len(docs)], both[len(docs):]
        out = [[], [], [], []]
        block = _Postings(rows, places)
        for begin, bm25 in block.batches(each[order], np.concatenate(terms)[order]):
            some = slice(begin, begin + len(bm25))
            final = bm25 * scale[some, None]
            if boosted:
                final = final * mul + add
            out_of = bm25 <= 0
            if masked:
                # a null owner or ticket is nobody's
                out_of |= (owner == ticket[some, None]) & (owner >= 0)
                out_of |= (kinds[some, None] & kind) == 0
            final[out_of] = -np.inf
            for q, own in enumerate(final):
                best = _first_k(names, own, k, digits)
                for column, values in zip(out, ([query[begin + q]] * len(best), ids[best], bm25[q, best], own[best])):
                    column.extend(values)
        return pd.DataFrame(dict(zip(columns, out)))
    return fn


def bm25_topk(postings: "DataFrame | TermIndex", queries: DataFrame, k: int, weights: dict[str, float] | None = None,
              profile: DataFrame | None = None, digits: int = 6, candidates: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, bm25, score, rank): k best documents that share a term with the query.

    score = bm25 * scale * mul + add: ``queries`` may carry a scale, ``profile``
    (doc_id, mul, add, owner, kind) factors and boosts of documents, so a profile
    changes the order before the cut; a document isn't given to a query whose
    ``ticket`` (its id by default) is the document's ``owner``, nor to one whose
    ``kinds`` (bits, all by default) lack its ``kind``.  Ties go to the lesser
    doc_id.  Terms meet by 64-bit hashes.

    Documents are dealt into blocks by the number of postings, at least one for
    each core.  Where the terms of all queries don't fit one task, queries are
    asked in rounds (``_bm25_in_rounds``), and no posting is dealt twice.
    """
    scale = F.col("scale") if "scale" in queries.columns else F.lit(1.0)
    kinds = F.col("kinds") if "kinds" in queries.columns else F.lit(-1)
    ticket = F.col("ticket") if "ticket" in queries.columns else F.col("query_id")
    qt = queries.select("query_id", scale.cast("double").alias("scale"), kinds.cast("long").alias("kinds"),
                        ticket.alias("ticket"), F.array_distinct(tokens(F.col("text"))).alias("terms")).where(F.size("terms") > 0)
    terms = qt.select(F.explode("terms").alias("term"))
    asked = qt.agg(F.sum(F.size("terms")).alias("n"), F.bit_or("kinds").alias("kinds")).first()
    n_terms = asked.n or 0
    few = n_terms <= BROADCAST_TERMS or terms.distinct().count() <= BROADCAST_TERMS
    c, n_docs = term_weights(postings, terms.distinct(), weights, few=few, candidates=candidates)
    query_type, doc_type = dict(qt.dtypes)["query_id"], dict(c.dtypes)["doc_id"]
    c = c.withColumn("term", F.xxhash64("term"))
    size = postings.size if isinstance(postings, TermIndex) else postings.count()
    if profile is not None:
        have = set(profile.columns)
        defaults = (("mul", 1.0, "double"), ("add", 0.0, "double"), ("owner", None, dict(qt.dtypes)["ticket"]), ("kind", -1, "long"))
        extra = profile.select("doc_id", *[(F.col(x) if x in have else F.lit(v)).cast(t).alias(x)
                                           for x, v, t in defaults])
        if "kind" in have:  # documents of no wanted kind are left out before they are dealt
            extra = extra.where(F.col("kind").bitwiseAND(F.lit(asked.kinds or 0).cast("long")) != 0)
            wanted = extra.select("doc_id")
            n_wanted = wanted.count()
            size = size * n_wanted // max(n_docs, n_wanted, 1)
            c = c.join(F.broadcast(wanted) if n_wanted <= BROADCAST_TERMS else wanted, "doc_id", "left_semi")
        # documents are rows of their own beside the postings; integers have no nulls, which pandas would make floats
        c = c.unionByName(extra, allowMissingColumns=True).fillna(0, ["term", "kind"])
    cores = queries.sparkSession.sparkContext.defaultParallelism
    n_doc = max(1, min(n_docs, max(cores, -(-size // BLOCK_POSTINGS))))
    n_query = max(1, -(-n_terms // BLOCK_TERMS))

    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    qt = qt.withColumn("terms", F.transform("terms", lambda t: F.xxhash64(t)))
    columns = ["query_id", "doc_id", "bm25", "raw"]
    score = _score_block(k, digits, columns, profile is not None,
                         profile is not None and bool({"mul", "add"} & set(profile.columns)))
    out_type = f"query_id {query_type}, doc_id {doc_type}, bm25 double, raw double"
    if n_query > 1:
        return _bm25_in_rounds(c, qt, n_query, n_doc, k, digits, score, out_type)
    left = dealt(qt, "query_id", "_qb", n_query, "_db", n_doc).groupBy("_qb", "_db")
    right = dealt(c, "doc_id", "_db", n_doc, "_qb", n_query) \
        .groupBy("_qb", "_db")
    partial = left.cogroup(right).applyInPandas(score, out_type)
    return rank_top(partial.select("query_id", "doc_id", "bm25", F.round("raw", digits).alias("score")), k)


def _bm25_in_rounds(c: DataFrame, qt: DataFrame, n_query: int, n_doc: int, k: int, digits: int, score: Callable,
                    out_type: str) -> DataFrame:
    """``bm25_topk`` of more queries than fit a task: weights are written by document once, queries go by in rounds.

    A round's queries, some ``BLOCK_TERMS`` terms, are broadcast; a task reads
    its documents a block at a time and hands on its k best of each query, so
    what is shuffled in a round doesn't grow with blocks, and neither queries
    nor postings are copied on disk.
    """
    spark = c.sparkSession
    extra = [x for x in c.columns if x not in ("doc_id", "term", "c")]
    folder = work_dir(spark, "weights")
    with freed(spark):
        c.repartition(n_doc, "doc_id").groupBy("doc_id").agg(
            F.collect_list(F.when(F.col("c").isNotNull(), F.struct("term", "c"))).alias("held"),
            # documents are rows of their own, without a weight
            *[F.max(F.when(F.col("c").isNull(), F.col(x))).alias(x) for x in extra], F.count_if(F.col("c").isNull()).alias("named")) \
            .select("doc_id", F.col("held.term").alias("terms"), F.col("held.c").alias("weights"), *extra, "named") \
            .write.parquet(folder)
    sent = []

    def search(some: DataFrame) -> DataFrame:
        while sent:  # the round before has been written
            sent.pop().destroy()
        sent.append(spark.sparkContext.broadcast(some.toPandas()))
        found = spark.read.parquet(folder).mapInPandas(_score_tasks(score, sent[0], extra, k, digits), out_type)
        return rank_top(found.select("query_id", "doc_id", "bm25", F.round("raw", digits).alias("score")), k)

    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROUND_BATCH),
                          "spark.sql.execution.arrow.pyspark.enabled": "true"}):
        out = in_rounds(qt, n_query, search)
    sent.pop().destroy()
    remove(spark, folder)
    return out


def _score_tasks(score: Callable, asked, extra: list[str], k: int, digits: int) -> Callable:
    def flat(docs: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(x) for x in docs["terms"]]
        rows = pd.DataFrame({"doc_id": np.repeat(docs["doc_id"].to_numpy(), sizes),
                             "term": np.concatenate(docs["terms"].to_numpy()), "c": np.concatenate(docs["weights"].to_numpy())})
        if not extra:
            return rows
        named = docs.loc[docs["named"] > 0, ["doc_id", *extra]].assign(term=0, c=np.nan)
        return pd.concat([rows.assign(mul=np.nan, add=np.nan, owner=None, kind=0), named.astype({"kind": "int64"})],
                         ignore_index=True)

    def best(parts: list[pd.DataFrame]) -> pd.DataFrame:
        """The k first of each query, in the order of ``_first_k``."""
        rows = pd.concat([p for p in parts if len(p)] or parts[:1], ignore_index=True)
        rows = rows.assign(_r=-np.round(rows["raw"].to_numpy(float), digits)).sort_values(["query_id", "_r", "doc_id"])
        rows = rows[rows.groupby("query_id").cumcount() < k].drop(columns="_r")
        # texts of several parts are several chunks, which Spark doesn't take from pandas
        return rows.assign(**{c: pd.Series(rows[c].to_numpy(object), rows.index, object) for c in ("query_id", "doc_id")
                              if not pd.api.types.is_numeric_dtype(rows[c])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, held, block, n = asked.value, [], [], 0
        for docs in batches:
            block.append(docs)
            n += sum(len(x) for x in docs["terms"])
            if n >= BLOCK_POSTINGS:
                held, block, n = [best([*held, score(queries, flat(pd.concat(block, ignore_index=True)))])], [], 0
        if block:
            held = [best([*held, score(queries, flat(pd.concat(block, ignore_index=True)))])]
        yield from held
    return run


def keyword_topk(postings: "DataFrame | TermIndex", queries: DataFrame, k: int, weights: dict[str, float] | None = None,
                 candidates: DataFrame | None = None, match_all_docs: DataFrame | None = None,
                 digits: int = 6, post_filter: bool = False) -> DataFrame:
    """Top k documents per query by BM25 (score rounded to ``digits``, ties by doc id).

    ``candidates`` (doc_id) restricts the searchable documents before ranking
    (J15: filters apply before top-k so k results remain).  Queries without
    any token (empty or '*') match all documents: they get the k lowest doc
    ids of ``match_all_docs`` with score 0.
    """
    if candidates is not None and post_filter:
        # J15 as the design documents describe it: search everything, then filter (may leave < k)
        top = keyword_topk(postings, queries, k, weights, None, match_all_docs, digits)
        return top.join(candidates.select("doc_id"), "doc_id", "left_semi")
    p = postings
    if candidates is not None:  # the index's statistics are those of the candidates
        base = postings.postings if isinstance(postings, TermIndex) else postings
        p = TermIndex(base, stat_rows(base, candidates), postings.size if isinstance(postings, TermIndex) else None)
    out = bm25_topk(p, queries, k, weights, digits=digits, candidates=candidates)
    if match_all_docs is not None:
        empty = queries.where(F.size(tokens(F.col("text"))) == 0).select("query_id")
        docs = match_all_docs.select("doc_id") if candidates is None else \
            match_all_docs.select("doc_id").join(candidates.select("doc_id"), "doc_id", "left_semi")
        # the k lowest ids are k scalars (k <= 20): fetched once, attached as a literal array
        first_k = [r[0] for r in docs.orderBy("doc_id").limit(k).collect()]
        ids = F.array(*[F.lit(v) for v in first_k]) if first_k else F.array().cast("array<long>")
        all_hits = empty.select("query_id", F.explode(ids).alias("doc_id")) \
            .withColumn("bm25", F.lit(0.0)).withColumn("score", F.lit(0.0))
        out = out.unionByName(rank_top(all_hits, k, "score"))
    return out


def rank_top(df: DataFrame, k: int, score: str = "score", partition: str = "query_id",
             tiebreak: str = "doc_id") -> DataFrame:
    """Rank within each query by score desc then doc id asc; keep k (WindowGroupLimit)."""
    w = Window.partitionBy(partition).orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .withColumn("rank", F.col("rank").cast("int"))


# ---- J8: exact vector top-k --------------------------------------------------------------------

def _blocks(df: DataFrame, id_col: str, part_cols: list[str], block: int, name: str) -> DataFrame:
    """Assign each row a block number in [0, n_blocks) of its partition, n = ceil(rows / block).

    Without partition columns n is one scalar (a distributed count); with them
    the counts, one row per partition value, are joined.
    """
    if not part_cols:
        n = max(1, -(-df.count() // block))
        return df.withColumn(f"_nb_{name}", F.lit(n)) \
            .withColumn(f"_b_{name}", F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int"))
    counts = df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn(f"_nb_{name}", F.greatest(F.lit(1), F.ceil(F.col("_n") / block)).cast("int")).drop("_n")
    joined = df.join(counts, part_cols)
    return joined.withColumn(f"_b_{name}", F.pmod(F.xxhash64(F.col(id_col)), F.col(f"_nb_{name}")).cast("int"))


def _topk_block(k: int, exclude_self: bool, digits: int):
    def fn(qpdf: pd.DataFrame, dpdf: pd.DataFrame) -> pd.DataFrame:
        if qpdf.empty or dpdf.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"),
                                 "doc_id": pd.Series([], dtype="int64"),
                                 "cosine": pd.Series([], dtype="float64")})
        q = np.vstack(qpdf["qvec"].to_numpy()).astype(np.float64)
        d = np.vstack(dpdf["dvec"].to_numpy()).astype(np.float64)
        qn = np.linalg.norm(q, axis=1, keepdims=True)
        dn = np.linalg.norm(d, axis=1, keepdims=True)
        q = np.divide(q, qn, out=np.zeros_like(q), where=qn > 0)
        d = np.divide(d, dn, out=np.zeros_like(d), where=dn > 0)
        sims = q @ d.T
        qids = qpdf["query_id"].to_numpy()
        dids = dpdf["doc_id"].to_numpy()
        if exclude_self:
            sims = np.where(qids[:, None] == dids[None, :], -np.inf, sims)
        best = [_first_k(dids, row, k, digits) for row in sims]
        rows = np.repeat(np.arange(len(best)), [len(x) for x in best])
        cols = np.concatenate(best)
        return pd.DataFrame({"query_id": qids[rows].astype("int64"), "doc_id": dids[cols].astype("int64"),
                             "cosine": sims[rows, cols]})
    return fn


def meet_in_blocks(queries: DataFrame, docs: DataFrame, partition_cols: list[str] | None, query_cols: list[str],
                   doc_cols: list[str], query_block: int = QUERY_BLOCK, doc_block: int = DOC_BLOCK):
    """The two groupings to ``cogroup``: each block of queries with each block of documents of its partition.

    Blocks are dealt by hash of query_id and doc_id.  A partition with many
    rows is split into more blocks, so none of its tasks grows.
    """
    pc = partition_cols or []
    q = _blocks(queries, "query_id", pc, query_block, "q")
    d = _blocks(docs, "doc_id", pc, doc_block, "d")
    if pc:
        # one row per partition value; fresh aliases avoid an ambiguous self-join
        dcount = d.select(*[F.col(c).alias(c) for c in pc], "_nb_d").distinct()
        qcount = q.select(*[F.col(c).alias(c) for c in pc], "_nb_q").distinct()
        q = q.join(dcount, pc)
        d = d.join(qcount, pc)
    else:
        n_q, n_d = (F.lit(max(1, -(-x.count() // n))) for x, n in ((queries, query_block), (docs, doc_block)))
        q, d = q.withColumn("_nb_d", n_d), d.withColumn("_nb_q", n_q)
    # Partition keys get fresh names (new attribute ids) on each side: both sides may
    # derive from one frame, and cogroup must not see one attribute on both children.
    pk = [F.col(c).alias(f"_pk{i}") for i, c in enumerate(pc)]
    qx = q.withColumn("_b_d", F.explode(F.sequence(F.lit(0), F.col("_nb_d") - 1))) \
        .select(*pk, "_b_q", "_b_d", *query_cols)
    dx = d.withColumn("_b_q", F.explode(F.sequence(F.lit(0), F.col("_nb_q") - 1))) \
        .select(*pk, "_b_q", "_b_d", *doc_cols)
    keys = [f"_pk{i}" for i in range(len(pc))] + ["_b_q", "_b_d"]
    return qx.groupBy(*keys), dx.groupBy(*keys)


def vector_topk(queries: DataFrame, docs: DataFrame, k: int, partition_cols: list[str] | None = None,
                exclude_self: bool = False, digits: int = 6, query_block: int = QUERY_BLOCK,
                doc_block: int = DOC_BLOCK) -> DataFrame:
    """Exact cosine top k per query (ties by doc id).

    ``queries``: (query_id bigint, qvec array<float>, *partition_cols);
    ``docs``: (doc_id bigint, dvec array<float>, *partition_cols).  With
    ``partition_cols`` a query only meets documents of its own partition
    (blocking, e.g. by category).  Hot partitions are split into more blocks,
    so a partition holding a third of all rows spreads over many tasks.
    """
    left, right = meet_in_blocks(queries, docs, partition_cols, ["query_id", "qvec"], ["doc_id", "dvec"],
                                 query_block, doc_block)
    partial = left.cogroup(right).applyInPandas(
        _topk_block(k, exclude_self, digits), "query_id long, doc_id long, cosine double")
    scored = partial.withColumn("score", F.round("cosine", digits))
    return rank_top(scored, k, "score")


# ---- J10-J14: fusion and boosts --------------------------------------------------------------------

def fuse_linear(keyword: DataFrame, vector: DataFrame, k: int, boosts: DataFrame | None = None,
                w_keyword: float = FUSION_KEYWORD_WEIGHT, w_vector: float = FUSION_VECTOR_WEIGHT,
                digits: int = 6) -> DataFrame:
    """J10 + J11: 0.6 * bm25 (scaled to [0, 1] by the query's best bm25) + 0.4 * cosine + boosts.

    ``keyword`` (query_id, doc_id, bm25), ``vector`` (query_id, doc_id, cosine),
    ``boosts`` (doc_id, boost).  Candidates come from either list (full outer join).
    """
    best = keyword.groupBy("query_id").agg(F.max("bm25").alias("_best"))
    kw = keyword.join(best, "query_id").select(
        "query_id", "doc_id", F.try_divide(F.col("bm25"), F.col("_best")).alias("bm25_norm"))
    j = kw.join(vector.select("query_id", "doc_id", "cosine"), ["query_id", "doc_id"], "full")
    score = F.lit(w_keyword) * F.coalesce(F.col("bm25_norm"), F.lit(0.0)) + \
        F.lit(w_vector) * F.coalesce(F.col("cosine"), F.lit(0.0))
    if boosts is not None:
        j = j.join(boosts.select("doc_id", "boost"), "doc_id", "left")
        score = score + F.coalesce(F.col("boost"), F.lit(0.0))
    j = j.withColumn("score", F.round(score, digits))
    return rank_top(j.select("query_id", "doc_id", F.round("bm25_norm", digits).alias("bm25_norm"),
                             F.round("cosine", digits).alias("cosine"), "score"), k, "score")


def fuse_rrf(ranked_lists: Iterable[DataFrame], k: int, rrf_k: int = RRF_K, digits: int = 6) -> DataFrame:
    """Reciprocal rank fusion: sum over lists of 1 / (60 + rank)."""
    parts = [r.select("query_id", "doc_id", (F.lit(1.0) / (F.lit(rrf_k) + F.col("rank"))).alias("rr"))
             for r in ranked_lists]
    u = reduce(DataFrame.unionByName, parts)
    s = u.groupBy("query_id", "doc_id").agg(F.round(F.sum("rr"), digits).alias("score"))
    return rank_top(s, k, "score")


def signal_boosts(useful_count: Column | None = None, view_count: Column | None = None,
                  resolution_minutes: Column | None = None, reopen_count: Column | None = None,
                  updated: Column | None = None, priority_rank: Column | None = None,
                  as_of: str | None = None) -> Column:
    """Additive boosts from the design table (absent signals add nothing)."""
    terms = []
    if useful_count is not None:
        terms.append(F.when(useful_count > 50, 0.2))
    if view_count is not None:
        terms.append(F.when(view_count > 100, 0.15))
    if resolution_minutes is not None:
        terms.append(F.when(resolution_minutes < 120, 0.25))
    if reopen_count is not None:
        terms.append(F.when(reopen_count == 0, 0.15))
    if updated is not None and as_of is not None:
        terms.append(F.when(F.datediff(F.lit(as_of).cast("date"), updated.cast("date")) <= 90, 0.1))
    if priority_rank is not None:
        terms.append(F.when(priority_rank == 1, 0.2))
    return reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms], F.lit(0.0))


def magnitude(value: Column, lo: float, hi: float) -> Column:
    """Linear ramp from lo to hi clipped to [0, 1] (constant beyond the range)."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value.cast("double") - lo) / (hi - lo)))


def scoring_profile(score: Column, useful_count: Column, view_count: Column,
                    updated: Column | None = None, as_of: str | None = None) -> Column:
    """Score * (1 + sum((boost - 1) * f)) with magnitude boosts useful 50->500 x2,
    views 100->1000 x1.5 and freshness within 90 days x1.2 (combination rule ours)."""
    s = (2.0 - 1.0) * magnitude(useful_count, 50, 500) + (1.5 - 1.0) * magnitude(view_count, 100, 1000)
    if updated is not None and as_of is not None:
        days = F.datediff(F.lit(as_of).cast("date"), updated.cast("date"))
        s = s + (1.2 - 1.0) * F.coalesce(F.when(days <= 90, 1.0 - days / 90.0), F.lit(0.0))
    return score * (F.lit(1.0) + s)


# ---- J16 / J17 / J18: uniform hits ---------------------------------------------------------------------

def infer_source_type(id_col: Column, fields: DataFrame | None = None) -> Column:
    """Source type from the document id prefix, else from which of the hits' columns hold a value."""
    def has(*names: str) -> Column:
        if fields is None or not set(names) <= set(fields.columns):
            return F.lit(False)
        return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])

    return (F.when(id_col.startswith("kb_"), "kb_article")
             .when(id_col.startswith("incident_"), "incident")
             .when(id_col.startswith("attachment_"), "attachment")
             .when(has("article_id"), "kb_article")
             .when(has("incident_id", "content_type"), "incident")
             .when(has("attachment_id"), "attachment")
             .otherwise("unknown"))


def present(**values: Column) -> Column:
    """A map of the given values as text, without those that are null."""
    entries = [x for name, c in values.items() for x in (F.lit(name), c.cast("string"))]
    return F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())


def snippet(text: Column, n: int = 300) -> Column:
    """First 300 characters of the text."""
    return F.substring(F.coalesce(text, F.lit("")), 1, n)


def confidence(score: Column) -> Column:
    """min(1, score / 4)."""
    return F.least(F.lit(1.0), score / F.lit(4.0))


def clamp_k(k: int) -> int:
    """1 <= k <= 20."""
    return min(20, max(1, int(k)))


# ---- J24 / J25 -----------------------------------------------------------------------------------------------

def contains_judgments(queries: DataFrame, docs: DataFrame, postings: "DataFrame | TermIndex") -> DataFrame:
    """Relevance judgments: a document is relevant to a query when it contains the query text.

    Candidates come from an equi-join on the query's rarest interior token
    (every containing document has that token), then containment of the whole
    query text is verified on the candidates only.  Queries whose tokens are
    all at the edges fall back to their rarest token.

    Few terms are broadcast, so only their postings are shuffled; candidates
    are written, so the planner knows how many there are before texts move.
    """
    one_field = isinstance(postings, TermIndex) and len(postings.stats) == 1
    post = postings.postings if isinstance(postings, TermIndex) else postings
    qt = queries.select("query_id", "text", tokens(F.col("text")).alias("toks"))
    inner = qt.select("query_id", "text", F.when(F.size("toks") >= 3, F.slice("toks", 2, F.size("toks") - 2))
                      .otherwise(F.col("toks")).alias("cand"))
    ex = inner.select("query_id", F.explode(F.array_distinct("cand")).alias("term"))
    sized = F.broadcast if ex.count() <= BROADCAST_TERMS else (lambda df: df)
    hits = post.join(sized(ex.select("term").distinct()), "term", "left_semi")
    # with one field a document has one row of a term
    dfs = hits.groupBy("term").agg((F.count(F.lit(1)) if one_field else F.count_distinct("doc_id")).alias("df"))
    rarest = ex.join(dfs, "term").withColumn(
        "_r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("df").asc(), F.col("term").asc()))) \
        .where(F.col("_r") == 1).select("query_id", "term")
    folder = work_dir(queries.sparkSession, "candidates")
    post.select("term", "doc_id").join(sized(rarest), "term").select("query_id", "doc_id").distinct().write.parquet(folder)
    cand = queries.sparkSession.read.parquet(folder)
    return docs.select("doc_id", F.col("text").alias("dtext")).join(cand, "doc_id") \
        .join(queries.select("query_id", F.col("text").alias("qtext")), "query_id") \
        .where(F.instr(F.col("dtext"), F.col("qtext")) > 0).select("query_id", "doc_id")


def ranking_quality(ranked: DataFrame, judgments: DataFrame, k: int, label: str) -> DataFrame:
    """Recall@k and reciprocal rank of the first relevant hit per query."""
    rel = judgments.withColumn("_rel", F.lit(True))
    r = ranked.where(F.col("rank") <= k).join(rel, ["query_id", "doc_id"], "left")
    per_q = r.groupBy("query_id").agg(
        F.count_if(F.col("_rel")).alias(f"{label}_hits"),
        F.min(F.when(F.col("_rel"), F.col("rank"))).alias(f"{label}_first_rank"))
    n_rel = judgments.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return n_rel.join(per_q, "query_id", "left").select(
        "query_id", "n_relevant",
        F.round(F.coalesce(F.col(f"{label}_hits"), F.lit(0)) / F.col("n_relevant"), 6).alias(f"{label}_recall"),
        F.round(F.coalesce(F.lit(1.0) / F.col(f"{label}_first_rank"), F.lit(0.0)), 6).alias(f"{label}_mrr"))


def index_health(docs: DataFrame, vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """Coverage of documents by vectors and empty / wrong-sized vectors (one row)."""
    v = vectors.select("doc_id", "dvec")
    joined = docs.select("doc_id").join(v, "doc_id", "left")
    bad = (F.col("dvec").isNull()) | (F.size("dvec") == 0)
    if dim:
        bad = bad | (F.size("dvec") != dim)
    return joined.agg(
        F.count(F.lit(1)).cast("bigint").alias("documents"),
        F.count_if(F.col("dvec").isNotNull()).cast("bigint").alias("with_vector"),
        F.count_if(bad).cast("bigint").alias("missing_or_bad_vector"),
    ).withColumn("coverage", F.round(F.col("with_vector") / F.col("documents"), 6))




# ---- J21: attachment lookup -------------------------------------------------------------------------------

def attachment_lookup(requests: DataFrame, assets: DataFrame, k: int = 10,
                      asset_types: list[str] | None = None, keywords: list[str] | None = None) -> DataFrame:
    """Assets of each request's ticket and its related tickets.

    ``requests``: (request_id, ticket_id, related_ticket_ids array); ``assets``:
    (asset_id, incident_id, file_name, description, mock_url).  Optional asset
    type filter (OR) and keywords (any keyword token in name or description;
    none = match all).  Ordered by ticket then asset id, k per request;
    confidence of the returned assets: 1.0 with a direct match, 0.6 with
    related tickets only; a request without assets is one row with 0.
    """
    from caseflow.functions.columns import asset_type_from_name
    k = clamp_k(k)
    scope = requests.select("request_id", F.col("ticket_id").alias("scope_ticket"), F.lit(True).alias("direct")) \
        .unionByName(requests.select("request_id", F.explode("related_ticket_ids").alias("scope_ticket"),
                                     F.lit(False).alias("direct")))
    a = assets.withColumn("asset_type", asset_type_from_name(F.col("file_name")))
    if asset_types:
        a = a.where(F.col("asset_type").isin(list(asset_types)))
    if keywords:
        kw = F.array(*[F.lit(t) for w in keywords for t in re.findall(r"[^\W_]+", w.lower())])
        a = a.where(F.arrays_overlap(tokens(F.concat_ws(" ", F.col("file_name"), F.col("description"))), kw))
    hits = scope.join(a, a.incident_id == scope.scope_ticket).groupBy(
        "request_id", "asset_id", "asset_type", F.col("incident_id").alias("related_ticket_id"),
        F.col("file_name").alias("title"), F.col("description").alias("summary"), F.col("mock_url").alias("url")) \
        .agg(F.max("direct").alias("direct"))
    w = Window.partitionBy("request_id").orderBy(F.col("related_ticket_id").asc(), F.col("asset_id").asc())
    ranked = hits.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    conf = ranked.groupBy("request_id").agg(
        F.when(F.max("direct"), F.lit(1.0)).otherwise(F.lit(0.6)).alias("confidence"))
    return requests.select("request_id").join(conf, "request_id", "left").join(ranked, "request_id", "left").select(
        "request_id", "asset_id", "asset_type", "related_ticket_id", "title", "summary", "url", "rank",
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
