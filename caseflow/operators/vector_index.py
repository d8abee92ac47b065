"""A product-quantised vector index with certified results.

Unit vectors lie in the cell of their nearest centre; what is left of them,
the residual, is cut into parts of a few dimensions, and each part is written
as one byte, the number of an entry in the part's codebook.  Centres and
codebooks are fitted on a bounded sample; every row is coded, and its code
carries the exact distance between the vector and what the code stands for.
As a unit query can't see more of that distance than there is, a scan of the
codes bounds every cosine from both sides.  A search scans the cells nearest
to a query, then those cells whose bound reaches the k-th score found, and
compares in full only documents whose upper bound reaches the k-th lower
bound.  So the result is that of exact search (J8), from a table a fourth of
the size and few full comparisons.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.retrieve import in_rounds, meet_in_blocks, rank_top
from caseflow.sources.landing import work_dir

#: Rows that centres and codebooks are fitted on, at most (every row is indexed).
SAMPLE_ROWS = 16_384
#: Rows of a cell, about, and cells at most.
CELL_ROWS = 4096
MAX_CELLS = 1024
#: Entries of a codebook: one byte each.
ENTRIES = 256
#: Dimensions of a part.
PART_DIMS = 1
#: Cells that a query scans first.
FIRST_CELLS = 8
#: Rows of either side that meet in one task.
QUERY_BLOCK, DOC_BLOCK = 512, 8192
#: Queries (rows, one for each part asked) that are searched at a time, about.
ROUND_QUERIES = 16_384
#: Scores are rounded before they are ranked, so bounds are taken this much wider.
SLACK = 2e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros stay."""
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.float64)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each row."""
    if centres.shape[1] == 1:
        order = np.argsort(centres[:, 0], kind="stable")
        edges = centres[order, 0]
        return order[np.searchsorted((edges[1:] + edges[:-1]) / 2, x[:, 0])]
    return np.argmin((centres ** 2).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def means(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most ``k`` centres of the rows, from rows spread over their order by the first principal axis."""
    middle = x - x.mean(axis=0)
    axis = np.linalg.svd(middle[:4096], full_matrices=False)[2][0] if len(x) > 1 else np.ones(x.shape[1])
    order = np.argsort(middle @ axis, kind="stable")
    centres = x[order[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]].copy()
    for _ in range(rounds):
        of = nearest(x, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.stack([np.bincount(of, weights=c, minlength=len(centres)) for c in x.T], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class Codec:
    """Centres of the cells and a codebook for each part of the residuals."""

    centres: np.ndarray
    books: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, n_cells: int, part_dims: int = PART_DIMS, rounds: int = 6) -> Codec:
        x = unit(sample)
        centres = means(x, n_cells, rounds)
        rest = x - centres[nearest(x, centres)]
        cuts = [rest[:, i:i + part_dims] for i in range(0, x.shape[1], part_dims)]
        return cls(centres, [means(c, ENTRIES, rounds) for c in cuts])

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, codes, length of what the code misses, distance from the centre) of each row."""
        x = unit(vectors)
        cell = nearest(x, self.centres)
        rest = x - self.centres[cell]
        d = self.books[0].shape[1]
        codes = np.stack([nearest(rest[:, i * d:(i + 1) * d], b) for i, b in enumerate(self.books)], axis=1)
        miss = np.linalg.norm(rest - self._rest(codes), axis=1)
        return cell, codes.astype(np.uint8), miss, np.linalg.norm(rest, axis=1)

    def _rest(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for, looked up in the codebooks."""
        return self.centres[cell] + self._rest(codes)


@dataclass
class VectorIndex:
    """``codes`` (doc_id, cell, code, miss, same, *parts), ``docs`` with the vectors, the codec and the cells' radii."""

    codes: DataFrame
    docs: DataFrame
    codec: Codec | None
    radii: np.ndarray
    parts: list[str]

    def near_cells(self, vector: Column, floor: Column | None = None) -> Column:
        """Cells to scan: the nearest ``FIRST_CELLS``, or all whose documents may reach ``floor``."""
        centres, radii, nearest_only = self.codec.centres, self.radii, floor is None

        def cells(v: pd.Series, least: pd.Series) -> pd.Series:
            near = unit(stacked(v)) @ centres.T
            if nearest_only:
                return pd.Series(list(np.argsort(-near, axis=1, kind="stable")[:, :FIRST_CELLS].astype(np.int32)))
            reach = near + radii >= least.fillna(-2.0).to_numpy()[:, None] - SLACK
            return pd.Series([np.flatnonzero(r).astype(np.int32) for r in reach])

        least = F.lit(None).cast("double") if floor is None else floor
        return F.pandas_udf(cells, "array<int>")(vector, least)

    def scan(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, doc_id, low, high) of the documents of the queries' ``cells`` that may be among the first k.

        ``queries``: (query_id, qvec, cells, floor, *parts); ``floor`` is a
        score that k documents are known to reach, or null.
        """
        codec = self.codec

        def bound(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
            if q.empty or d.empty:
                # as objects: an empty column of floats isn't taken for texts
                return pd.DataFrame({"query_id": [], "doc_id": [], "low": [], "high": []}, dtype=object)
            codes = np.frombuffer(b"".join(d["code"]), np.uint8).reshape(len(d), -1)
            x, miss, ids = codec.decode(d["cell"].to_numpy(), codes), d["miss"].to_numpy() + 1e-9, d["doc_id"].to_numpy()
            first = _first_of_equal(d["same"].to_numpy(), ids, k)
            asked, out = unit(stacked(q["qvec"])), []
            near_all = asked @ x.T
            for query, own, near, floor in zip(q["query_id"], asked, near_all, q["floor"].to_numpy(float)):
                width = miss if own.any() else 0.0
                low, high = near - width, near + width
                least = -np.inf if np.isnan(floor) else floor
                if len(low) >= k:
                    least = max(least, np.partition(low, len(low) - k)[len(low) - k])
                some = np.flatnonzero((high >= least - SLACK) & first)
                out.append(pd.DataFrame({"query_id": query, "doc_id": ids[some], "low": low[some], "high": high[some]}))
            return pd.concat(out)

        each = queries.withColumn("cell", F.explode("cells"))
        left, right = meet_in_blocks(each, self.codes, [*self.parts, "cell"], ["query_id", "qvec", "floor"],
                                     ["doc_id", "cell", "code", "miss", "same"], QUERY_BLOCK, DOC_BLOCK)
        kinds = dict(queries.dtypes)["query_id"], dict(self.codes.dtypes)["doc_id"]
        return left.cogroup(right).applyInPandas(
            bound, f"query_id {kinds[0]}, doc_id {kinds[1]}, low double, high double")

    def candidates(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, doc_id) of all documents that may be among the first k of a query, by their bounds."""
        q = queries.where(F.col("qvec").isNotNull()).withColumn("floor", F.lit(None).cast("double"))
        if len(self.codec.centres) > FIRST_CELLS:
            first = self.scan(q.withColumn("cells", self.near_cells(F.col("qvec"))), k)
            floors = _kth(first, k).select("query_id", "floor").distinct()
            q = q.drop("floor").join(floors, "query_id", "left")
            q = q.withColumn("cells", self.near_cells(F.col("qvec"), F.col("floor")))
        else:
            q = q.withColumn("cells", F.sequence(F.lit(0), F.lit(len(self.codec.centres) - 1)))
        return _kth(self.scan(q, k), k).where(F.col("floor").isNull() | (F.col("high") >= F.col("floor") - SLACK)) \
            .select("query_id", "doc_id")

    def search(self, queries: DataFrame, k: int, digits: int = 6) -> DataFrame:
        """(query_id, doc_id, cosine, score, rank): the k best documents by cosine, ties to the lesser id.

        ``queries``: (query_id, qvec, *parts); a query without a vector has no
        hit, and with parts only documents of its own are searched.  A query
        may have a row for each of several parts: its hits are the best of all.
        """
        if self.codec is None:
            kinds = dict(queries.dtypes)["query_id"], dict(self.docs.dtypes)["doc_id"]
            return self.docs.sparkSession.createDataFrame(
                [], f"query_id {kinds[0]}, doc_id {kinds[1]}, cosine double, score double, rank int")
        n = -(-queries.count() // ROUND_QUERIES)
        if n > 1:
            return in_rounds(queries, n, lambda some: self._search(some, k, digits))
        return self._search(queries, k, digits)

    def _search(self, queries: DataFrame, k: int, digits: int) -> DataFrame:
        near = self.candidates(queries, k)
        full = near.join(self.docs.select("doc_id", "dvec"), "doc_id") \
            .join(queries.select("query_id", "qvec").dropDuplicates(["query_id"]), "query_id") \
            .select("query_id", "doc_id", cosine(F.col("qvec"), F.col("dvec")).alias("cosine"))
        return rank_top(full.withColumn("score", F.round("cosine", digits)), k)


def _first_of_equal(same: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the ``k`` least ids of their vector: of equal vectors no more can be among the first k."""
    order = np.lexsort((ids, same))
    begins = np.r_[True, same[order][1:] != same[order][:-1]]
    place = np.arange(len(same)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
    out = np.zeros(len(same), bool)
    out[order] = place < k
    return out


def _kth(bounds: DataFrame, k: int) -> DataFrame:
    """``bounds`` with floor: the k-th lower bound of the query, null where there are fewer."""
    w = Window.partitionBy("query_id").orderBy(F.col("low").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return bounds.withColumn("floor", F.nth_value("low", k).over(w))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double; 0 where one has no length."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0),
                           lambda s, t: s + t)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def build_vector_index(docs: DataFrame, folder: str, partition_cols: list[str] | None = None,
                       cell_rows: int = CELL_ROWS, part_dims: int = PART_DIMS) -> VectorIndex:
    """Code every row of ``docs`` (doc_id, dvec, *partition_cols) and write the codes below ``folder``.

    Rows without a vector aren't indexed.  The folder also gets the codec, so
    ``open_vector_index`` can search it later.
    """
    spark, parts = docs.sparkSession, list(partition_cols or [])
    rows = docs.where(F.col("dvec").isNotNull()).select("doc_id", "dvec", *parts)
    n = rows.count()
    if not n:
        return VectorIndex(rows, rows, None, np.zeros(0), parts)
    # bounded: at most SAMPLE_ROWS vectors, drawn at random with some to spare
    share = min(1.0, 1.2 * SAMPLE_ROWS / n)
    sample = (rows if share == 1 else rows.sample(share, seed=7)).select("dvec").limit(SAMPLE_ROWS).collect()
    codec = Codec.fit(np.array([r[0] for r in sample], np.float64), max(1, min(MAX_CELLS, n // cell_rows)), part_dims)

    def code(batches):
        for pdf in batches:
            if len(pdf):
                cell, codes, miss, far = codec.encode(stacked(pdf["dvec"]))
                yield pdf.drop(columns="dvec").assign(cell=cell, code=[c.tobytes() for c in codes], miss=miss, far=far)

    kept = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "dvec") + ", same long"
    rows.withColumn("same", F.xxhash64("dvec")).mapInPandas(code, f"{kept}, cell int, code binary, miss double, far double") \
        .write.parquet(f"{folder}/codes")
    codes = spark.read.parquet(f"{folder}/codes")
    # one row a cell, MAX_CELLS at most
    radii = np.zeros(len(codec.centres))
    for r in codes.groupBy("cell").agg(F.max("far").alias("far")).collect():
        radii[r.cell] = r.far
    tables = [("centre", i, c.tolist()) for i, c in enumerate(codec.centres)]
    tables += [("radii", 0, radii.tolist())]
    tables += [("book", i, b.ravel().tolist()) for i, b in enumerate(codec.books)]
    spark.createDataFrame(tables, "kind string, place int, numbers array<double>").coalesce(1) \
        .write.parquet(f"{folder}/codec")
    return VectorIndex(codes, rows, codec, radii, parts)


def open_vector_index(docs: DataFrame, folder: str, partition_cols: list[str] | None = None) -> VectorIndex:
    """The index that ``build_vector_index`` wrote below ``folder`` for ``docs``."""
    spark = docs.sparkSession
    found = {}
    for r in spark.read.parquet(f"{folder}/codec").orderBy("kind", "place").collect():
        found.setdefault(r.kind, []).append(np.array(r.numbers))
    dims = len(found["centre"][0]) // len(found["book"])
    codec = Codec(np.stack(found["centre"]), [b.reshape(-1, dims) for b in found["book"]])
    return VectorIndex(spark.read.parquet(f"{folder}/codes"), docs.where(F.col("dvec").isNotNull()), codec,
                       found["radii"][0], list(partition_cols or []))


def vector_topk_approx(queries: DataFrame, docs: DataFrame, k: int, partition_cols: list[str] | None = None,
                       digits: int = 6) -> DataFrame:
    """Build an index in the shared folder and search it once."""
    folder = work_dir(docs.sparkSession, "vector-index")
    return build_vector_index(docs, folder, partition_cols).search(queries, k, digits)
