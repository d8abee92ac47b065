"""Product codes of vectors, with Drake and Hamerly's adaptive distance bounds.

Vectors are cut into parts and each part is written as the number of the
nearest entry of its position's codebook, which rounds of assigning and
averaging refine.  Components are whole numbers, so every distance is exact.
Each part keeps, from one round to the next, its b nearest entries in order,
ordered lower bounds for them and an outer bound for all others; when entries
move, bounds sink by the distance moved.  Only entries whose bound doesn't
clear the distance to the nearest one so far are looked at again, in whole
numbers; where the outer bound doesn't clear it either, all are.  b starts at
an eighth of the entries and follows what the parts needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import join_hot, remove_folder, run_folder, sliced, write_once

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: b at first, and at least, as shares of the entries.
FIRST_B, LEAST_B = 1 / 8, 1 / 32
#: Share of the vectors whose parts the next round's b suffices for.
SERVED = 0.95
#: Whole components below this in size keep every distance exact in 53 bits, and a key of distance and entry in 63.
LARGEST = 1 << 21
_SLACK = 1e-6


def usable(vector: str) -> Column:
    """Neither null nor with a component that is null, infinite or not a number."""
    v = F.col(vector)
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def whole(column: pa.Array, dim: int) -> np.ndarray:
    """floor(1024 x) of the components, one row for each vector."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(x * SCALE).astype(np.int64).reshape(len(column), dim)


class Book:
    """The entries of one position's codebook and how far they moved last."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        self.floats = entries.astype(np.float64)
        self.norms = (self.floats ** 2).sum(axis=1)
        self.moved = np.sqrt(((entries - (entries if before is None else before)) ** 2).sum(axis=1)) + _SLACK

    def __len__(self) -> int:
        return len(self.entries)

    def distances(self, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Squared distances of each row to the entries named beside it."""
        return ((x[:, None, :] - self.entries[of]) ** 2).sum(axis=2)

    def all_distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all entries: whole numbers below 2^53, exact in doubles."""
        f = x.astype(np.float64)
        return ((f ** 2).sum(axis=1)[:, None] - 2 * (f @ self.floats.T) + self.norms).astype(np.int64)


class Bounds:
    """Per row: ``near``, entries in order of distance, and ``low``.

    ``low[:, i]`` is below the distance to every entry that isn't one of the
    first i + 1 in ``near``: the ordered bounds, the last one the outer bound.
    """

    def __init__(self, near: np.ndarray, low: np.ndarray):
        self.near, self.low = near, low

    @classmethod
    def fresh(cls, x: np.ndarray, book: Book, b: int) -> Bounds:
        """From the distances to all entries; ties to the lower entry."""
        k, b = len(book), min(b, len(book))
        key = book.all_distances(x) * k + np.arange(k)
        if b < k:
            key = np.partition(key, b, axis=1)[:, :b + 1]
        key.sort(axis=1)
        far = np.sqrt(key[:, 1:] // k)
        if b == k:
            far = np.concatenate([far, np.full((len(x), 1), np.inf)], axis=1)
        return cls(key[:, :b] % k, far)

    def sink(self, book: Book) -> None:
        """After the entries moved: each bound by its entry's way, the outer one by the longest."""
        self.low[:, :-1] -= book.moved[self.near[:, 1:]]
        self.low[:, -1] -= book.moved.max()
        self.low = np.minimum.accumulate(self.low[:, ::-1], axis=1)[:, ::-1]

    def assign(self, x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
        """Put the nearest entry first; (its squared distance, bounds needed: more than b where all entries were)."""
        b, k = self.near.shape[1], len(book)
        own = book.distances(x, self.near[:, :1])[:, 0]
        needed = (self.low <= np.sqrt(own)[:, None] + _SLACK).sum(axis=1)
        done, width = 0, 1
        while done < b - 1:
            width = min(width, b - 1)
            rows = np.flatnonzero((needed > done) & (needed <= width))
            if len(rows):
                near = self.near[rows, :width + 1]
                key = np.sort(book.distances(x[rows], near) * k + near, axis=1)
                self.near[rows, :width + 1] = key % k
                far = np.sqrt(key[:, 1:] // k)
                far = np.minimum.accumulate(np.c_[far, self.low[rows, width]][:, ::-1], axis=1)[:, ::-1]
                self.low[rows, :width] = far[:, :-1]
                own[rows] = key[:, 0] // k
            done, width = width, width * 2
        rows = np.flatnonzero(needed >= b)
        if len(rows):
            anew = Bounds.fresh(x[rows], book, b)
            self.near[rows], self.low[rows] = anew.near, anew.low
            own[rows] = book.distances(x[rows], anew.near[:, :1])[:, 0]
        return own, np.where(needed >= b, b + 1, needed)

    def cut(self, b: int) -> None:
        """Keep the first b; the bound of the last one holds for all others."""
        self.near, self.low = self.near[:, :b], self.low[:, :b]


class _Form:
    """How vectors and bounds are written: ``width`` bytes a component, a bound in 16 bits of ``unit``, rounded down."""

    def __init__(self, dim: int, largest: int, entries: int):
        self.dim, self.part = dim, dim // PARTS
        self.vector = np.dtype("<i2" if largest < 1 << 15 else "<i4")
        self.entry = np.dtype("u1" if entries <= 256 else "<u2")
        self.unit = 65535 / max(1.0, 2 * largest * np.sqrt(self.part))

    def rows(self, a: np.ndarray, dtype: np.dtype) -> pa.Array:
        a = np.ascontiguousarray(a.astype(dtype))
        width = a.shape[1] * a.itemsize
        return pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(width), len(a), [None, pa.py_buffer(a)]).cast(pa.binary())

    def read(self, column: pa.Array, dtype: np.dtype) -> np.ndarray:
        n = len(column)
        return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype)

    def bounds(self, near: pa.Array, low: pa.Array, p: int) -> Bounds:
        n, w = (self.read(c, t) for c, t in ((near, self.entry), (low, np.dtype("<u2"))))
        b = n.shape[1] // PARTS
        return Bounds(n[:, p * b:(p + 1) * b].astype(np.int64), w[:, p * b:(p + 1) * b] / self.unit)

    def written(self, bounds: list[Bounds]) -> list[pa.Array]:
        low = np.concatenate([x.low for x in bounds], axis=1)
        return [self.rows(np.concatenate([x.near for x in bounds], axis=1), self.entry),
                self.rows(np.clip(np.floor((low - _SLACK) * self.unit), 0, 65535), np.dtype("<u2"))]


def _part(x: np.ndarray, p: int) -> np.ndarray:
    d = x.shape[1] // PARTS
    return x[:, p * d:(p + 1) * d]


def _begin(vectors: DataFrame, form: _Form, books: list[Book], b: int) -> DataFrame:
    """The first assignment, with all distances."""
    def begin(batches: Iterator[pa.RecordBatch]):
        for batch in sliced(batches):
            x = whole(batch.column(2), form.dim)
            bounds = [Bounds.fresh(_part(x, p), books[p], b) for p in range(PARTS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), form.rows(x, form.vector),
                 form.rows(np.stack([q.near[:, 0] for q in bounds], axis=1), form.entry), *form.written(bounds),
                 pa.array(np.zeros(len(x), np.int32))], names=_COLUMNS)

    return vectors.mapInArrow(begin, _schema(vectors))


def _again(state: DataFrame, form: _Form, books: list[Book], b: int) -> DataFrame:
    """The next assignment, from the bounds of the last one; ``b`` nearest entries stay."""
    def again(batches: Iterator[pa.RecordBatch]):
        for batch in sliced(batches):
            x = form.read(batch.column(2), form.vector).astype(np.int64)
            bounds, needed = [], []
            for p in range(PARTS):
                q = form.bounds(batch.column(4), batch.column(5), p)
                q.sink(books[p])
                needed.append(q.assign(_part(x, p), books[p])[1])
                q.cut(b)
                bounds.append(q)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 form.rows(np.stack([q.near[:, 0] for q in bounds], axis=1), form.entry), *form.written(bounds),
                 pa.array(np.max(needed, axis=0).astype(np.int32))], names=_COLUMNS)

    return state.mapInArrow(again, state.schema)


def _finish(state: DataFrame, form: _Form, books: list[Book]) -> DataFrame:
    """(vec_id, label, code, error) by the last assignment; two hex digits an entry, four for books above 256."""
    digits = "{:02x}" if form.entry.itemsize == 1 else "{:04x}"

    def finish(batches: Iterator[pa.RecordBatch]):
        for batch in sliced(batches):
            x = form.read(batch.column(2), form.vector).astype(np.int64)
            code, error = [], np.zeros(len(x), np.int64)
            for p in range(PARTS):
                q = form.bounds(batch.column(4), batch.column(5), p)
                q.sink(books[p])
                error += q.assign(_part(x, p), books[p])[0]
                code.append(q.near[:, 0])
            code = ["".join(digits.format(c) for c in row) for row in np.stack(code, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()),
                                              pa.array(error)], names=["vec_id", "label", "code", "error"])

    kept = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.mapInArrow(finish, f"vec_id {kept['vec_id']}, label {kept['label']}, code string, error long")


_COLUMNS = ["vec_id", "label", "vector", "entries", "near", "low", "needed"]


def _schema(vectors: DataFrame) -> str:
    kept = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return (f"vec_id {kept['vec_id']}, label {kept['label']}, vector binary, entries binary, near binary, low binary, "
            "needed int")


def _sums(state: DataFrame, form: _Form, k: int) -> DataFrame:
    """(part, entry, n, s0, s1, ...): sums of the parts at each entry; part -1 counts the bounds needed."""
    d = form.part

    def add(batches: Iterator[pa.RecordBatch]):
        n, total, needed = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, d), np.int64), np.zeros(0, np.int64)
        for batch in sliced(batches):
            x = form.read(batch.column(0), form.vector).astype(np.float64)
            of = form.read(batch.column(1), form.entry).astype(np.int64)
            for p in range(PARTS):
                y = _part(x, p)
                n[p] += np.bincount(of[:, p], minlength=k)
                for i in range(d):
                    total[p, :, i] += np.bincount(of[:, p], weights=y[:, i], minlength=k).astype(np.int64)
            more = np.bincount(batch.column(2).to_numpy())
            more[:len(needed)] += needed[:len(more)]
            needed = np.r_[more, needed[len(more):]]
        p, e = np.nonzero(n)
        some = np.flatnonzero(needed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[p, np.full(len(some), -1)].astype(np.int32)), pa.array(np.r_[e, some].astype(np.int32)),
             pa.array(np.r_[n[p, e], needed[some]]),
             pa.array([*total[p, e].tolist(), *[[0] * d] * len(some)], pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"])

    rows = state.select("vector", "entries", "needed").mapInArrow(add, "part int, entry int, n long, sums array<long>")
    return rows.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(d)))


def _next_b(needed: dict[int, int], b: int, k: int) -> int:
    """The least b that sufficed for a share ``SERVED`` of the vectors that did without all entries."""
    counts = [needed.get(i, 0) for i in range(b + 1)]
    if not sum(counts):
        return b
    enough = int(np.searchsorted(np.cumsum(counts), SERVED * sum(counts))) + 1
    return max(1, min(b, max(enough, int(k * LEAST_B))))


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error), codebooks) of the usable rows.

    Rows whose vector is null or holds a null or non-finite component are left
    out.  The codebooks start as the parts of the ``entries`` rows of least id
    (null ids last; rows of one id by their components); with fewer rows they
    are so much smaller.  An entry without parts stays as it is.  Null labels
    and repeated rows are rows like others.  No usable row gives no rows and no
    codebooks.  Raises ValueError where vectors differ in length, can't be cut
    into parts, or a component is 2,048 or more in size.

    A round reads and writes the table of bounds in the shared folder; the one
    before is removed then.  The codebooks, a bounded number of entries, go
    through the driver.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")) \
        .where(usable("v"))
    most = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))).cast("double")
    form = rows.agg(F.min(F.size("v")).alias("short"), F.max(F.size("v")).alias("long"), F.max(most).alias("most")).first()
    kept = {f.name: f.dataType.simpleString() for f in rows.schema}
    if form.short is None:
        return spark.createDataFrame([], f"vec_id {kept['vec_id']}, label {kept['label']}, code string, error long"), []
    if form.short != form.long or form.long % PARTS or not form.long:
        raise ValueError(f"vectors of {form.short} to {form.long} components can't be cut into {PARTS} equal parts")
    largest = int(SCALE * form.most) + 1
    if largest >= LARGEST:
        raise ValueError(f"a component of size {form.most} is too large for exact distances")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = np.floor(np.array([r.v for r in first], np.float64) * SCALE).astype(np.int64)
    k = len(start)
    form = _Form(form.long, largest, k)
    books = [Book(_part(start, p)) for p in range(PARTS)]

    b = max(1, min(k, int(k * FIRST_B)))
    state, folder = _begin(rows, form, books, b), None
    for turn in range(rounds):
        old, folder = folder, run_folder(spark, "vector-bounds")
        schema = state.schema
        state.write.parquet(f"{folder}/table")
        if old is not None:
            remove_folder(old)
        state = spark.read.schema(schema).parquet(f"{folder}/table")
        # at most parts x entries + b rows, whatever the table
        sums = _sums(state, form, k).collect()
        books, needed = _moved(books, sums, form.part), {r.entry: r.n for r in sums if r.part < 0}
        if turn < rounds - 1:
            b = _next_b(needed, b, k) if turn else b
            state = _again(state, form, books, b)
    if folder is None:  # no round: assign once
        folder = run_folder(spark, "vector-bounds")
        schema = state.schema
        state.write.parquet(f"{folder}/table")
        state = spark.read.schema(schema).parquet(f"{folder}/table")
    done = write_once(_finish(state, form, books), "vector-codes")
    remove_folder(folder)
    return done, [x.entries for x in books]


def _moved(books: list[Book], sums: list, d: int) -> list[Book]:
    """Each entry at the mean of its parts, rounded down by component."""
    new = [x.entries.copy() for x in books]
    for r in sums:
        if r.part >= 0:
            new[r.part][r.entry] = [r[f"s{i}"] // r.n for i in range(d)]
    return [Book(n, x.entries) for n, x in zip(new, books)]


def code_report(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each usable row; see ``compress``.

    label_error sums the errors of the rows with the same label, nulls together.
    """
    codes, books = compress(vectors, vec_id, vector, label)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
    by_label = write_once(codes.groupBy("label").agg(
        F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n_label")), "label-errors")
    return join_hot(codes, by_label, "label", "n_label", codes.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB's words for it, every part compared with every entry."""
    ctes = [f"""q AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding,
       lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""x AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
     FROM q, (SELECT unnest(range({parts})) AS p))""",
            f"""c0 AS MATERIALIZED (SELECT p, e, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
     FROM q ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, p, min(d * {entries} + e) AS k FROM (
       SELECT vec_id, x.p, e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
         AS d FROM x JOIN c{i} c ON c.p = x.p) GROUP BY 1, 2)""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
       SELECT p, e, list(s ORDER BY i) AS v FROM (
         SELECT p, k % {entries} AS e, i, floor(sum(y)::DOUBLE / count(*))::BIGINT AS s FROM (
           SELECT x.p, k, unnest(x.v) AS y, generate_subscripts(x.v, 1) AS i FROM x JOIN a{i} USING (vec_id, p))
         GROUP BY 1, 2, 3) GROUP BY 1, 2) m USING (p, e))""")
    return "WITH " + ",\n".join(ctes) + f""",
r AS (SELECT vec_id, string_agg(printf('%02x', k % {entries}), '' ORDER BY p) AS code,
        sum(k // {entries})::BIGINT AS error FROM a{rounds} GROUP BY 1),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM r JOIN q USING (vec_id), s
"""
