"""N-gram Jaccard join by MinHash banding.

Texts are sets of word n-grams.  Documents with equal sets form one class
member; members share MinHash values cut into bands, and members meet where a
band's hash is equal.  Buckets with the same members as an earlier bucket are
left out.  Within a bucket, blocks of bounded size are compared on the full
n-gram sets by a sparse product, and each pair is counted in the first bucket
it shares; a task gives numbers of links and a spanning forest, not pairs.
Classes are the connected components of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import mix64, sliced, small_batches, words, write_once

N = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Members, and n-grams of members, that one block of a bucket holds, about.
BLOCK_MEMBERS = 256
BLOCK_GRAMS = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest chance meetings, that reach ``recall`` at ``threshold``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows)) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"{max_hashes} hashes don't reach recall {recall} at {threshold}")
    return best


def gram_set(text: bytes | None, n: int = N) -> np.ndarray:
    """Ascending 64-bit hashes of the word n-grams; a text of fewer words is one n-gram, of none has none."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(n, len(h))
    s = h[:len(h) - k + 1].copy()
    for i in range(1, k):
        s = s * _P + h[i:i + len(s)]
    s = np.sort(mix64(s))
    return s[np.r_[True, s[1:] != s[:-1]]]


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of a non-empty set."""
    factors = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * _P) | np.uint64(1)
    least = np.array([(grams * a).min() for a in factors]).reshape(bands, rows)
    h = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        h = mix64(h * _P + least[:, i])
    return h


def _sketch(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, th, member, n_grams, bands) of each row (doc_id, text, th); member is the 128-bit digest of the n-gram set, null if empty."""
    def sketch(batches: Iterator[pa.RecordBatch]):
        for b in sliced(batches):
            member, size, hashes = [], [], []
            for t in b.column(1).to_pylist():
                g = gram_set(t, n)
                member.append(xxhash.xxh3_128_digest(g.tobytes()) if len(g) else None)
                size.append(len(g))
                hashes.append(band_hashes(g, bands, rows).astype(np.int64) if len(g) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(member, pa.binary()), pa.array(size, pa.int32()),
                 pa.array(hashes, pa.list_(pa.int64()))], names=["doc_id", "th", "member", "n_grams", "bands"])

    return docs.mapInArrow(sketch, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, th long, member binary, "
                                   "n_grams int, bands array<bigint>")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs that keep the components of the graph (a, b) on n nodes, at most n - 1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = find(x), find(y)
        if i != j:
            root[max(i, j)] = min(i, j)
            kept.append((x, y))
    return kept


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common n-grams, left x right, a bounded number of columns at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    la, ra = np.concatenate(left), np.concatenate(right)
    lr = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rr = np.repeat(np.arange(len(right)), [len(x) for x in right])
    common = np.intersect1d(la, ra)
    if not len(common):
        return out
    step = max(1, (1 << 22) // (len(left) + len(right)))
    lc = np.searchsorted(common, la)
    rc = np.searchsorted(common, ra)
    lk = common[np.minimum(lc, len(common) - 1)] == la
    rk = common[np.minimum(rc, len(common) - 1)] == ra
    lc, lr, rc, rr = lc[lk], lr[lk], rc[rk], rr[rk]
    for at in range(0, len(common), step):
        width = min(step, len(common) - at)
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        for m, r, c in ((x, lr, lc), (y, rr, rc)):
            here = (c >= at) & (c < at + width)
            m[r[here], c[here] - at] = 1
        out += x @ y.T
    return out


def _compare(rows: list[dict], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of the task's rows that are linked and first meet in this bucket."""
    left = [i for i, r in enumerate(rows) if r["side"] != 1]
    right = [i for i, r in enumerate(rows) if r["side"] != 0]
    if not left or not right:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sets = {i: np.frombuffer(r["grams"], np.uint64) for i, r in enumerate(rows)}
    both = _shared([sets[i] for i in left], [sets[i] for i in right])
    size = np.array([len(sets[i]) for i in range(len(rows))])
    a, b = np.nonzero(both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-3)
    # exact, in whole numbers: shared / (x + y - shared) >= threshold to six places
    num, den = round(threshold * 10 ** 6), 10 ** 6
    shared = both[a, b].astype(np.int64)
    li, ri = np.array(left)[a], np.array(right)[b]
    ok = (shared * den >= num * (size[li] + size[ri] - shared)) & ((li < ri) if rows[0]["side"] == 2 else (li != ri))
    li, ri = li[ok], ri[ok]
    if len(li):
        # the first bucket that both are in is the one that counts them
        kept = np.array([np.frombuffer(r["kept"], np.int64) for r in rows])
        band = rows[0]["band"]
        met = (kept[li, :band] == kept[ri, :band]) & (kept[li, :band] != 0)
        first = ~met.any(axis=1)
        li, ri = li[first], ri[first]
    return li, ri


def _verify(tasks: DataFrame, threshold: float) -> DataFrame:
    """(member, other, links, copies): links of a member in one task, or one edge of the task's forest."""
    def verify(batches: Iterator[pa.RecordBatch]):
        held: list[dict] = []
        for b in sliced(batches):
            for r in b.to_pylist():
                if held and r["task"] != held[0]["task"]:
                    if (out := result(held)) is not None:
                        yield out
                    held = []
                if not held or held[-1]["member"] != r["member"] or held[-1]["side"] != r["side"]:
                    held.append(r)
        if held and (out := result(held)) is not None:
            yield out

    def result(rows: list[dict]):
        a, b = _compare(rows, threshold)
        if not len(a):
            return None
        copies = np.array([r["copies"] for r in rows])
        links = np.bincount(np.r_[a, b], minlength=len(rows))
        docs = np.bincount(np.r_[a, b], weights=copies[np.r_[b, a]], minlength=len(rows)).astype(np.int64)
        some = np.flatnonzero(links)
        edges = _forest(a, b, len(rows))
        m = [r["member"] for r in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([m[i] for i in some] + [m[i] for i, _ in edges], pa.binary()),
             pa.array([None] * len(some) + [m[j] for _, j in edges], pa.binary()),
             pa.array([int(x) for x in links[some]] + [0] * len(edges), pa.int64()),
             pa.array([int(x) for x in docs[some]] + [0] * len(edges), pa.int64())],
            names=["member", "other", "texts", "docs"])

    return tasks.repartition("task").sortWithinPartitions("task", "side", "member").mapInArrow(
        verify, "member binary, other binary, texts long, docs long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); root is the least node of its component.

    Large-star and small-star rounds: each node's neighbours are hung on its
    least neighbour, until nothing changes.  Every round is written to the
    shared folder and read back; a node's neighbours are never gathered.
    """
    both = edges.select("a", "b").where("a != b")
    both = write_once(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "stars")
    count = -1
    while True:
        # large star: neighbours greater than the node hang on its least neighbour (or itself)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        # small star: the smaller neighbours, and the node, hang on the least of them
        large = write_once(large.where("u != v").distinct(), "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v") \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = write_once(small, "stars")
        sums = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.crc32(F.concat("u", "v"))).alias("s")).first()
        if (sums.n, sums.s) == count:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        count = (sums.n, sums.s)
        both = small.select(F.col("u").alias("a"), F.col("v").alias("b")) \
            .unionByName(small.select(F.col("v").alias("a"), F.col("u").alias("b")))


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N,
                           threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_copies, n_links) of each row of ``docs``.

    class_id is the least doc_id of all documents joined by chains of links;
    n_copies counts the rows with the same n-gram set, itself included;
    n_links counts the other documents that are linked: all copies, and all
    documents whose set has a Jaccard likeness of ``threshold`` or more.  A
    null, empty or blank text has no n-grams and is a class of its own, with
    one copy and no link.  A row with a null id takes part; its class has the
    least id that isn't null.  Rows that repeat an id and a text count as copies.  An empty table gives no rows.  n-grams are compared by 64-bit
    hashes, sets by 128-bit digests.
    """
    return _classes(docs, doc_id, text, n, threshold, recall).select("doc_id", "class_id", "n_copies", "n_links")


def _classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
             recall: float = RECALL) -> DataFrame:
    """``near_duplicate_classes`` with th, the hash of a row's text, and root, its class; null where it has no n-grams."""
    small_batches(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"),
                        F.xxhash64(F.col(text)).alias("th"))
    sketch = write_once(_sketch(texts, n, bands, rows), "near-sketch")
    members = sketch.where("member is not null").groupBy("member").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.first("n_grams").alias("n_grams"),
        F.first("bands").alias("bands"))
    members = write_once(members, "near-members")

    spots = members.select("member", "n_grams", F.posexplode("bands").alias("band", "h"))
    # a bucket's members as a sum of their digests: equal buckets of two bands need one comparison
    buckets = spots.groupBy("band", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("n_grams").cast("long")).alias("grams"),
        F.sum(F.xxhash64("member").cast("decimal(38,0)")).alias("sum1"),
        F.bit_xor(F.xxhash64(F.lit(1), "member")).alias("sum2")).where("n > 1")
    kept = buckets.groupBy("n", "grams", "sum1", "sum2").agg(F.min(F.struct("band", "h")).alias("b")) \
        .select("b.band", "b.h", F.greatest(
            F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    # one row per member in a kept bucket, with its list of buckets (one per band at most)
    mine = spots.join(kept, ["band", "h"]).groupBy("member").agg(
        F.collect_list(F.struct("band", "h", "blocks")).alias("buckets"))
    work = members.join(mine, "member").select("rep", "member", "copies", "buckets")

    def cut(batches: Iterator[pa.RecordBatch]):
        for b in sliced(batches):
            out = {c: [] for c in ("member", "grams", "kept", "copies", "bucket", "blocks", "band")}
            for r in b.to_pylist():
                g = gram_set(r["text"], n)
                if not len(g) or xxhash.xxh3_128_digest(g.tobytes()) != r["member"]:
                    continue  # another row with the id of the one that stands for the member
                own = np.zeros(bands, np.int64)
                for x in r["buckets"]:
                    own[x["band"]] = x["h"]
                for x in r["buckets"]:
                    for c, v in zip(out, (r["member"], g.tobytes(), own.tobytes(), r["copies"], x["h"], x["blocks"],
                                          x["band"])):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), (
                    pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=list(out))

    found = texts.withColumnRenamed("doc_id", "id_").join(work, F.col("id_").eqNullSafe(F.col("rep"))) \
        .select("text", "member", "copies", "buckets") \
        .mapInArrow(cut, "member binary, grams binary, kept binary, copies long, bucket long, blocks int, band int")
    # a bucket of several blocks is compared block by block: block i of a member meets every block j >= i
    block = F.pmod(F.xxhash64(F.lit(2), "member"), F.col("blocks")).cast("int")
    tasks = found.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("member", "grams", "kept", "copies", "band",
                F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
                .alias("side"),
                F.concat_ws(":", "band", "bucket", F.least("block", "other"), F.greatest("block", "other"))
                .alias("task"))
    links = write_once(_verify(tasks, threshold), "near-links")
    counts = links.where("texts > 0").groupBy("member").agg(F.sum("docs").alias("docs"))
    roots = components(links.where("other is not null").select(F.col("member").alias("a"), F.col("other").alias("b")))
    named = members.select("member", "rep", "copies").join(
        roots.select(F.col("node").alias("member"), "root"), "member", "left").join(counts, "member", "left")
    named = named.withColumn("root", F.coalesce("root", "member"))
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = write_once(named.join(least, "root").select(
        "member", "root", "class_id", "copies", F.coalesce("docs", F.lit(0)).alias("docs")), "near-classes")
    # a member with very many copies is one row of ``named``; Spark may split the copies' side
    out = sketch.select("doc_id", "th", "member").join(named, "member", "left")
    own = F.col("member").isNull()
    return out.select(
        "doc_id", "th", "root", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(F.col("copies") - 1 + F.col("docs"), F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that of least id, and of least text hash where texts share the id.

    Another text with the id of a row that goes stays.  Of rows that repeat id
    and text one stays (that of least hash over its columns); such repeats are
    summed up where they are read.  A null id is above all.  Rows without
    n-grams are classes of their own and all stay.
    """
    rows = write_once(_classes(docs, doc_id, text, **options).where("root is not null")
                      .select("doc_id", "th", "root", "class_id"), "near-rows")
    first = rows.where("doc_id <=> class_id")
    ties = first.groupBy("root").agg(F.min("th").alias("low"), F.max("th").alias("high")).where("low < high")
    # documents that go, and documents that stay but have several rows
    gone = rows.where("not doc_id <=> class_id").select("doc_id", "th") \
        .unionByName(first.join(ties, "root").where("th > low").select("doc_id", "th"))
    many = first.join(ties, "root", "left").where("low is null or th = low") \
        .groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "th")
    named = [F.col("doc_id").alias("other_id"), F.col("th").alias("other_th")]
    gone, many = write_once(gone.distinct().select(*named), "near-gone"), write_once(many.select(*named), "near-many")
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"),
                        F.xxhash64(F.col(text)).alias("th"))
    same = F.col("id").eqNullSafe(F.col("other_id")) & (F.col("th") == F.col("other_th"))
    out = keyed.join(gone.unionByName(many), same, "left_anti").select("row")
    if not many.isEmpty():
        plain = [F.col("row")[f.name] for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        out = out.unionByName(keyed.join(many, same, "left_semi").groupBy("id", "th").agg(
            F.min_by("row", F.xxhash64(*plain)).alias("row")).select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


#: DuckDB's words for the classes, every pair with a common n-gram compared.
ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
       lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= {N} THEN array_to_string(w[p:p + {N - 1}], ' ')
        ELSE array_to_string(w, ' ') END AS gram
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - {N - 2}))) AS p FROM
            (SELECT doc_id, w FROM w WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b, k, x.n AS na, y.n AS nb FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 10 * k >= 8 * (x.n + y.n - k)),
c(node, least) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.b, c.least FROM c JOIN l ON l.a = c.node
      WHERE c.least < l.b),
m AS (SELECT node, min(least) AS class_id FROM c GROUP BY node),
s AS (SELECT a, count(*) AS n_links, count(*) FILTER (WHERE k = na AND k = nb) AS same FROM l GROUP BY a)
SELECT m.node AS doc_id, class_id, 1 + coalesce(same, 0) AS n_copies, coalesce(n_links, 0) AS n_links
FROM m LEFT JOIN s ON s.a = m.node
"""
