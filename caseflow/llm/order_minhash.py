"""Document fingerprints by Order MinHash.

The k-mers of a text (runs of ``k`` words) are numbered by occurrence, so a
k-mer that stands three times gives three items.  For each of ``size`` hash
functions the ``ell`` items with the smallest values are selected, put back
into text order, and their tuple is hashed.  Two texts agree in a place of the
fingerprint about as often as they share k-mers in the same order, which makes
the likeness sensitive to edits that move text, not only to those that
replace it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caseflow.llm.common import mix64, small_batches, words

K = 3
SIZE = 64
ELL = 2
#: k-mers handled at a time.
CHUNK = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
#: The key that stands for a null id: before every other.
NULL_KEY = -(1 << 63)


def _kmers(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of all texts in a row, and how many each text has."""
    hashed = [np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in map(words, texts)]
    out = []
    for h in hashed:
        n = max(1, len(h) - k + 1) if len(h) else 0
        s = h[:n].copy()
        for i in range(1, min(k, len(h))):
            s = s * _P + h[i:i + n]
        out.append(mix64(s))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.array([len(s) for s in out], np.int64)


def signatures(texts: list[bytes], k: int = K, size: int = SIZE, ell: int = ELL) -> np.ndarray:
    """texts x size array of 16-bit numbers; a text without words has zeros.

    A text of fewer than ``k`` words is one k-mer; where a text has fewer than
    ``ell`` k-mers, all it has are taken.
    """
    kmer, n = _kmers(texts, k)
    out = np.zeros((len(texts), size), np.uint16)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    n = n[some]
    start = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    pos = np.arange(len(kmer), dtype=np.uint64) - np.repeat(start, n).astype(np.uint64)
    # number the occurrences: equal k-mers of a text side by side, in text order
    key = mix64(kmer + doc * _P)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
    occurrence = np.empty(len(kmer), np.uint64)
    occurrence[order] = np.arange(len(kmer)) - np.repeat(first, np.diff(np.r_[first, len(kmer)]))
    item = mix64(kmer + occurrence * np.uint64(0xD6E8FEB86659FD93))
    bits = int(n.max()).bit_length()
    low = np.uint64((1 << bits) - 1)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    factors = mix64(np.arange(1, size + 1, dtype=np.uint64) * _P) | np.uint64(1)
    for j, a in enumerate(factors):
        # the place in the text rides in the low bits, so the minimum names its place
        value = (item * a & ~low) | pos
        places = np.empty((ell, len(n)), np.uint64)
        for e in range(ell):
            least = np.minimum.reduceat(value, start)
            gone = least == top
            places[e] = np.where(gone, top, least & low)
            value[(start + (least & low).astype(np.int64))[~gone]] = top
        places.sort(axis=0)
        h = np.full(len(n), a, np.uint64)
        for e in range(ell):
            there = places[e] != top
            at = start + np.where(there, places[e], np.uint64(0)).astype(np.int64)
            h = np.where(there, mix64(h * _P + item[at]), h)
        out[some, j] = (h >> np.uint64(48)).astype(np.uint16)
    return out


def fingerprints(texts: list[bytes], k: int = K, size: int = SIZE, ell: int = ELL) -> np.ndarray:
    """``signatures``, a bounded number of characters at a time."""
    out, i = [np.zeros((0, size), np.uint16)], 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j]) <= 8 * CHUNK):
            chars += len(texts[j])
            j += 1
        out.append(signatures(texts[i:j], k, size, ell))
        i = j
    return np.concatenate(out)


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row; 1 between two wordless texts, 0 between one and another."""
    same = (a == b).mean(axis=1)
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), same)


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows dealt into buckets by ranges of the id, each bucket with the row that follows its last.

    (doc_id, text, bucket, look): look is 1 for the row that only follows.
    Bounds are quantiles of the ids; each bucket's least id is looked up, and
    the rows that have it also go to the bucket before, the last bucket's
    follower being the first row of all.  Within a partition rows come in
    order of bucket, look, id (null first), hash of the text.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY)).alias("key"))
    bounds = np.unique(np.array(ids.where(F.col("key") != NULL_KEY).approxQuantile(
        "key", [i / n for i in range(1, n)], 0.2 / n) or [], np.float64).astype(np.int64))

    @pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right"), dtype="int32")

    heads = sorted((r.bucket, r.head) for r in ids.groupBy(bucket_of("key").alias("bucket"))
                   .agg(F.min("key").alias("head")).collect())
    head_ids = np.array([h for _, h in heads], np.int64)
    before = np.array([heads[i - 1][0] for i in range(len(heads))], np.int32)

    @pandas_udf("int")
    def also_in(keys: pd.Series) -> pd.Series:
        k = keys.to_numpy()
        at = np.minimum(np.searchsorted(head_ids, k), len(head_ids) - 1)
        return pd.Series(np.where(head_ids[at] == k, before[at], -1), dtype="int32")

    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("key"))
    if not heads:
        return rows.selectExpr("doc_id", "text", "0 bucket", "0 look")
    rows = rows.withColumns({"own": bucket_of("key"), "also": also_in("key")})
    copies = F.filter(F.array(F.struct(F.col("own").alias("bucket"), F.lit(0).alias("look")),
                              F.struct(F.col("also").alias("bucket"), F.lit(1).alias("look"))),
                      lambda c: c["bucket"] >= 0)
    return rows.withColumn("c", F.explode(copies)).select("doc_id", "text", "key", "c.*") \
        .repartition("bucket").sortWithinPartitions("bucket", "look", "key", F.xxhash64("text")) \
        .select("doc_id", "text", "bucket", "look")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                          size: int = SIZE, ell: int = ELL) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and their likeness.

    The edited text has the last quarter of the code points (rounded down)
    replaced by the first as many, or all, of the next document by ascending
    id; after the last comes the first, so a single document follows itself.
    A null text counts as empty; equal ids are ordered by the hash of the
    text; null ids come first.  An empty table gives no rows.  A fingerprint
    is ``size`` groups of four hex digits.
    """
    small_batches(docs.sparkSession)
    rows = with_next(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def work(batches: Iterator[pa.RecordBatch]):
        ids, texts, looks = [], [], []
        sigs = np.zeros((0, size), np.uint16)
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                new = [t or "" for t in part.column(1).to_pylist()]
                sigs = np.concatenate([sigs, fingerprints([t.encode() for t in new], k, size, ell)])
                ids += part.column(0).to_pylist()
                texts += new
                looks += part.column(3).to_pylist()
                # every row but the last has its follower here; rows that only follow give nothing
                own = [j for j in range(len(ids) - 1) if not looks[j]]
                if own:
                    yield result(ids, texts, sigs, own)
                ids, texts, looks, sigs = ids[-1:], texts[-1:], looks[-1:], sigs[-1:]

    def result(ids, texts, sigs, own):
        after = [j + 1 for j in own]
        edited = []
        for j in own:
            q = len(texts[j]) // 4
            edited.append((texts[j][:len(texts[j]) - q] + texts[j + 1][:q]).encode())
        mine, other, changed = sigs[own], sigs[after], fingerprints(edited, k, size, ell)
        blank = np.array([not words(t.encode()) for t in texts])
        blank_edited = np.array([not words(t) for t in edited])
        hexes = [[r.astype(">u2").tobytes().hex() for r in s] for s in (mine, changed)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[j] for j in own], pa.int64() if kind == "bigint" else None),
             pa.array([len(texts[j]) for j in own], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in edited]), *map(pa.array, hexes),
             pa.array(likeness(mine, changed, blank[own], blank_edited)),
             pa.array(likeness(mine, other, blank[own], blank[after]))], names=fields)

    return rows.mapInArrow(work, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
