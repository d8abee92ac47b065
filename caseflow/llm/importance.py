"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Texts are bags of word runs, counted in hashed buckets: a run's bucket is the
CRC-32 of its bytes modulo the number of buckets.  The most frequent words and
pairs, the head, are broadcast with what their CRC costs: a word's CRC state,
from which any run that begins with it goes on, and a pair's bucket.  Runs
outside the head, the tail, take their CRC directly.  Both feed exact totals a
bucket, of the corpus and of the target, whose log ratio is a bucket's gain.  A
document's weight is the mean gain of its runs; weights plus Gumbel noise of
the document's id draw without replacement.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.common import sliced, small_batches, write_once

BUCKETS = 10_000
SEED = 2024
#: Words and pairs that are broadcast; a bound on what workers hold, results don't depend on it.
HEAD_WORDS = 20_000
HEAD_PAIRS = 50_000
#: Distinct runs that a task counts at once while it looks for its most frequent ones.
COUNTED = 400_000
#: Bytes of words, lower case; all others part words.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lowered; none for null."""
    return text.translate(_WORD).split() if text else []


class Words(dict):
    """CRC-32 of words: known for the head, computed for the tail and not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Pairs(dict):
    """Buckets of word pairs: known for the head, from the first word's CRC state for the tail."""

    def __init__(self, known: dict, states: Words, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.states[pair[0]]) % self.buckets


class Vocabulary:
    """Buckets of the runs of 1 to ``max_n`` words of a text."""

    def __init__(self, head_words: list[bytes], head_pairs: list[bytes], max_n: int, buckets: int):
        self.max_n, self.buckets = max_n, buckets
        self.states = Words((w, zlib.crc32(w)) for w in head_words)
        self.pairs = Pairs({tuple(p.split(b" ")): zlib.crc32(p) % buckets for p in head_pairs}, self.states, buckets)

    def of(self, w: list[bytes]) -> np.ndarray:
        """One bucket for each run, repeats included."""
        out = [np.fromiter(map(self.states.__getitem__, w), np.int64, len(w)) % self.buckets]
        if self.max_n > 1 and len(w) > 1:
            out.append(np.fromiter(map(self.pairs.__getitem__, zip(w, w[1:])), np.int64, len(w) - 1))
        if self.max_n > 2 and len(w) > 2:
            spaced = [b" " + x for x in w]
            run = [zlib.crc32(b, self.states[a]) for a, b in zip(w, spaced[1:])]
            for n in range(3, min(self.max_n, len(w)) + 1):
                run = [zlib.crc32(b, a) for a, b in zip(run, spaced[n - 1:])]
                out.append(np.array(run, np.int64) % self.buckets)
        return np.concatenate(out)


def find_head(docs: DataFrame, text: str = "text", pairs: bool = False, n_words: int = HEAD_WORDS,
              n_pairs: int = HEAD_PAIRS) -> tuple[list[bytes], list[bytes]]:
    """The most frequent words and pairs, at most ``n_words`` and ``n_pairs``; ties to the lesser bytes.

    Each task counts its own texts and reports its most frequent runs, whose
    counts are summed.  A task that meets more than ``COUNTED`` distinct runs
    forgets the rarest, so a run near the edge of the head may be left out: it
    then takes its CRC directly, with the same bucket.
    """
    small_batches(docs.sparkSession)
    kinds = [(0, n_words)] + ([(1, n_pairs)] if pairs else [])

    def count(batches: Iterator[pa.RecordBatch]):
        seen = {kind: Counter() for kind, _ in kinds}
        for b in sliced(batches):
            for t in b.column(0).to_pylist():
                w = words(t)
                seen[0].update(w)
                if pairs:
                    seen[1].update(map(b" ".join, zip(w, w[1:])))
            for kind, most in kinds:
                if len(seen[kind]) > COUNTED:
                    seen[kind] = Counter(dict(seen[kind].most_common(max(most, COUNTED // 2))))
        for kind, most in kinds:
            top = seen[kind].most_common(most)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(top), pa.int32()), pa.array([r for r, _ in top], pa.binary()),
                 pa.array([n for _, n in top], pa.int64())], names=["kind", "run", "n"])

    found = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "kind int, run binary, n long") \
        .groupBy("kind", "run").agg(F.sum("n").alias("n"))
    if pairs:
        found = write_once(found, "head")
    head = [[bytes(r.run) for r in found.where(F.col("kind") == kind).orderBy(F.desc("n"), "run").limit(most).collect()]
            for kind, most in kinds]
    return head[0], head[1] if pairs else []


def bucket_totals(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """(bucket, n): exact numbers of runs over all texts; buckets without any are left out."""
    small_batches(docs.sparkSession)

    def total(batches: Iterator[pa.RecordBatch]):
        sums = np.zeros(vocabulary.buckets, np.int64)
        for b in sliced(batches):
            of = [vocabulary.of(w) for t in b.column(0).to_pylist() if (w := words(t))]
            if of:
                sums += np.bincount(np.concatenate(of), minlength=vocabulary.buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    return docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(total, "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of a bucket's shares in target and source, for every bucket."""
    spark = source.sparkSession
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")) \
        .join(source.withColumnRenamed("n", "s"), "bucket", "left") \
        .join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    # a row a bucket: as many as the parameter says, whatever the corpus
    rows = both.orderBy("bucket").collect()
    s, t = (np.array([r[c] for r in rows], np.float64) for c in ("s", "t"))
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, vocabulary: Vocabulary, gain: np.ndarray, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row; weight is the mean gain, rounded down (no run: 0)."""
    small_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]):
        for b in sliced(batches):
            n_words, n_runs, weight = [], [], []
            for t in b.column(1).to_pylist():
                w = words(t)
                of = vocabulary.of(w) if w else ()
                n_words.append(len(w))
                n_runs.append(len(of))
                weight.append(int(gain[of].sum()) // len(of) if w else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_runs, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    key = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        measure, f"doc_id {key}, n_words long, n_features long, weight long")


def with_noise(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighed`` with score: weight plus floor(1000 Gumbel), noise fixed by seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` (a written table) with rank: 1, 2, ... of the drawn rows, null for the others.

    Scores are whole numbers between some -50,000 and 70,000 (a logarithm of
    64-bit counts, plus noise of 32 bits), so a table with a row a score is
    bounded; it places each score's rows, and only rows of one score are
    numbered together.  One score has less than 0.04 % of the rows, even where
    all weights are equal.
    """
    enough = F.col("n_words") >= min_words
    by_score = scored.where(enough).groupBy(F.col("score").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    down = Window.orderBy(F.desc("at"))
    places = by_score.select("at", (F.sum("n").over(down) - F.col("n")).alias("before"),
                             F.sum("n").over(Window.partitionBy()).alias("n_all")) \
        .select("at", "before", F.expr(f"n_all * {int(percent)} div 100").alias("quota")).where("before < quota")
    rows = scored.join(F.broadcast(write_once(places, "score-places")), enough & (F.col("score") == F.col("at")), "left")
    nth = F.row_number().over(Window.partitionBy("at").orderBy(F.asc_nulls_last("doc_id"), "n_features")) \
        + F.col("before")
    drawn = rows.where("at is not null").withColumn("rank", nth.cast("long")) \
        .withColumn("rank", F.when(F.col("rank") <= F.col("quota"), F.col("rank")))
    rest = rows.where("at is null").withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("at", "before", "quota")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             max_n: int = 1, buckets: int = BUCKETS, percent: int = 10, min_words: int = 20,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred
    (rounded down) are drawn by descending score; rank numbers them, ties to
    the lesser id (null ids last, then fewer features), and is null for the
    rest.  A null, empty or wordless text has no feature and weight 0.  A null
    id counts as an empty text where the noise is made.  Rows that repeat an id
    share its noise and are drawn on their own.  Empty ``docs`` give no rows; an
    empty ``target`` leaves the gains to the smoothing.  A text is held whole,
    as its words, by one worker.
    """
    docs_words, docs_pairs = find_head(docs, text, max_n > 1)
    vocabulary = Vocabulary(docs_words, docs_pairs, max_n, buckets)
    gain = gains(bucket_totals(docs, vocabulary, text), bucket_totals(target, vocabulary, target_text), buckets)
    scored = write_once(with_noise(weigh(docs, vocabulary, gain, doc_id, text), seed), "scored")
    return draw(scored, percent, min_words)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: DuckDB's words for it, CRC-32 by the usual table of 256 remainders.
ORACLE = f"""
WITH steps AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(
       [i, 0, 0, 0, 0, 0, 0, 0, 0],
       lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
     FROM (SELECT unnest(range(256)) AS i))),
f AS MATERIALIZED (SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all({_LOWER},
       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents
     UNION ALL SELECT 't', item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))
     FROM benchmark),
v AS MATERIALIZED (SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT],
       list_transform(range(strlen(w)), lambda i: ('0x' || hex(encode(w))[2 * i + 1:2 * i + 2])::BIGINT)),
       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % {BUCKETS} AS bucket
     FROM (SELECT DISTINCT w FROM f), steps),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
      FROM f JOIN v USING (w) GROUP BY 1),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM n),
d AS (SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM f JOIN v USING (w) JOIN g USING (bucket) WHERE side = 'd' GROUP BY 1),
s AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT + 0.5)::DOUBLE
          / 4294967296::DOUBLE)))::BIGINT AS score
      FROM documents LEFT JOIN d ON d.id = doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
        count(*) FILTER (n_features >= 20) OVER () AS enough FROM s)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND k <= 10 * enough // 100 THEN k END AS rank FROM r
"""
