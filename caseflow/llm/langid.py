"""Language identification by rank-order profiles (out-of-place distance).

A profile is the list of the most frequent character n-grams (1 to 3 letters
of blank-padded words) in order of frequency.  Each language has one profile,
counted over all its training documents; a document is given the language
whose profile its own ranking is nearest to, by the sum of the differences of
ranks, a missing n-gram counting as the largest difference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import small_batches

UNDETERMINED = "und"
#: Languages one model may hold; the profiles go to every task, so this bounds them.
MAX_LANGUAGES = 1000
#: Letters of one language that a task counts together.
HELD_LETTERS = 1 << 20
_LETTERS: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    """For each code point below 0x32400 whether it is a letter (none above is)."""
    if "t" not in _LETTERS:
        _LETTERS["t"] = np.fromiter(map(str.isalpha, map(chr, range(0x32400))), bool, 0x32400)
    return _LETTERS["t"]


def letter_codes(text: str | None) -> np.ndarray:
    """Lower-case code points; every run of other characters is one blank (32), one at each end."""
    if not text:
        return np.zeros(0, np.uint64)
    table = _letter_table()
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = code < len(table)
    letter = np.zeros(len(code), bool)
    letter[known] = table[code[known]]
    if not letter.any():
        return np.zeros(0, np.uint64)
    padded = np.full(len(code) + 2, 32, np.uint64)
    padded[1:-1][letter] = code[letter]
    blank = padded == 32
    keep = np.ones(len(padded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return padded[keep]


def gram_keys(code: np.ndarray) -> np.ndarray:
    """All n-grams of 1 to 3 characters, 21 bits a character; none that is or spans a blank."""
    if not len(code):
        return code
    one = code[code != 32]
    two = code[:-1] | code[1:] << np.uint64(21)
    inner = code[1:-1] != 32
    three = (code[:-2] | code[1:-1] << np.uint64(21) | code[2:] << np.uint64(42))[inner]
    return np.concatenate([one, two, three])


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], np.diff(np.r_[at, len(keys)])


def ranked(keys: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by key."""
    grams, n = counted(keys)
    return grams[np.argsort(-n, kind="stable")[:size]]


@dataclass
class Profiles:
    """The learned model: at most ``size`` n-grams of each language, with their ranks."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray  # languages x grams; -1: not in the profile
    size: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1); (``und``, 0) without letters or languages."""
        keys = gram_keys(letter_codes(text))
        if not len(keys) or not self.languages:
            return UNDETERMINED, 0.0
        mine = ranked(keys, self.size)
        at = np.minimum(np.searchsorted(self.grams, mine), len(self.grams) - 1)
        rank = np.where(self.grams[at] == mine, self.ranks[:, at], -1)
        away = np.abs(rank - np.arange(len(mine)))
        away = np.where(rank < 0, self.size, np.minimum(away, self.size)).sum(axis=1)
        best = int(np.argmin(away))
        return self.languages[best], float(1 - away[best] / (self.size * len(mine)))


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = 400) -> Profiles:
    """Count n-grams of all rows of ``docs`` by language and keep the top ``size`` of each.

    Rows with a null text or language teach nothing; an empty table gives a
    model without languages.  Counts are made per batch, then summed by
    (language, n-gram) in Spark; only the profiles reach the driver.
    """
    small_batches(docs.sparkSession)

    def count(batches):
        by_lang: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}

        def sums(g: str) -> pa.RecordBatch:
            held.pop(g)
            keys, n = counted(gram_keys(np.concatenate(by_lang.pop(g))))
            return pa.RecordBatch.from_arrays(
                [pa.array([g] * len(keys), pa.string()), pa.array(keys.astype(np.int64)),
                 pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

        for b in batches:
            for t, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(g, []).append(letter_codes(t))
                held[g] = held.get(g, 0) + len(by_lang[g][-1])
                if held[g] > HELD_LETTERS:
                    yield sums(g)
            for g in list(by_lang):
                yield sums(g)

    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")) \
        .where("text is not null and lang is not null")
    sums = known.mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_n = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = sums.withColumn("rank", F.row_number().over(by_n) - 1).where(F.col("rank") < size) \
        .select("lang", "gram", "rank").limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang}")
    languages = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.gram for r in rows}), np.uint64)
    ranks = np.full((len(languages), len(grams)), -1, np.int64)
    at = {g: i for i, g in enumerate(languages)}
    for r in rows:
        ranks[at[r.lang], np.searchsorted(grams, np.uint64(r.gram))] = r.rank
    return Profiles(languages, grams, ranks, size)


def identify(docs: DataFrame, model: Profiles, text: str = "text",
             out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score in two more columns.

    A null or letterless text gets ``und`` and 0; between equally near
    languages the first by name wins.  Columns of ``docs`` that have the names
    of the two results are replaced.  Repeated rows are judged alike.
    """
    small_batches(docs.sparkSession)
    rest = docs.select(*[c for c in docs.columns if c not in (out, score) or c == text])
    at = rest.columns.index(text)
    schema = T.StructType([f for f in rest.schema if f.name not in (out, score)]
                          + [T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())])
    keep = [i for i, c in enumerate(rest.columns) if c not in (out, score)]

    def judge(batches):
        for b in batches:
            found = [model.nearest(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep]
                + [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                names=schema.names)

    return rest.mapInArrow(judge, schema)
