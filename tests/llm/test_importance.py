import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caseflow.llm import importance as im
from tests.llm.conftest import EDGE, frame


def runs(text, max_n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    """Rows of (id, words, runs, weight, score, rank) from (id, text) rows."""
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets
    s = Counter(bucket(r) for _, t in rows for r in runs(t, max_n)[1])
    t = Counter(bucket(r) for x in target for r in runs(x, max_n)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in s}
    out = []
    for key, text in rows:
        w, f = runs(text, max_n)
        weight = sum(gain[bucket(r)] for r in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(w), len(f), weight, weight + noise, None])
    enough = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for i, r in enumerate(enough[:percent * len(enough) // 100]):
        r[5] = i + 1
    return Counter(map(tuple, out))


def got(df, target, **options):
    return Counter(tuple(r) for r in im.resample(df, target, **options).collect())


TARGET = ["The cat sat.", None, "", "un deux trois MÉTÉO", "word1 word2 WORD3 word3"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in enumerate(TARGET)],
                                 "item_id long, text string, bucket string, n string")


@pytest.mark.parametrize("max_n,percent,min_words", [(1, 10, 20), (1, 100, 0), (2, 40, 3), (3, 70, 1)])
def test_edge_rows(edge, target, max_n, percent, min_words):
    expected = brute([(r[0], r[1]) for r in EDGE], TARGET, max_n, 10_000, percent, min_words)
    assert got(edge, target, max_n=max_n, percent=percent, min_words=min_words) == expected


def test_corpus_with_pairs(docs, target):
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], TARGET, 2, 500)
    assert got(docs, target, max_n=2, buckets=500) == expected


def test_empty_tables(nothing, edge, target):
    assert im.resample(nothing, target).collect() == []
    nobody = target.where("item_id < 0")
    assert got(edge, nobody) == brute([(r[0], r[1]) for r in EDGE], [])


def test_head_and_tail_give_the_same_buckets():
    w = im.words("Ärger um die kleine Straße, um die Ecke; A1 b2 — um die".encode())
    none, some = im.Vocabulary([], [], 4, 997), im.Vocabulary([b"um", b"die", b"a1"], [b"um die", b"a1 b2"], 4, 997)
    expected = [zlib.crc32(b" ".join(w[i:i + n])) % 997 for n in range(1, 5) for i in range(len(w) - n + 1)]
    assert none.of(w).tolist() == some.of(w).tolist() == expected
    assert len(some.states) == 3 and len(some.pairs) == 2  # the tail isn't kept


def test_head_is_the_most_frequent(spark, monkeypatch):
    rows = [(i, "the of " * 5 + f"rare{i} of", None, None) for i in range(40)]
    df = frame(spark, rows).repartition(4)
    words, pairs = im.find_head(df, pairs=True, n_words=2, n_pairs=1)
    assert words == [b"of", b"the"] and pairs == [b"the of"]
    monkeypatch.setattr(im, "COUNTED", 10)
    assert im.find_head(df, n_words=2)[0] == [b"of", b"the"]


def test_equal_scores_are_numbered_by_id(spark):
    scored = spark.createDataFrame([(i % 7, 30, 30, 0, 5 if i < 60 else i) for i in range(100)],
                                   "doc_id long, n_words long, n_features long, weight long, score long")
    rows = im.draw(scored, 50, 20).collect()
    assert sorted(r.rank for r in rows if r.rank) == list(range(1, 51))
    expected = sorted(rows, key=lambda r: (-r.score, r.doc_id))[:50]
    drawn = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in expected]


def test_drawn_texts_are_nearer_to_the_target(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.integers(50)}" for _ in range(60)), "en", "s") for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"a{j}" for j in range(50)) + " a1 a2 a3" * 9,)] * 20, "text string")
    drawn = [r.doc_id for r in im.resample(frame(spark, rows, []), target).where("rank is not null").collect()]
    assert len(drawn) == 40 and sum(i % 2 == 0 for i in drawn) >= 30
