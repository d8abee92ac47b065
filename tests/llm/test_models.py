import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caseflow.llm import bit_mixing as bm
from caseflow.llm import langid, order_minhash as om
from caseflow.llm.common import crc_mod
from tests.llm.conftest import EDGE, LONG, frame

TRAIN7 = crc_mod  # a column is made where a session is there


def held(i, n, r):
    return zlib.crc32(str(i).encode()) % n == r


# language ID

def test_language_on_held_out_documents(docs):
    out = langid.identify(docs, langid.learn_profiles(docs.where(crc_mod("doc_id", 5) != 0)))
    rows = [r for r in out.collect() if held(r.doc_id, 5, 0)]
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(edge, nothing):
    model = langid.learn_profiles(edge)
    assert model.languages == ["en", "fr"]
    out = langid.identify(edge, model)
    assert out.columns == [c for c in edge.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
    none = langid.learn_profiles(nothing)
    assert {(r.lang_pred, r.score) for r in langid.identify(edge, none).collect()} == {("und", 0.0)}
    assert langid.identify(nothing, model).count() == 0


def test_out_of_place_distance_against_plain_python():
    def grams(t):
        c = Counter()
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            p = f" {w} "
            c.update(x for n in (1, 2, 3) for x in (p[i:i + n] for i in range(len(p) - n + 1)) if x != " ")
        return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], sum(ord(ch) << 21 * i for i, ch in enumerate(x[0]))))]

    texts = {"aa": "the quick brown fox and the lazy dog", "bb": "le renard brun et le chien paresseux"}
    profiles = {k: grams(t)[:40] for k, t in texts.items()}
    all_grams = sorted({sum(ord(ch) << 21 * i for i, ch in enumerate(g)) for p in profiles.values() for g in p})
    ranks = np.full((2, len(all_grams)), -1)
    for r, p in enumerate(profiles.values()):
        for i, g in enumerate(p):
            ranks[r, all_grams.index(sum(ord(ch) << 21 * j for j, ch in enumerate(g)))] = i
    model = langid.Profiles(list(profiles), np.array(all_grams, np.uint64), ranks, 40)
    for t in ("the dog", "le chien est brun", "fox fox et", "zzz"):
        mine = grams(t)[:40]
        away = {k: sum(abs(p.index(g) - i) if g in p else 40 for i, g in enumerate(mine)) for k, p in profiles.items()}
        best = min(away, key=lambda k: (away[k], k))
        assert model.nearest(t) == (best, pytest.approx(1 - away[best] / (40 * len(mine))))


# bit mixing

def base_scores(rows):
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None])
              for i, t in rows]
    train = [i is not None and not held(i, 7, 2) for i, _ in rows]
    c = Counter(w for (_, ws), x in zip(tokens, train) if x for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, not x, len(ws), sum(c[w] > 0 for w in ws), n,
             round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for (i, ws), x in zip(tokens, train)]


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_base_score_against_plain_python(request, which):
    df = request.getfixturevalue(which)
    out = bm.score_documents(df, crc_mod("doc_id", 7) != 2).collect()
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == Counter(base_scores([(r.doc_id, r.text) for r in df.collect()]))
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in out)
    if which == "docs":
        rows = [r for r in out if r.held_out]
        size = {r.doc_id: len(r.text.encode()) + 1 for r in df.collect()}
        bits = -sum(r.score for r in rows) / math.log10(2) / sum(size[r.doc_id] for r in rows)
        assert bits < 3.0  # a held-out byte; without a model it takes 8, by byte frequencies about 4


def test_no_documents_and_no_training(nothing, spark):
    assert bm.score_documents(nothing, crc_mod("doc_id", 7) != 2).count() == 0
    df = frame(spark, [(1, "some words", "en", "a"), (2, None, "en", "a")], [])
    rows = {r.doc_id: r for r in bm.score_documents(df, crc_mod("doc_id", 7) == 99).collect()}
    assert [(rows[i].n_tokens, rows[i].n_known, rows[i].base_score) for i in (1, 2)] == [(3, 0, 0.0), (1, 0, 0.0)]


def test_bit_probabilities_sum_to_one():
    """Over the 256 values of a byte in a context the model is a distribution, whatever its counts and weights."""
    rng = np.random.default_rng(0)
    for cut in ({}, {(0, 0): np.stack([np.arange(256), rng.integers(1, 99, 256)])}):
        key = np.concatenate([bm.by_context(np.uint64(context) << np.uint64(8) | np.arange(256, dtype=np.uint64))
                              for context in (0, 0x6162636465, 0x2074686520, 0x2074686165)])
        key, n = np.sort(key), rng.integers(0, 20, len(key)) * rng.integers(0, 2, len(key))
        model = bm.RangeModel.of(key, n, cut)
        model.weights = rng.uniform(-0.2, 0.6, model.weights.shape)
        model.apm = rng.uniform(0.05, 0.95, model.apm.shape)
        context = key >> np.uint64(8)
        for c in np.unique(context):
            assert (10 ** model.log10(key[context == c])).sum() == pytest.approx(1)


def plain_log10(counts, model, context, byte):
    """log10 probability of a byte, bit by bit from a dictionary of counts."""
    out = 0.0
    for k in range(8):
        bit, odds, gate = byte >> 7 - k & 1, [], 0
        for o in range(bm.ORDERS):
            n01 = [sum(c for b, c in counts.get(context[5 - o:], {}).items() if b >> 7 - k == byte >> 8 - k << 1 | x)
                   for x in (0, 1)]
            odds.append(math.log((n01[1] + .4) / (n01[0] + .4)))
            gate += sum(n01) > 0
        z = min(12, max(-12, sum(w * x for w, x in zip(model.weights[k][gate], odds))))
        at = min(max(z * 2 + bm.APM_CELLS // 2, 0), bm.APM_CELLS - 1.001)
        row, low = model.apm[context[-1]], int(at)
        p = 0.5 * (row[low] * (low + 1 - at) + row[low + 1] * (at - low)) + 0.5 / (1 + math.exp(-z))
        p = min(max(p, 1e-6), 1 - 1e-6)
        out += math.log10(p if bit else 1 - p)
    return out


@pytest.mark.parametrize("fan", [1024, 3])
def test_score_against_plain_python(spark, monkeypatch, fan):
    """The whole way to the ranges and back, by one step or through stations, gives what a dictionary of counts gives."""
    rng = np.random.default_rng(5)
    vocabulary = ["the", "then", "there", "tree", "trees", "the\u00e9", "zig", "zag"]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 12))), "en", "a") for i in range(40)] \
        + [(40, None, "en", "a"), (41, "unseen qqq \u4e2d", "en", "a"), (41, "unseen qqq \u4e2d", "en", "a")]
    fitted = []
    monkeypatch.setattr(bm, "FAN", fan)
    monkeypatch.setattr(bm, "BLOCK_BYTES", 200)
    monkeypatch.setattr(bm, "_n_ranges", lambda spark, n_bytes: 20)
    fit = bm.fit
    monkeypatch.setattr(bm, "fit", lambda grams: fitted.append(fit(grams)) or fitted[-1])
    got = [(r.doc_id, r.score) for r in
           bm.score_documents(frame(spark, rows, []), crc_mod("doc_id", 7) != 2).collect()]
    assert len(bm._widths(20)) == (1 if fan == 1024 else 3)
    counts = {}
    for i, text, _, _ in rows:
        if not held(i, 7, 2):
            data = b"\0" * 5 + (text or "").encode() + b"\0"
            for at in range(5, len(data)):
                for o in range(bm.ORDERS):
                    byte = counts.setdefault(data[at - o:at], Counter())
                    byte[data[at]] += 1
    want = []
    for i, text, _, _ in rows:
        data = b"\0" * 5 + (text or "").encode() + b"\0"
        want.append((i, sum(plain_log10(counts, fitted[0], data[at - 5:at], data[at]) for at in range(5, len(data)))))
    for (i, a), (j, b) in zip(sorted(got), sorted(want)):
        assert i == j and a == pytest.approx(b, rel=1e-4)


def test_rows_sent_grow_with_the_text(spark, monkeypatch):
    """A block sends to FAN places at most, however many ranges there are."""
    monkeypatch.setattr(bm, "FAN", 8)
    assert bm._widths(1) == [1] and bm._widths(8) == [1] and bm._widths(9) == [3, 1] and bm._widths(500) == [64, 8, 1]
    monkeypatch.setattr(bm, "FAN", 1024)
    assert [len(bm._widths(n)) for n in (1024, 1025, 1 << 20, 12_500_000)] == [1, 2, 2, 3]
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(300)), "en", "a") for i in range(40)]
    monkeypatch.setattr(bm, "BLOCK_BYTES", 2000)
    held_docs = bm._write_blocks(frame(spark, rows, []).selectExpr(
        "doc_id", "xxhash64(text) th", "true train", "cast(text as binary) text"))
    key = np.unique(bm.by_context(bm.six_grams([r[1].encode() for r in rows])[0]))
    monkeypatch.setattr(bm, "FAN", 8)
    for n in (60, 500):
        edges = key[np.arange(1, n) * len(key) // n]
        width = bm._widths(n)[0]
        assert bm._count_blocks(held_docs, edges, width).count() <= 8 * held_docs.count()


def test_counts_of_ranges_against_plain_python():
    """Every order's counts are exact, also of contexts that the edges of ranges cut, and an unseen one is unseen."""
    texts = [b"the tree that the thief then threw " * 3, b"there, then, the theme", b"zzz e e e e e"]
    unseen = [b"the quiet qqqqqq thx"]
    counts = Counter(g[i:i + 6] for t in texts for g in [b"\0" * 5 + t + b"\0"] for i in range(len(t) + 1))
    key, n = bm.summed(bm.by_context(bm.six_grams(texts)[0]))
    asked = np.unique(bm.by_context(np.concatenate([bm.six_grams(texts)[0], bm.six_grams(unseen)[0]])))
    for edges in (np.zeros(0, np.uint64), key[5::9]):
        shard, sums = np.searchsorted(edges, key, side="right"), {}
        for s in range(len(edges) + 1):
            for o, context in bm._cut_contexts(edges, s):
                here = key >> np.uint64(48 - 8 * o) == np.uint64(context)
                byte = np.bincount((key[here] & np.uint64(255)).astype(int), n[here], 256)
                sums[o, context] = np.stack([np.arange(256), byte])
        for s in range(len(edges) + 1):
            mine = asked[np.searchsorted(edges, asked, side="right") == s]
            there = np.isin(mine, key)
            all_n = np.zeros(len(mine), np.int64)
            all_n[there] = n[shard == s]
            model = bm.RangeModel.of(mine, all_n, {c: sums[c] for c in bm._cut_contexts(edges, s)})
            for k in range(8):
                odds, gate, bit = model.inputs(mine, k, 0)
                for j, x in enumerate(mine.tolist()):
                    context, byte = bytes(x >> 8 * (i + 1) & 255 for i in range(5)), x & 255
                    seen = 0
                    for o in range(bm.ORDERS):
                        n01 = [sum(c for g, c in counts.items() if g[5 - o:5] == context[5 - o:]
                                   and g[5] >> 7 - k == byte >> 8 - k << 1 | b) for b in (0, 1)]
                        assert odds[o, j] == pytest.approx(math.log((n01[1] + .4) / (n01[0] + .4)), abs=1e-5)
                        seen += sum(n01) > 0
                    assert gate[j] == seen and bit[j] == byte >> 7 - k & 1


def test_model_grows_with_the_text(spark):
    """What is kept of the training text is every distinct n-gram, and a held-out text's n-grams count for nothing."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(300)), "en", "a") for i in range(40)]
    held_docs = bm._write_blocks(frame(spark, rows, []).selectExpr(
        "doc_id", "xxhash64(text) th", "doc_id % 2 = 0 train", "cast(text as binary) text"))
    key = np.unique(bm.six_grams([t.encode() for i, t, _, _ in rows if i % 2 == 0])[0])
    edges = np.sort(bm.by_context(key))[::len(key) // 5]
    shards = bm._merge_shards(bm._count_blocks(held_docs, edges)).collect()
    got = np.concatenate([bm.unplaned(r.a)[bm.large(r.b) > 0] for r in shards])
    assert len(shards) > 4 and sorted(got.tolist()) == sorted(bm.by_context(key).tolist())


def test_a_frequent_context_is_cut_over_ranges(spark):
    """Nearly all n-grams follow the same two bytes; no range gets a large part of them, nor of the words' rows."""
    assert bm._n_ranges(spark, 1 << 40) == (1 << 40) // bm.SHARD_BYTES
    rng = np.random.default_rng(4)
    # three random bytes and then the pair, so that the byte after a pair has a context of its own
    rows = [(i, "".join("".join(map(chr, rng.integers(97, 123, 3))) + "e " for _ in range(2000)), "en", "a")
            for i in range(40)]
    df = frame(spark, rows, []).selectExpr(
        "doc_id", "xxhash64(text) th", "true train", "cast(text as binary) text")
    edges = bm._range_edges(df, sum(len(r[1]) for r in rows), len(rows), 50)
    sizes = [len(bm.unplaned(r.a)) for r in bm._merge_shards(bm._count_blocks(bm._write_blocks(df), edges)).collect()]
    assert len(sizes) > 45 and max(sizes) < 3 * sum(sizes) / len(sizes)
    pair = ord(" ") << 8 | ord("e")
    assert sum(int(e) >> 32 == pair for e in edges) >= 4


def test_six_grams():
    key, start = bm.six_grams([b"ab", b"", b"xyz"])
    want = [[b"ab\0"[:i + 1].rjust(6, b"\0") for i in range(3)], [b"\0" * 6],
            [b"xyz\0"[:i + 1].rjust(6, b"\0") for i in range(4)]]
    assert [int(k) for k in key] == [int.from_bytes(b, "big") for t in want for b in t]
    assert start.tolist() == [0, 3, 4]


# Order MinHash

def follow(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(a, b) for a, b in zip(rows, rows[1:] + rows[:1])]


def test_edited_text_and_likeness(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = {r.doc_id: r for r in om.fingerprint_documents(docs).collect()}
    assert len(out) == len(rows)
    text_of = dict(rows)
    for (i, t), (j, u) in follow(rows):
        q = len(t) // 4
        edited = t[:len(t) - q] + u[:q]
        assert (out[i].n_chars, out[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, e = (om.signatures([x.encode()])[0] for x in (t, u, edited))
        assert out[i].fingerprint == a.astype(">u2").tobytes().hex()
        assert out[i].near_edited == pytest.approx((a == e).mean())
        assert out[i].near_next == pytest.approx((a == b).mean())
    long = [r for r in out.values() if len(text_of[r.doc_id].split()) > 200]
    assert np.mean([r.near_edited for r in long]) > 0.25 > 0.05 > np.mean([r.near_next for r in long])


def test_fingerprint_edge_rows(edge, nothing, spark):
    out = om.fingerprint_documents(edge).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in EDGE)
    prints = {}
    for r in out:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[5] == prints[6] and len(prints[5]) == 1
    assert prints[1] == prints[2] == prints[3] == {"0" * 256}
    assert om.fingerprint_documents(nothing).count() == 0
    one = om.fingerprint_documents(frame(spark, [(3, "abcdefgh " * 9, "en", "a")], [])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    many = om.fingerprint_documents(frame(spark, [(i, LONG[:50 + 13 * i], "en", "a") for i in range(200)], [])).collect()
    want = {a[0]: hashlib.sha256((a[1][:len(a[1]) - len(a[1]) // 4] + b[1][:len(a[1]) // 4]).encode()).hexdigest()
            for a, b in follow([(i, LONG[:50 + 13 * i]) for i in range(200)])}
    assert {r.doc_id: r.edited_sha256 for r in many} == want


def test_order_minhash_against_plain_python():
    """The two smallest occurrence-numbered k-mers of each function, in text order."""
    text = ("a b c d a b c d a b c x y z " * 3).strip()
    kmer, n = om._kmers([text.encode()], 3)
    seen, items = Counter(), []
    for h in kmer.tolist():
        items.append(int(om.mix64(np.array([h + seen[h] * 0xD6E8FEB86659FD93 & (1 << 64) - 1], np.uint64))[0]))
        seen[h] += 1
    low = (1 << int(n[0]).bit_length()) - 1
    sig = om.signatures([text.encode()])[0]
    for j in range(om.SIZE):
        a = int(om.mix64(np.array([j + 1], np.uint64) * om._P)[0]) | 1
        value = [(v * a & ((1 << 64) - 1) & ~low) | i for i, v in enumerate(items)]
        places = sorted(sorted(range(len(items)), key=value.__getitem__)[:2])
        h = a
        for p in places:
            h = int(om.mix64(np.array([(h * 0x9E3779B97F4A7C15 + items[p]) & (1 << 64) - 1], np.uint64))[0])
        assert sig[j] == h >> 48
    moved = " ".join(text.split()[::-1])
    assert om.signatures([moved.encode()])[0].tolist() != sig.tolist()
