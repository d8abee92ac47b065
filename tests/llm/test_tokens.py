import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import packing, token_records as tr
from caseflow.llm.common import read_range, run_folder
from caseflow.llm.tokens import Encoder
from tests.llm.conftest import LONG, frame

ENC = Encoder("byte_bpe_50k.json")


def plain(t):
    return [i for e in [ENC.lib.encode(t or "", add_special_tokens=False)] for i in e.ids]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list(" ab.,'\n\t\x1c\x00é日1!_")), max_size=30), max_size=5))
def test_units_give_the_ids_of_the_whole_text(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in ENC.encode(texts)] == [plain(t) for t in texts]


def test_encoder_forgets_and_goes_on():
    small = Encoder("byte_bpe_50k.json", remembered=3)
    for _ in range(3):
        assert small.encode(["one two three four five", "two  three"]) == ENC.encode(
            ["one two three four five", "two  three"])


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_records_against_plain_python(request, which):
    df = request.getfixturevalue(which)
    got = tr.token_table(df).collect()
    rows = [(r.doc_id, plain(r.text) + [0]) for r in df.collect()]
    got.sort(key=lambda r: r.start)
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    assert [r.doc_id for r in got] == [r[0] for r in in_order(rows)]
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens


def test_shuffled_reads_and_damage(spark, edge):
    shards = tr.write_records(edge, run_folder(spark, "token-test")).collect()
    for s in shards:
        data, index = read_range(s.uri), np.frombuffer(read_range(s.uri.replace(".rec", ".idx")), "<u8")
        assert index[-1] == len(data) and len(index) == s.records + 1
        for i in reversed(range(s.records)):
            n, crc = struct.unpack("<QI", data[index[i]:index[i] + 12])
            assert crc == tr.masked(data[index[i]:index[i] + 8]) and index[i] + n + 16 == index[i + 1]
            assert tr.read_record(s.uri, i) == tr.parse(tr.unframe(data, int(index[i])))
        with pytest.raises(ValueError):
            tr.unframe(data[:20] + bytes([data[20] ^ 1]) + data[21:])


def test_empty_table(nothing):
    assert tr.token_table(nothing).count() == 0
    assert packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    rows = packing.pack_documents(df, with_ids=True).collect()
    want = defaultdict(list)
    for r in df.collect():
        want[r.doc_id].append(plain(r.text) + [2])
    got, sequences = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32 and 1 <= r.length <= 1024
        assert r.piece == 0 or r.length == 1024
        got[r.doc_id].append((r.piece, r.start, ids.tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, texts in want.items():
        pieces = sorted(str(x) for t in texts for x in cut(t))
        assert pieces == sorted(map(str, got[key]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_groups_follow_pieces(spark, monkeypatch):
    """Whole pieces go to no group, and the others to groups by their number."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 20, raising=False)
    pieces = packing.token_pieces(frame(spark, [(1, LONG, "en", "a"), (2, LONG, "en", "a"), (3, "a b", "en", "a")], []), capacity=64)
    assert pieces.count() > 2000
    rows = packing.pack(pieces, 1, 64).collect()
    whole = [r.sequence_id for r in rows if r.length == 64]
    others = {r.sequence_id for r in rows if r.length < 64}
    assert len(set(whole)) == len(whole) > 2000 and max(whole) < 0 <= min(others) and len(others) == 1
    docs = frame(spark, [(i, "a few words " * (1 + i % 9), "en", "a") for i in range(200)], [])
    groups = {r.sequence_id >> 32 for r in packing.pack_documents(docs).collect()}
    assert len(groups) == 10


def cut(ids):
    first = (len(ids) - 1) % 1024 + 1
    edges = [0, *range(first, len(ids) + 1, 1024)]
    return [(k, i, ids[i:j]) for k, (i, j) in enumerate(zip(edges, edges[1:]))]


def test_sum_of_squares_rule_step_by_step():
    """Each placement leaves the least sum of squares that any open bin allows; a new bin only where none fits."""
    rng = np.random.default_rng(3)
    for capacity in (10, 25):
        sizes = rng.integers(1, capacity + 1, 200)
        bins, _ = packing.sum_of_squares_pack(sizes, capacity)
        gaps = {}

        def total(g):
            n = np.bincount([x for x in g.values() if 0 < x < capacity], minlength=1)
            return int((n.astype(int) ** 2).sum())

        for i in np.argsort(-sizes, kind="stable"):
            options = [total(gaps | {b: g - sizes[i]}) for b, g in gaps.items() if g >= sizes[i]]
            options = options or [total(gaps | {-1: capacity - sizes[i]})]
            gaps[bins[i]] = gaps.get(bins[i], capacity) - sizes[i]
            assert total(gaps) == min(options) and gaps[bins[i]] >= 0


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1025, 8000)
    bins, _ = packing.sum_of_squares_pack(sizes, 1024)
    assert bins.max() + 1 <= 1.005 * sizes.sum() / 1024


def test_ids_beyond_the_width_are_refused():
    ids = np.array([70_000], "<u4").tobytes()
    assert tr.parse(tr.serialize(1, ids, 4), 4) == (1, ids)
    with pytest.raises(ValueError):
        tr.serialize(1, ids, 2)
