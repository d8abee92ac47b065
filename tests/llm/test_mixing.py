from collections import Counter, defaultdict

import pytest

from caseflow.llm import mixing
from caseflow.llm.common import write_once
from tests.llm.conftest import EDGE, frame


def n_words(t):
    return len(t.encode().split()) if t else 0


def targets(sizes):
    """The contract's sharing, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 3 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def check(rows, report):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += n_words(t)
    want = targets(sizes)
    assert Counter((r[0], n_words(r[1]), sizes[r[3]]) for r in rows) == \
        Counter((r.doc_id, r["size"], r.source_size) for r in report)
    taken = defaultdict(int)
    for r in report:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    total, groups = sum(sizes.values()), Counter((sizes[s], round(want[s], 6)) for s in sizes)
    for (size, target), n in groups.items():
        assert taken[size, target] == pytest.approx(n * target, abs=n * (0.002 * total + 8))


def test_report_follows_targets(docs):
    report = mixing.mix_report(docs).collect()
    check([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()], report)


def test_edge_rows_and_reruns(edge):
    report = mixing.mix_report(edge).collect()
    check(EDGE, report)
    assert sorted(map(str, report)) == sorted(map(str, mixing.mix_report(edge).collect()))


def test_empty_table(nothing):
    assert mixing.mix_report(nothing).count() == 0
    assert mixing.mix_documents(nothing).count() == 0


def test_slots_of_several_chunks(spark, monkeypatch):
    """Ranks run on from chunk to chunk, and no source falls behind its share."""
    monkeypatch.setattr(mixing, "CHUNK", 100)
    plan = mixing.Plan(["a", "b", "c"], [500, 300, 200], [1, 1, 1], [625.0, 250.0, 125.0], 1, 1000)
    rows = sorted(mixing.slot_schedule(spark, plan).collect())
    assert [r.slot for r in rows] == list(range(1000))
    seen = Counter()
    for i, r in enumerate(rows, 1):
        assert r["rank"] == seen[r.k]
        seen[r.k] += 1
        assert all(abs(seen[k] - i * s) < 6 for k, s in enumerate((0.625, 0.25, 0.125)))


def test_mixed_pieces_fill_their_slots(docs):
    placed, pieces, plan = mixing.mix_slots(docs)
    by_slot = Counter()
    for r in pieces.select("slot", "n_words").collect():
        by_slot[r.slot] += r.n_words
    assert len(by_slot) <= plan.slots
    assert max(by_slot.values()) == plan.block


@pytest.mark.parametrize("least", [1, 60])
def test_each_source_gives_its_own_target(spark, monkeypatch, least):
    """Sources far below a block, and more of them than slots, are taken to the word."""
    monkeypatch.setattr(mixing, "CHUNK", 20)
    rows = [(i, "w " * 400, "en", "big") for i in range(20)]
    rows += [(100 + 2 * i + j, "v " * (least + i), "en", f"s{i:02}") for i in range(40) for j in range(2)]
    df, sizes = frame(spark, rows, []), Counter()
    for _, t, _, s in rows:
        sizes[s] += n_words(t)
    want = targets(sizes)
    assert min(want.values()) < sum(sizes.values()) // 20
    source, taken, mixed = {r[0]: r[3] for r in rows}, Counter(), Counter()
    for r in mixing.mix_report(df).collect():
        taken[source[r.doc_id]] += r.taken
    for r in mixing.mix_documents(df).collect():
        mixed[r.source] += n_words(r.text)
    assert all(abs(taken[s] - want[s]) < 1 for s in sizes) and mixed == taken
    assert sum(taken.values()) == sum(sizes.values())
    pieces = mixing.mix_slots(df)[1].collect()
    assert len({(r.k, r["rank"]) for r in pieces}) == len({r.slot for r in pieces})


def test_mixed_documents_are_whole_but_for_the_last_of_a_source(edge, docs):
    for df in (edge, docs):
        out = mixing.mix_documents(df)
        assert out.columns == df.columns
        taken = {(r.doc_id, r["size"]): r.taken for r in mixing.mix_report(df).collect()}
        text = {(r.doc_id, n_words(r.text)): r.text for r in df.collect()}
        whole, cut, got = {t for t in text.values() if t}, defaultdict(int), 0
        for r in out.collect():
            got += n_words(r.text)
            assert r.n_chars == len(r.text)
            if r.text not in whole:
                cut[r.source] += 1
                assert any(t.startswith(r.text) for t in whole)
        assert all(n == 1 for n in cut.values())
        assert got == sum(r.taken for r in mixing.mix_report(df).collect()) or df is edge and taken


@pytest.mark.parametrize("block", [200, 2000])
def test_every_first_part_of_the_mix_holds_the_targets(spark, docs, block):
    """Running shares of the written mix and of op2's places follow the targets, within some blocks."""
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += n_words(r.text)
    want, total = targets(sizes), sum(sizes.values())
    mixed = [(r.source, n_words(r.text)) for r in write_once(
        mixing.mix_documents(docs, block_words=block), "mix-test").collect()]
    report = [r for r in mixing.mix_slots(docs, block_words=block)[1].orderBy("slot", "epoch", "from_word").collect()]
    longest = max(n for _, n in mixed)
    for rows in (mixed, [(source[r.doc_id], r.n_words) for r in report]):
        seen, done = defaultdict(int), 0
        for s, n in rows:
            seen[s] += n
            done += n
            if done < 0.95 * total:  # blocks that the schedule has no slot for follow at the end
                assert all(abs(seen[x] - done * want[x] / total) <= 8 * block + 2 * longest for x in want)
    first = {r.doc_id: r.first_slot for r in mixing.mix_report(docs, ).collect()}
    assert any(x is not None for x in first.values())
