from collections import Counter

import corpus_pipeline as cp
from caseflow.llm import langid, mixing
from caseflow.llm.common import crc_mod, write_once
from tests.llm.conftest import CLASHING, EDGE
from tests.llm.test_line_spread import brute as lines_brute
from tests.llm.test_near_join import brute as near_brute
from tests.llm.test_tokens import cut, plain


def test_stages_and_order():
    assert [n for n, _ in cp.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "source mix",
                                         "best-fit packing"]


def test_stages_against_brute_force(spark, docs, sf_dir):
    table, steps = docs, [docs]
    for _, stage in cp.STAGES[:-1]:
        table = write_once(stage(spark, table, sf_dir), "stage-test")
        assert table.columns == docs.columns
        steps.append(table)
    raw, spoken, lined, single, mixed = ([tuple(r) for r in s.collect()] for s in steps)

    model = langid.learn_profiles(docs.where(crc_mod("doc_id", 5) != 0))
    judged = {r[0]: model.nearest(r[1]) for r in raw}
    assert Counter(r[0] for r in spoken) == Counter(
        r[0] for r in raw if judged[r[0]][0] != "und" and judged[r[0]][1] >= cp.MIN_LANGUAGE_SCORE)
    assert all(r[2] == judged[r[0]][0] for r in spoken)

    cleaned = lines_brute([(r[0], r[1], r[2], r[3]) for r in spoken], 5)
    assert Counter((r[0], r[1]) for r in lined) == Counter(
        (i, t) for i, n, gone, t in cleaned.elements() if not gone or gone < n)
    assert all(r[4] == len(r[1]) for r in lined)

    classes = near_brute([(r[0], r[1]) for r in lined])
    assert Counter(r[0] for r in single) == Counter(i for i, c, _, _ in classes.elements() if i == c)

    taken = Counter()
    for r in mixing.mix_report(steps[3]).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in mixed:
        got[r[0]] += len(r[1].encode().split())
    assert got == +taken

    packed = Counter((r.doc_id, r.piece, r.start, r.length) for r in cp.STAGES[-1][1](spark, steps[4], sf_dir).collect())
    assert packed == Counter((r[0], k, i, len(p)) for r in mixed for k, i, p in cut(plain(r[1]) + [2]))


def test_run_takes_every_stage(spark, sf_dir):
    out = cp.run(spark, sf_dir)
    assert out.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


def test_edge_rows_pass_through(spark, edge, nothing, sf_dir):
    for df in (edge, nothing):
        table = df
        for _, stage in cp.STAGES[:-1]:
            table = write_once(stage(spark, table, sf_dir), "stage-test")
            assert table.columns == df.columns
            for r in table.collect():
                assert {r[c] for c in CLASHING} == {"x"}
        assert table.where("text is null").count() == 0
        assert cp.STAGES[-1][1](spark, table, sf_dir).count() >= table.count()
    assert len(EDGE) > 0
