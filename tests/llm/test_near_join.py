import re
from collections import Counter

import numpy as np
import pytest

from caseflow.llm import near_join as nj
from tests.llm.conftest import CLASHING, EDGE, frame


def brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, copies = Counter(), Counter()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                copies[i] += a == b
                x, y = sorted((find(i), find(j)))
                root[y] = x
    ids = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            ids[find(i)] = min(rows[i][0], ids.get(find(i), rows[i][0]))
    return Counter((rows[i][0], ids.get(find(i)), copies[i] + 1, links[i]) for i in range(len(rows)))


def got(df):
    return Counter((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in nj.near_duplicate_classes(df).collect())


def test_edge_rows(edge):
    assert got(edge) == brute([(r[0], r[1]) for r in EDGE])


def test_empty_table(nothing):
    assert nj.near_duplicate_classes(nothing).count() == 0
    assert nj.keep_one_of_each(nothing).columns == nothing.columns


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.6, 0.95), (0.9, 0.9999)):
        bands, rows = nj.choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall and bands * rows <= 128


def test_group_of_near_copies_over_several_blocks(spark, monkeypatch):
    """Blocks of few members: every link is counted once, whichever blocks its ends are in."""
    monkeypatch.setattr(nj, "BLOCK_MEMBERS", 8)
    base = [f"w{i}" for i in range(120)]
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        w = list(base)
        w[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(100 + i, " ".join(f"y{i}{j}" for j in range(40)), "en", "s") for i in range(5)]
    # the lists are (doc, class, copies, links); LSH misses none of these at the production recall
    assert got(frame(spark, rows, [])) == brute([(r[0], r[1]) for r in rows])


def test_one_document_of_each_class_stays(edge):
    left = [r.doc_id for r in nj.keep_one_of_each(edge).collect()]
    assert [x for x in left if x in (5, 6)] == [5]  # rows that repeat count once
    assert set(left) >= {None, 1, 2, 3, 4, 7, 8, 9, 11, -12}


def test_clashing_names_keep_their_values(edge):
    for r in nj.keep_one_of_each(edge).collect():
        assert {r[c] for c in CLASHING} == {"x"}


def test_shared_and_null_ids_lose_copies_alone(spark):
    x, y, z, u = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "la le li lo lu ly",
                  "ra re ri ro ru ry")
    rows = [(1, x), (5, x), (5, y), (None, x), (None, z), (7, u), (7, u + " "), (8, u)]
    left = nj.keep_one_of_each(frame(spark, [(*r, "en", "a") for r in rows], [])).collect()
    assert sorted((str(r.doc_id), r.text.strip()) for r in left) == [("1", x), ("5", y), ("7", u), ("None", z)]


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)],
                                   [(7, 3), (3, 9), (9, 7), (1, 2), (20, 3)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    out = {bytes(r.node)[0]: bytes(r.root)[0] for r in nj.components(df).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert out == root
