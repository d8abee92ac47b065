import hashlib
import math

import numpy as np
import pytest

from caseflow.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, near string, part string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows, entries=256, rounds=4):
    """Rows and codebook digest by plain Lloyd rounds over (id, vector, label)."""
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return []
    x = np.array([v for _, v, _ in good], object)
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    d = x.shape[1] // 4
    codes, errors, books = [], 0, []
    for p in range(4):
        y = x[:, p * d:(p + 1) * d]
        book = y[first].copy()

        def assign():
            dist = ((y[:, None, :] - book[None]) ** 2).sum(axis=2).astype(np.int64)
            return dist.argmin(axis=1), dist.min(axis=1)
        for _ in range(rounds):
            of, _ = assign()
            for e in range(len(book)):
                if (of == e).any():
                    book[e] = [s // int((of == e).sum()) for s in y[of == e].sum(axis=0)]
        of, dist = assign()
        codes.append(of)
        errors = errors + dist
        books += [str(c) for e in book for c in e]
    sha = hashlib.sha256(",".join(books).encode()).hexdigest()
    total = {}
    for (_, _, y), e in zip(good, errors):
        total[y] = total.get(y, 0) + int(e)
    return sorted(((i, "".join(f"{c[j]:02x}" for c in codes), int(errors[j]), total[y], sha)
                   for j, (i, _, y) in enumerate(good)), key=str)


def got(df):
    return sorted((tuple(r) for r in vc.code_report(df).collect()), key=str)


def vectors(n, dim=16, seed=0, groups=20):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    v = middles[rng.integers(groups, size=n)] + 0.2 * rng.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in row], int(i) % 3) for i, row in enumerate(v)]


def test_rows_of_every_kind(spark):
    rows = vectors(700)
    rows += [(None, rows[3][1], None), (5, rows[5][1], 5), (5, rows[5][1], 5), (5, rows[6][1], None), (-4, rows[9][1], 1),
             (1000, None, 1), (1001, [1.0, None] * 8, 1), (1002, [float("nan")] * 16, 1),
             (1003, [float("-inf")] + [0.0] * 15, 1), (1004, [0.0] * 16, None), (1005, [-1.0] * 16, 2)]
    assert got(frame(spark, rows).repartition(5)) == brute(rows)


def test_equal_vectors_and_fewer_rows_than_entries(spark):
    for rows in (vectors(40, 8), [(i, [0.5, -0.5, 0.25, 0.0], None) for i in range(300)], vectors(1, 4),
                 vectors(255, 4) + [(900, [0.0] * 4, 0)], vectors(257, 4)):
        assert got(frame(spark, rows)) == brute(rows)


def test_ties_go_to_the_lower_entry(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) / 1024 for x in rng.integers(-3, 4, 8)], 0) for i in range(900)]
    assert got(frame(spark, rows)) == brute(rows)


def test_no_usable_row(spark):
    assert vc.compress(frame(spark, []))[1] == []
    assert got(frame(spark, [])) == got(frame(spark, [(1, None, 1), (2, [None], 2)])) == []


@pytest.mark.parametrize("rows", [[(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)], [(1, [1.0] * 6, 0)], [(1, [1e6] * 8, 0)]])
def test_vectors_that_cannot_be_coded_are_refused(spark, rows):
    with pytest.raises(ValueError):
        vc.compress(frame(spark, rows))


@pytest.mark.parametrize("b", [1, 2, 5, 16, 40])
def test_bounds_hold_and_save_work(b):
    """After each round: the nearest entry is right, every bound is below the distances it stands for."""
    x = np.round(np.array([v for _, v, _ in vectors(2000, 8, 1)]) * 1024).astype(np.int64)
    book = vc.Book(x[:40].copy())
    bounds, whole = vc.Bounds.fresh(x, book, b), []
    for _ in range(6):
        of = bounds.near[:, 0]
        new = np.array([x[of == e].sum(axis=0) // (of == e).sum() if (of == e).any() else book.entries[e]
                        for e in range(40)])
        book = vc.Book(new, book.entries)
        bounds.sink(book)
        own, needed = bounds.assign(x, book)
        dist = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
        assert (bounds.near[:, 0] == dist.argmin(axis=1)).all() and (own == dist.min(axis=1)).all()
        width = bounds.near.shape[1]
        for i in range(width):
            others = dist.astype(float)
            np.put_along_axis(others, bounds.near[:, :i + 1], np.inf, axis=1)
            assert (bounds.low[:, i] <= np.sqrt(others.min(axis=1)) + 1e-6).all()
        whole.append((needed > width).mean())
    if b >= 5:
        assert whole[-1] < 0.5


def test_b_follows_the_need():
    assert vc._next_b({0: 90, 3: 9, 20: 1}, 32, 256) == 8
    assert vc._next_b({0: 10, 15: 90}, 32, 256) == 16
    assert vc._next_b({33: 100}, 32, 256) == 32
