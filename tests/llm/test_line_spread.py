from collections import Counter, defaultdict

from caseflow.llm import line_spread as ls
from tests.llm.conftest import CLASHING, EDGE, frame

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, t, _, s in rows:
        for p, x in enumerate((t or "").split("\n")):
            if x.strip(BLANKS):
                sites[x.strip(BLANKS)].add(s)
                place = (i is not None, i or 0, p)
                first[x.strip(BLANKS)] = min(place, first.get(x.strip(BLANKS), place))
    bad = {x for x, s in sites.items() if len(s - {None}) >= min_sites}
    out = []
    for i, t, _, _ in rows:
        parts = (t or "").split("\n")
        gone = [x.strip(BLANKS) in bad and first[x.strip(BLANKS)] != (i is not None, i or 0, p)
                for p, x in enumerate(parts)]
        out.append((i, sum(bool(x.strip(BLANKS)) for x in parts), sum(gone),
                    None if t is None else "\n".join(x for x, g in zip(parts, gone) if not g)))
    return Counter(out)


def got(df, **options):
    out = ls.drop_spread_lines(df, **options)
    assert out.columns == [c for c in df.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    rows = out.collect()
    assert all(r[c] == "x" for r in rows for c in CLASHING if c in df.columns and c not in ("n_lines", "n_removed"))
    return Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in rows)


def test_edge_rows(edge, nothing):
    for min_sites in (1, 2, 3, 5):
        assert got(edge, min_sites=min_sites) == brute(EDGE, min_sites)
    assert ls.drop_spread_lines(nothing).count() == 0


def test_near_lines_are_counted_exactly(spark):
    """Spreads around a threshold that the sketch only estimates."""
    rows = [(i, f"line {n}\nown {n} {i}", "en", f"site{i}") for n in (48, 49, 50, 51, 52) for i in range(n)]
    rows = [(1000 * k + i, t, g, s) for k, (i, t, g, s) in enumerate(rows)]
    assert got(frame(spark, rows, []), min_sites=50) == brute(rows, 50)
    assert got(frame(spark, rows, []), min_sites=50, lg_k=4, margin=0.9) == brute(rows, 50)


def test_exact_count_reads_near_lines_alone(spark):
    """The pairs that are counted exactly come from near lines, not from all lines."""
    rows = [(i, "\n".join([f"near {i % 3}", *[f"only {i} {j}" for j in range(30)]]), "en", f"site{i % 15}")
            for i in range(60)]
    df = frame(spark, rows, []).selectExpr("doc_id as id", "xxhash64(text) as th", "text", "source as site")
    bad = ls.boilerplate_lines(df, 5)
    assert bad.count() == 3
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
