"""Incidents that share nodes or types of evidence, against plain loops over planted edges."""

import random
from collections import defaultdict

import pytest

from caseflow.operators import graph as G

SCHEMA = "source_node_id string, target_node_id string, relationship_type string, properties_json string"


def planted(seed):
    """Edges of 60 incidents; a third of them share pattern p0, service s0, category c0 and PNG images."""
    rng, rows = random.Random(seed), []
    for i in range(60):
        hot = i % 3 == 0
        s = f"incident:{i}"
        rows.append((s, "pattern:p0" if hot else f"pattern:p{rng.randrange(1, 8)}", "RESOLVED_BY_PATTERN", None))
        rows.append((s, "service:s0" if hot else f"service:s{rng.randrange(1, 5)}", "IMPACTS_SERVICE", None))
        if i % 10:
            rows.append((s, "category:c0" if hot else f"category:c{rng.randrange(1, 4)}", "BELONGS_TO_CATEGORY", None))
        for j in range(rng.randrange(3)):
            kind = "image/png" if hot else rng.choice(["image/png", "image/gif"])
            rows.append((s, f"image:{i}-{j}", "HAS_IMAGE", f'{{"content_type":"{kind}","mock_url":"u"}}'))
        for j in range(rng.randrange(3)):
            rows.append((s, f"document:{i}-{j}", "HAS_DOCUMENT", f'{{"source_type":"{rng.choice("ab")}"}}'))
        rows.append((s, f"image:{i}-none", "HAS_IMAGE", rng.choice([None, "{}"])))
    return rows + rows[:20]  # repeated edges


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_pattern_and_service(spark, seed):
    rows, groups = planted(seed), defaultdict(set)
    by = {r: dict((a, b) for a, b, c, _ in rows if c == r) for r in ("RESOLVED_BY_PATTERN", "IMPACTS_SERVICE")}
    for i, p in by["RESOLVED_BY_PATTERN"].items():
        groups[p, by["IMPACTS_SERVICE"][i]].add(i)
    got = G.shared_neighbour_groups(spark.createDataFrame(rows, SCHEMA), "RESOLVED_BY_PATTERN", "IMPACTS_SERVICE")
    want = {(a, b, len(x), min(x)) for (a, b), x in groups.items() if len(x) >= 2}
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 3


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_category_and_evidence_type(spark, seed):
    rows, groups = planted(seed), defaultdict(set)
    category = {a: b for a, b, r, _ in rows if r == "BELONGS_TO_CATEGORY"}
    for a, _, r, p in rows:
        if r in ("HAS_IMAGE", "HAS_DOCUMENT") and p not in (None, "{}") and a in category:
            groups[category[a], r, p.split('"')[3]].add(a)
    got = G.shared_evidence_types(spark.createDataFrame(rows, SCHEMA))
    want = {(*k, i, len(x)) for k, x in groups.items() if len(x) >= 2 for i in x}
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 20


def test_no_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert G.shared_evidence_types(empty).count() == 0
    assert G.shared_neighbour_groups(empty, "RESOLVED_BY_PATTERN", "IMPACTS_SERVICE").count() == 0
