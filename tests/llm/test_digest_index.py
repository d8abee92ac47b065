import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import digest_index as di
from caseflow.llm.common import join_hot
from tests.llm.conftest import EDGE, frame


def brute(rows):
    def digest(t):
        return hashlib.sha256(re.sub("[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = defaultdict(list)
    for key, text in rows:
        groups[digest(text)].append(key)
    out = []
    for d, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k or 0))
        out += [(k, keys[0], len(keys), i == 0, d) for i, k in enumerate(keys)]
    return Counter(out)


def got(df, **options):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                   for r in di.exact_duplicates(df, **options).collect())


@pytest.mark.parametrize("history", [0.0, 0.5, 1.0])
def test_edge_rows(edge, history):
    assert got(edge, history=history) == brute([(r[0], r[1]) for r in EDGE])


def test_empty_table_and_unknown_ids(spark, nothing):
    assert di.exact_duplicates(nothing).collect() == []
    rows = [(None, "a  b", None, None), (None, "a\tb", None, None), (None, None, None, None)]
    assert got(frame(spark, rows)) == brute([(r[0], r[1]) for r in rows])


def test_groups_over_several_shards_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(di, "SHARD_DIGESTS", 16)
    rng = np.random.default_rng(2)
    rows = [(int(i), f"text  {'hot' if rng.random() < 0.4 else rng.integers(300)}\n", None, None)
            for i in rng.permutation(900)]
    rows += rows[:50]
    assert got(frame(spark, rows).repartition(7)) == brute([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 1 << 64, (n, 4), dtype=np.uint64)
    keys[:, 1:] = 7  # digests that differ in one word only
    sizes, bits, slot = di.build_hash(keys)
    assert sorted(slot.tolist()) == list(range(n)) and bits.sum() == n
    assert (di.find_slots(keys, sizes, bits) == slot).all()
    other = keys.copy()
    other[:, 3] = 8
    assert ((di.find_slots(other, sizes, bits) >= -1) & (di.find_slots(other, sizes, bits) < max(n, 1))).all()
    assert len(bits) <= 4 * n + 100


def test_nonmembers_with_a_slot_are_told_apart_by_their_bytes(spark):
    """Every digest has some slot in a small hash; only equal bytes make a member."""
    def groups(names):
        return spark.createDataFrame([(bytearray(hashlib.sha256(x.encode()).digest()), (False, i, i))
                                      for i, x in enumerate(names)],
                                     "digest binary, keep struct<unknown: boolean, doc_id: long, row: long>")
    index = di.build_index(groups([f"old{i}" for i in range(60)]), 3)
    asked = groups([f"old{i}" for i in range(0, 60, 2)] + [f"new{i}" for i in range(500)])
    for parts in (1, 4):
        rows = di.look_up(asked, index, 3, parts).collect()
        assert len(rows) == 530
        members = {bytes(r.digest): (r.keep_id, r.keep_row) for r in rows if r.member}
        assert members == {hashlib.sha256(f"old{i}".encode()).digest(): (i, i) for i in range(0, 60, 2)}


def test_join_hot_takes_every_key_once(spark, monkeypatch):
    from caseflow.llm import common
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for hot in (1, 2, 10, 1000):
        monkeypatch.setattr(common, "HOT_GROUPS", hot)
        out = join_hot(rows, groups, "k", "n", 2000).collect()
        assert len(out) == 2000 and {r.id for r in out} == set(range(2000))
        assert all(r.n == (667 if r.k is None else r.n) for r in out)
