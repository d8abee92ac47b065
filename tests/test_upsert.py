"""A12 on Parquet: a merge writes the buckets it touches; late, replayed and restarted batches change nothing."""

import os

from caseflow.operators import upsert as U
from caseflow.sources.landing import work_dir

SCHEMA = "id long, ts int, value string"


def table(spark, root):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {r.id: (r.ts, r.value) for r in U.read_current(spark, root, schema).collect()}


def merge(spark, root, rows, batch, **options):
    return U.merge_into(spark, root, spark.createDataFrame(rows, SCHEMA), ["id"], batch, "ts", buckets=8, **options)


def files(spark, root):
    """bucket -> (folder, files with their times) of the newest version."""
    out = {}
    for b, folder in U._buckets(spark, root, U.latest_version(spark, root)).items():
        base = f"{root.removeprefix('file:')}/{folder}"
        out[b] = folder, sorted((f, os.stat(f"{base}/{f}").st_mtime_ns) for f in os.listdir(base))
    return out


def test_untouched_buckets_keep_their_files(spark):
    root = work_dir(spark, "upsert-test")
    merge(spark, root, [(i, 1, "a") for i in range(200)], 0)
    before = files(spark, root)
    assert len(before) == 8
    merge(spark, root, [(7, 2, "b")], 1)
    after = files(spark, root)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and table(spark, root)[7] == (2, "b") and len(table(spark, root)) == 200


def test_late_replayed_and_new_rows(spark):
    root = work_dir(spark, "upsert-test")
    merge(spark, root, [(1, 5, "a"), (2, 5, "b")], 0)
    merge(spark, root, [(1, 4, "late"), (2, 6, None), (3, 1, "new")], 1)
    want = {1: (5, "a"), 2: (6, "b"), 3: (1, "new")}
    assert table(spark, root) == want
    name = U.latest_version(spark, root)
    assert merge(spark, root, [(1, 9, "replayed")], 1) == name and table(spark, root) == want
    merge(spark, root, [(1, 4, "late")], 0, source="restarted")
    assert table(spark, root) == want


def test_failed_attempt_is_not_seen_and_is_overwritten(spark):
    root = work_dir(spark, "upsert-test")
    merge(spark, root, [(1, 1, "a")], 0)
    spark.createDataFrame([(9, 9, "half", 0)], SCHEMA + f", {U._BUCKET} int").write.partitionBy(U._BUCKET) \
        .parquet(f"{root}/data/v=000000000001-batch-1")
    assert table(spark, root) == {1: (1, "a")}
    merge(spark, root, [(2, 1, "b")], 1)
    assert table(spark, root) == {1: (1, "a"), 2: (1, "b")}


def test_old_versions_and_their_folders_go(spark):
    root = work_dir(spark, "upsert-test")
    for i in range(6):
        merge(spark, root, [(k, i, f"v{i}") for k in range(i * 3, i * 3 + 40)], i, keep=1)
    base = root.removeprefix("file:")
    assert len(U._versions(spark, root)) == 2
    listed = {f for v in U._versions(spark, root) for f in U._buckets(spark, root, v).values()}
    held = {f"data/{v}/{b}" for v in os.listdir(f"{base}/data") for b in os.listdir(f"{base}/data/{v}")
            if b.startswith(U._BUCKET)}
    assert held == listed and len(table(spark, root)) == 55


def test_empty_batch(spark):
    root = work_dir(spark, "upsert-test")
    merge(spark, root, [], 0)
    assert table(spark, root) == {}
    merge(spark, root, [(1, 1, "a")], 1)
    merge(spark, root, [], 2)
    assert table(spark, root) == {1: (1, "a")}
