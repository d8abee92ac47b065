"""Landed documents and their newest rows stay small on disk, and are what they were."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow import schemas
from caseflow.operators import curate as C
from caseflow.plans import curate_queries as CQ
from caseflow.sources import landing as LD


def _bytes(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def test_landed_documents_take_less_than_their_text(spark, sf_dir):
    root = CQ.landed_root(spark, sf_dir)
    text = CQ.landed_detail(spark, sf_dir).agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert _bytes(f"{root}/incidents/detail") < text / 3


def test_newest_rows_without_a_shuffle_of_rows(spark):
    schema = "id string, load_date string, v string, n array<int>"
    rows = [("a", "1", "x", [1]), ("a", "2", "y", None), ("a", "2", "z", [2]), ("b", "1", None, []), ("c", None, "q", None),
            ("c", "1", "r", None), (None, "1", "s", None), (None, "2", "t", None), ("d", "1", "same", [3]), ("d", "1", "same", [3])]
    df = spark.createDataFrame(rows * 3, schema).repartition(5)
    have = C.write_latest(df, ["id"], LD.work_dir(spark, "latest-test"))
    want = C.latest_load(df, ["id"])
    assert have.columns == df.columns
    assert sorted(map(str, have.select(want.columns).collect())) == sorted(map(str, want.collect()))
    none = C.write_latest(df.limit(0), ["id"], LD.work_dir(spark, "latest-test"))
    assert none.count() == 0


def test_conform_is_a_round_trip_through_json(spark):
    have = spark.createDataFrame(
        [(1, 7, [(1.5, None, 2 ** 40), None], ("u",), "2001-01-02"), (None, None, None, None, None), (2, 0, [], (None,), None)],
        "id long, n int, items array<struct<b:double,a:string,big:long>>, who struct<name:string>, d string") \
        .withColumn("t", F.to_timestamp("d")).withColumn("gone", F.lit(None))
    want = T.StructType.fromDDL("who struct<name:string,title:string>, id string, n double, gone string, t string, d string, "
                                "items array<struct<a:string,big:int,b:string>>, other array<int>")
    text = have.select(F.from_json(F.to_json(F.struct(*have.columns)), want).alias("d")).select("d.*")
    out = LD.conform(have, want)
    assert out.columns == text.columns and [f.dataType for f in out.schema] == [f.dataType for f in text.schema]
    assert sorted(map(str, out.collect())) == sorted(map(str, text.collect()))


def test_packed_pages_are_read_and_listed(spark):
    items = spark.range(25).select(F.col("id").cast("string").alias("id"))
    root = LD.work_dir(spark, "packed")
    LD.land_list_pages(items, root, "things", "2026-06-17", key_col="id", page_size=10, compression="gzip")
    pages = LD.read_landed_json(spark, f"{root}/things/list", schemas.envelope(items.schema)).collect()
    assert sorted((p.pagination.page, len(p["items"])) for p in pages) == [(1, 10), (2, 10), (3, 5)]
    first = next(p for p in pages if p.pagination.page == 1)
    assert {i.id for i in first["items"]} == set(sorted(str(i) for i in range(25))[:10])
    assert LD.landed_files(spark, f"{root}/things/list", "2026-06-17").count() > 0
