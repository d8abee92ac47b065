"""Landing leaves no shuffle files behind, and incidents are rendered share by share."""

import time

from pyspark.sql import functions as F

from caseflow.operators import curate as C
from caseflow.plans import curate_queries as CQ
from caseflow.plans import ticket_fixture as TF
from caseflow.plans.steps import Steps
from caseflow.sources import landing as LD


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_landing_leaves_no_shuffle_files(spark, sf_dir):
    before = _shuffled(spark)
    docs = TF.render_incident_details(spark, sf_dir)
    path = LD.land_details(docs, LD.work_dir(spark, "freed"), "incidents", "2001-08-01", compression="gzip")
    LD.land_list_pages(spark.range(120), LD.work_dir(spark, "freed"), "things", "2001-08-01", key_col="id")
    rows = LD.read_landed_json(spark, path, docs.schema)
    C.write_latest(rows, ["id"], LD.work_dir(spark, "freed"))
    until = time.time() + 20  # files are removed in the background
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - before


def test_shares_hold_every_document_once(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(TF, "SHARE_INCIDENTS", 500)
    monkeypatch.setattr(TF, "MAX_SHARES", 3)
    shares = TF.incident_shares(spark, sf_dir)
    assert shares == [(0, 3), (1, 3), (2, 3)]

    def texts(df):
        return sorted(r[0] for r in df.select(F.xxhash64(F.to_json(F.struct("*")))).collect())
    parts = [texts(TF.render_incident_details(spark, sf_dir, s)) for s in shares]
    assert all(parts) and sorted(sum(parts, [])) == texts(TF.render_incident_details(spark, sf_dir))
    root = LD.work_dir(spark, "shares")
    CQ._land(spark, sf_dir, root, CQ.DETAILS)
    landed = spark.read.json(f"{root}/incidents/detail")
    assert landed.where(F.col("load_date") == CQ.LOAD_1).count() == sum(map(len, parts))


def test_a_step_leaves_no_shuffle_files(spark):
    steps, before = Steps(spark, LD.work_dir(spark, "steps")), _shuffled(spark)
    folder = steps.run("sum", lambda to: spark.range(1000).groupBy((F.col("id") % 9).alias("k")).count().write.parquet(to))
    until = time.time() + 20
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - before and spark.read.parquet(folder).count() == 9
