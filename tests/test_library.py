"""Library operators without a registered query: parallel landing (A3), landed files (A10),
field inventory (A13), manifest (A5), helpers (B9, B14, B17, B18, I9, I11, I19, K2, G1)."""

import json

from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.functions import columns as FC
from caseflow.operators import graph as G
from caseflow.operators import listing as L
from caseflow.sources import landing as LD
from caseflow.sources.domain import TicketModel, graph_inputs


def _fetcher(total_items=7, page_size=3, empty_from=None):
    def fetch(dataset, page, size):
        n_pages = -(-total_items // page_size)
        start = (page - 1) * page_size
        items = [] if (empty_from and page >= empty_from) else \
            [{"id": f"{dataset}-{i}"} for i in range(start, min(start + page_size, total_items))]
        return {"pagination": {"page": page, "page_size": page_size, "total_items": total_items,
                               "total_pages": n_pages}, "items": items}
    return fetch


def test_parallel_landing_walks_all_pages(spark):
    root = LD.work_dir(spark, "land-test")
    pages = LD.land_paged_collection(spark, ["incidents", "kb_articles"], _fetcher(), root, "2026-06-17",
                                     page_size=3)
    got = sorted((r.dataset, r.page, r.item_count) for r in pages.collect())
    assert got == [("incidents", 1, 3), ("incidents", 2, 3), ("incidents", 3, 1),
                   ("kb_articles", 1, 3), ("kb_articles", 2, 3), ("kb_articles", 3, 1)]
    landed = spark.read.json(f"{root}/_pages")
    assert landed.count() == 6
    items = landed.select("dataset", F.explode(F.from_json("payload", "items array<struct<id string>>").items))
    assert items.count() == 14


def test_each_page_is_fetched_once(spark, tmp_path):
    inner, log = _fetcher(), str(tmp_path / "fetched")

    def fetch(dataset, page, size):
        with open(log, "a") as f:
            f.write(f"{dataset}:{page}\n")
        return inner(dataset, page, size)

    LD.land_paged_collection(spark, ["incidents"], fetch, LD.work_dir(spark, "land-test"), "2026-06-17", page_size=3)
    assert sorted(open(log).read().split()) == ["incidents:1", "incidents:2", "incidents:3"]


def test_list_pages_are_full_for_any_key(spark):
    root = LD.work_dir(spark, "pages-test")
    items = spark.createDataFrame([(f"inc-{i * 7:04d}",) for i in range(23)], "id string")
    LD.land_list_pages(items, root, "things", "2026-06-17", key_col="id", page_size=10)
    env = LD.read_landed_json(spark, f"{root}/things/list", schemas.envelope(items.schema)).orderBy("pagination.page")
    got = [(r.pagination.page, r.pagination.total_pages, r.pagination.total_items, len(r["items"])) for r in env.collect()]
    assert got == [(1, 3, 23, 10), (2, 3, 23, 10), (3, 3, 23, 3)]


def test_articles_that_no_ticket_links_are_curated(spark):
    from caseflow.operators import curate as C
    detail = spark.createDataFrame([], schemas.INCIDENT_DETAIL).withColumn("load_date", F.lit("2026-06-17"))
    article = spark.createDataFrame([{"id": "a1", "number": "KB1", "title": "t", "content_html": "<p>x</p>",
                                      "category": {"id": "c", "name": "C", "subcategory": None}}], schemas.ARTICLE)
    t = C.curate(detail, {"kb_articles": article})
    assert [r.kb_article_id for r in t["kb_articles"].collect()] == ["a1"]
    assert [r.category_id for r in t["categories"].collect()] == ["c"]
    assert [(r.source_type, r.clean_text) for r in t["retrieval_documents"].collect()] == [("kb_article", "x")]


def test_landing_stops_at_an_empty_page(spark):
    root = LD.work_dir(spark, "land-test")
    pages = LD.land_paged_collection(spark, ["incidents"], _fetcher(total_items=9, empty_from=2), root,
                                     "2026-06-17", page_size=3)
    assert sorted(r.page for r in pages.collect()) == [1]


def test_landed_files_field_inventory_and_manifest(spark, sf_dir):
    root = LD.work_dir(spark, "files-test")
    items = TicketModel(spark, sf_dir).incidents_base().select(
        F.col("incident_id").cast("string").alias("id"), "number", "state")
    LD.land_list_pages(items, root, "incidents", "2026-06-17", key_col="id", page_size=50)
    files = LD.landed_files(spark, f"{root}/incidents/list", "2026-06-17").collect()
    assert files and all(r.landed_path.endswith(".json") for r in files)
    assert [r.landed_path for r in files] == sorted(r.landed_path for r in files)
    inv = LD.field_inventory(spark, {"incidents": schemas.INCIDENT_LIST_ITEM}).collect()
    assert [r.field_name for r in inv] == sorted(f.name for f in schemas.INCIDENT_LIST_ITEM.fields)
    env = schemas.envelope(schemas.INCIDENT_LIST_ITEM)
    pages = LD.read_landed_json(spark, f"{root}/incidents/list", env, load_date="2026-06-17")
    man = LD.manifest_for_pages(pages, "incidents", "/api/incidents")
    assert man.agg(F.sum("item_count")).first()[0] == items.count()
    summ = LD.endpoint_summary(man).first()
    assert summ.records_returned == summ.total_reported and summ.status == "ok"


def test_json_rows_to_df(spark):
    df = spark.createDataFrame([(json.dumps({"id": "a", "state": "New"}),)], "t string")
    out = LD.json_rows_to_df(df, "t", schemas.INCIDENT_LIST_ITEM).first()
    assert out.id == "a" and out.state == "New" and out.requester is None


def test_column_helpers(spark):
    df = spark.createDataFrame([(" a, ,b ,", "file.Final.LOG", "x" * 400, None, "12x")],
                               "kw string, f string, long string, n string, num string")
    r = df.select(FC.split_keywords(F.col("kw")).alias("k"), FC.asset_type_from_name(F.col("f")).alias("t"),
                  FC.truncate(F.col("long"), 300).alias("s"), L.first_present("n", "kw").alias("fp"),
                  L.pick_col(df, ["missing", "f"]).alias("pc"), L.pick_col(df, ["missing"]).alias("pn"),
                  FC.try_cast(F.col("num"), "int").alias("ti"), FC.confidence(F.lit(6.0)).alias("c")).first()
    assert r.k == ["a", "b"] and r.t == "log" and len(r.s) == 300 and r.fp == " a, ,b ,"
    assert r.pc == "file.Final.LOG" and r.pn is None and r.ti is None and r.c == 1.0
    blank = spark.createDataFrame([("  ",), ("x",), (None,)], "t string")
    assert blank.where(L.skip_blank_text("t")).count() == 1
    typed = spark.createDataFrame([("kb_article",), ("work_note",)], "source_type string")
    assert typed.where(L.content_type_filter(["kb_article"])).count() == 1
    assert typed.where(L.content_type_filter(None)).count() == 2


def test_image_fallback_uses_image_attachments(spark, sf_dir):
    g = graph_inputs(TicketModel(spark, sf_dir))
    att = g["attachments"].withColumn("content_type", F.when(F.col("attachment_id").endswith("0"),
                                                             F.lit("image/png")).otherwise(F.col("content_type")))
    g2 = dict(g, attachments=att)
    del g2["images"]
    n = G.build_nodes(g2).where(F.col("node_type") == "Image").count()
    assert n == att.where(F.col("content_type").startswith("image/")).count()


def test_page_clamps(spark):
    assert L.clamp_page(0, 1000) == (1, 100)
    assert L.clamp_k(0) == 1 and L.clamp_k(99) == 20


def test_embed_batches_deterministic_unit_vectors(spark):
    import numpy as np

    from caseflow.operators import searchdocs as SD
    rows = [(i, f"text number {i} about printers" if i % 5 else "") for i in range(250)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    a = {r.id: r.vector for r in SD.embed_batches(df, "id", "t", batch_size=100).collect()}
    b = {r.id: r.vector for r in SD.embed_batches(df.repartition(5), "id", "t", batch_size=7).collect()}
    assert len(a) == 250 and a == b  # one vector per row, independent of batching and partitioning
    for i, v in a.items():
        n = float(np.linalg.norm(np.array(v, dtype=np.float64)))
        assert len(v) == 64 and (abs(n - 1.0) < 1e-5 if i % 5 else n == 0.0)
