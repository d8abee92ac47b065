"""Evidence is made for the tickets asked alone, and nesting leaves no shuffle files of the rows that it wrote."""

import time

from pyspark.sql import functions as F

from caseflow.operators import nesting as NS
from caseflow.plans import question_queries as QQ
from caseflow.sources.domain import TicketModel
from tests.test_disk_freed import _shuffled


def test_links_of_other_tickets_are_left_out(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    some = tm.incidents_base().where("incident_id % 7 = 0").select("incident_id")
    asked = {r[0] for r in some.collect()}
    found = QQ._linked(spark, sf_dir, some).where("source_type != 'pattern'").select("subject_id", "source_type", "source_id").collect()
    articles = tm.incident_kb_links().join(tm.kb_articles(), "kb_article_id") \
        .select("incident_id", F.lit("article"), "kb_article_number")
    changes = tm.incident_changes().join(tm.change_requests(), "change_request_id").select("incident_id", F.lit("change"), "number")
    want = [tuple(r) for r in articles.unionByName(changes.toDF(*articles.columns)).collect() if r[0] in asked]
    assert sorted(map(tuple, found)) == sorted(want) and want


def test_nesting_leaves_no_shuffle_files_of_what_it_wrote(spark):
    before = _shuffled(spark)
    parent = spark.range(50).select(F.col("id").alias("k"))
    child = spark.range(2000).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    nested = NS.nest_in_chunks(parent, "k", {"xs": (child, ["x"])}, chunk=10)
    until = time.time() + 20  # files are removed in the background
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - before
    assert nested.select(F.sum(F.size("xs"))).first()[0] == 2000
