"""What the landing shuffles is narrow, and a query lands what it reads alone."""

import os

from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators.listing import nest_children
from caseflow.plans import curate_queries as CQ
from caseflow.plans.ticket_fixture import incident_items, render_incident_details
from caseflow.sources import landing as LD


def test_articles_land_no_tickets(spark, sf_dir, tmp_path):
    os.symlink(sf_dir, tmp_path / "sf")  # a folder of its own: nothing is landed yet
    own = str(tmp_path / "sf")
    assert CQ.curated(spark, own, "kb_articles")["kb_articles"].count() > 0
    root = CQ.landed_root(spark, own, "kb_articles").removeprefix("file:")
    assert sorted(os.listdir(root)) == ["kb_articles"]


def test_loads_of_a_column_are_written_unsorted(spark):
    rows = spark.createDataFrame([("a/b", 1), ("c", 2), ("d", 3)], "id string, v int") \
        .withColumn("load", F.explode(F.when(F.col("v") > 1, F.array(F.lit("2001-01-01"), F.lit("2001-01-02")))
                                      .otherwise(F.array(F.lit("2001-01-01")))))
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    root = LD.work_dir(spark, "loads")
    LD.land_details(rows.drop("load"), root + "-one", "t", "2001-01-03", compression="gzip")
    LD.land_details(rows.select("id", "v", "load"), root, "t", F.col("load"), compression="gzip")
    assert spark.conf.get(name, None) == before
    schema = rows.drop("load").schema
    got = LD.read_landed_json(spark, f"{root}/t/detail", schema).select("id", "v", F.col("load_date").cast("string"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_items_shaped_after_the_join_are_those_shaped_before(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    child = spark.createDataFrame([(1, 9, "z"), (1, 10, "a"), (1, 9, "a"), (3, 1, "q"), (None, 1, "n")], "k long, n int, s string")

    def fields(n, s):
        return {"id": F.concat(F.lit("N"), n.cast("string")), "text": F.upper(s)}

    rendered = child.select("k", *[c.alias(n) for n, c in fields(F.col("n"), F.col("s")).items()])
    want = nest_children(parent, "k", {"c": (rendered, "id")})
    have = nest_children(parent, "k", {"c": (child, "id", lambda x: fields(x["n"], x["s"]))})
    assert have.schema["c"].dataType.simpleString() == want.schema["c"].dataType.simpleString()
    assert sorted(map(str, have.collect())) == sorted(map(str, want.collect()))


def test_no_rendered_text_is_shuffled(spark, sf_dir):
    """Article and change texts are made above the last exchange of their rows."""
    plan = render_incident_details(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    made = [i for i, line in enumerate(lines) if "How to handle" in line or "Change by" in line]
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert made and max(made) < first_join


def test_list_items_are_the_heads_of_the_documents(spark, sf_dir):
    names = [f.name for f in schemas.INCIDENT_LIST_ITEM.fields]
    rows, shape = incident_items(spark, sf_dir)
    have = rows.select(shape(F.struct("*")).alias("i")).select("i.*")
    want = render_incident_details(spark, sf_dir).select(*names)
    assert have.columns == names and [f.dataType.simpleString() for f in have.schema] == [f.dataType.simpleString() for f in want.schema]
    assert have.exceptAll(want).count() == 0 and have.count() == want.count()
