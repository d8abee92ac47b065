"""Raw landing layer.

Landed data are JSON documents: page envelopes (F1) for list endpoints and one
detail document (F3) per incident.  Landing is re-aimed from a serial driver
loop to Spark jobs:

* ``land_paged_collection`` fetches pages in parallel with ``mapInPandas`` and a
  pluggable fetcher: page 1 of each dataset first (it reports total_pages),
  then pages 2..n fan out across tasks;
* writes are Spark writers partitioned by ``load_date`` (JSON Lines part files),
  so a 100 TB landing never funnels through one process.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow import schemas
from caseflow.session import FREED, freed, settings
from caseflow.sources.domain import INCIDENT_URL_PREFIX


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    from caseflow.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "caseflow-work", f"{name}-{uuid.uuid4().hex[:12]}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in exactly ``schema`` (names, nesting), as a round trip through JSON text gives it.

    Fields are matched by name at every level; what is missing is null, and so
    is a number that its type can't hold.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_shaped(F.col(f.name), have[f.name], f.dataType).alias(f.name) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _shaped(col: F.Column, have: T.DataType, want: T.DataType) -> F.Column:
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(_shaped(col[f.name], own[f.name], f.dataType) if f.name in own
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: _shaped(x, have.elementType, want.elementType))
    if have == want:
        return col
    if isinstance(have, (T.NullType, T.NumericType, T.BooleanType)):
        return col.try_cast(want)
    # dates and the like are written as JSON writes them
    return F.from_json(F.to_json(F.struct(col.alias("v"))), T.StructType([T.StructField("v", want)]))["v"]


# ---- A2 -----------------------------------------------------------------------------------

def json_rows_to_df(df: DataFrame, text_col: str, schema: T.StructType) -> DataFrame:
    """A2: JSON text column -> typed rows with an explicit schema (no driver-side list)."""
    return df.select(F.from_json(F.col(text_col), schema).alias("_j")).select("_j.*")


# ---- A3 / A4: parallel landing with a pluggable fetcher -------------------------------------

#: Documents of a packed file, at most: one task reads a packed file.
FILE_DOCUMENTS = 20_000

Fetcher = Callable[[str, int, int], dict]


def land_paged_collection(spark: SparkSession, datasets: list[str], fetch: Fetcher, root: str,
                          load_date: str, page_size: int = 50) -> DataFrame:
    """A3 re-aimed: fetch every page of every dataset in parallel and land the envelopes.

    Walk rule: pages 1..total_pages, stopping early at an empty page.  Page 1 is
    fetched first (it carries total_pages); the remaining page numbers are
    generated with ``sequence`` and fetched by ``mapInPandas`` tasks.  Returns
    the landed envelopes as (dataset, page, load_date, payload) rows.
    """
    out_schema = "dataset string, page int, payload string"

    def fetch_batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(d, int(p), json.dumps(fetch(d, int(p), page_size)))
                    for d, p in zip(pdf["dataset"], pdf["page"])]
            yield pd.DataFrame(rows, columns=["dataset", "page", "payload"])

    from caseflow.session import materialize
    # page 1 and the rest are each materialised before anything reads them twice: one fetch per page
    first = materialize(spark.createDataFrame([(d, 1) for d in datasets], "dataset string, page int")
                        .mapInPandas(fetch_batches, out_schema))
    totals = first.select("dataset", F.get_json_object("payload", "$.pagination.total_pages")
                          .cast("int").alias("total_pages"))
    rest = totals.where(F.col("total_pages") > 1).select(
        "dataset", F.explode(F.sequence(F.lit(2), F.col("total_pages"))).alias("page")) \
        .repartition("dataset", "page").mapInPandas(fetch_batches, out_schema)
    rest = materialize(rest)  # two readers follow: the item counts and the first empty page
    pages = first.unionByName(rest).withColumn(
        "item_count", F.coalesce(F.json_array_length(F.get_json_object("payload", "$.items")), F.lit(0)))
    # An empty page ends the walk: drop it and everything after it.
    first_empty = pages.where(F.col("item_count") == 0).groupBy("dataset").agg(F.min("page").alias("_stop"))
    pages = pages.join(first_empty, "dataset", "left") \
        .where(F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))).drop("_stop")
    pages = materialize(pages.withColumn("load_date", F.lit(load_date)))
    pages.select("dataset", "load_date", "page", "payload").write.mode("append") \
        .partitionBy("dataset", "load_date").json(os.path.join(root, "_pages"))
    return pages


def land_details(details: DataFrame, root: str, dataset: str, load_date: str | F.Column,
                 compression: str | None = None) -> str:
    """A4: one detail document per entity, appended under ``<root>/<dataset>/detail/load_date=D``.

    ``load_date`` is one date, or a column where rows are of a few loads.
    Ids containing '/' are stored with '_' (``entity_key``).  ``compression``
    (such as gzip) packs the files, ``FILE_DOCUMENTS`` documents each at most."""
    path = os.path.join(root, dataset, "detail")
    rows = details.withColumn("entity_key", F.regexp_replace(F.col("id"), "/", "_")) \
        .withColumn("load_date", F.lit(load_date) if isinstance(load_date, str) else load_date)
    with settings(details.sparkSession, DOCUMENT_SETTINGS | FREED):
        rows.write.mode("append").option("compression", compression or "none") \
            .option("maxRecordsPerFile", FILE_DOCUMENTS if compression else 0).partitionBy("load_date").json(path)
    return path


#: While documents are written: a task may hold files of 8 loads open, so that whole documents aren't sorted by load;
#: and it gets 16 MB of shuffled rows, as documents are several times what they are made of.
DOCUMENT_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "8",
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def land_list_pages(items: DataFrame, root: str, dataset: str, load_date: str, key_col: str,
                    page_size: int = 50, compression: str | None = None,
                    shape: Callable[[F.Column], F.Column] | None = None) -> str:
    """Cut list items, in key order, into full page envelopes of ``page_size`` and land them.

    ``shape`` makes a landed item of a struct of the columns of ``items``
    (``key_col`` is one of them), so narrow columns alone are dealt.

    Items are dealt by ranges of the key, sorted and numbered in their range as
    they are written; a row's number is the number of rows in the ranges before
    plus its place in its range, so no task sorts or numbers all items.  Keys
    of any type, with gaps or ties.
    """
    path = os.path.join(root, dataset, "list")
    dealt = items.select(F.struct(*items.columns).alias("item"), F.col(key_col).alias("_key")) \
        .repartitionByRange("_key").sortWithinPartitions("_key") \
        .select("item", F.monotonically_increasing_id().alias("_at"))
    # Written once, so that counts and numbers see the same deal; the id has the range above 33 bits of place.
    stash = work_dir(items.sparkSession, "dealt")
    with freed(items.sparkSession):
        dealt.write.option("compression", "zstd").parquet(stash)
    dealt = items.sparkSession.read.schema(dealt.schema).parquet(stash) \
        .select("item", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(2 ** 33 - 1).alias("_place"))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
    with freed(items.sparkSession):
        total = int(sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
    place = F.col("_place") + F.col("_before")
    env = dealt.join(before, "_part").withColumn("_page", F.floor(place / page_size).cast("int") + 1) \
        .groupBy("_page").agg(F.collect_list("item").alias("items"))
    if shape is not None:
        env = env.withColumn("items", F.transform("items", shape))
    env = env.select(
        F.struct(F.col("_page").alias("page"), F.lit(page_size).alias("page_size"),
                 F.lit(total).alias("total_items"), F.lit(-(-total // page_size)).alias("total_pages"))
        .alias("pagination"),
        "items", F.col("_page").alias("page_number"))
    with freed(items.sparkSession):
        env.withColumn("load_date", F.lit(load_date)).write.mode("append").option("compression", compression or "none") \
            .option("maxRecordsPerFile", FILE_DOCUMENTS // page_size + 1 if compression else 0) \
            .partitionBy("load_date").json(path)
    remove(items.sparkSession, stash)
    return path


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# ---- A1 / A10 -------------------------------------------------------------------------------

def read_landed_json(spark: SparkSession, path: str, schema: T.StructType,
                     load_date: str | None = None, multi_line: bool = False) -> DataFrame:
    """A1: read landed JSON with an explicit schema; keep the file path and load date.

    The directory is read as a partitioned root, so a ``load_date`` filter
    prunes partitions instead of scanning every load.
    """
    full = T.StructType(schema.fields + [T.StructField("load_date", T.StringType(), True)])
    df = spark.read.schema(full).option("multiLine", multi_line).json(path) \
        .withColumn("source_file", F.col("_metadata.file_path"))
    if load_date is not None:
        df = df.where(F.col("load_date") == load_date)
    return df


def landed_files(spark: SparkSession, path: str, load_date: str) -> DataFrame:
    """A10: files of one load date, sorted (names only; contents are not read)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.json{,.gz}") \
        .load(os.path.join(path, f"load_date={load_date}"))
    return df.select(F.col("path").alias("landed_path"), "length").orderBy("landed_path")


# ---- A5 / A13 / A15 -------------------------------------------------------------------------

def manifest_for_pages(pages: DataFrame, dataset: str, endpoint: str,
                       extracted_at: str | None = None) -> DataFrame:
    """A5: one ledger row per landed page envelope."""
    extracted_at = extracted_at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return pages.select(
        F.lit(dataset).alias("dataset_name"), F.lit("page").alias("record_type"), F.lit(endpoint).alias("endpoint"),
        F.col("pagination.page").alias("page_number"), F.lit(None).cast("string").alias("entity_id"),
        F.size("items").cast("int").alias("item_count"), F.col("source_file").alias("landed_path"),
        F.lit(extracted_at).alias("extracted_at_utc"), F.current_timestamp().alias("landed_at_utc"),
        F.col("pagination.total_items").cast("bigint").alias("total_reported"))


def manifest_for_details(details: DataFrame, dataset: str, endpoint: str,
                         extracted_at: str | None = None) -> DataFrame:
    """A5: one ledger row per landed detail document."""
    extracted_at = extracted_at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return details.select(
        F.lit(dataset).alias("dataset_name"), F.lit("detail").alias("record_type"),
        F.concat(F.lit(endpoint + "/"), F.col("id")).alias("endpoint"), F.lit(None).cast("int").alias("page_number"),
        F.col("id").alias("entity_id"), F.lit(1).alias("item_count"), F.col("source_file").alias("landed_path"),
        F.lit(extracted_at).alias("extracted_at_utc"), F.current_timestamp().alias("landed_at_utc"))


def append_manifest(manifest: DataFrame, path: str) -> None:
    """A5: append-only ledger (schema merges on read with mergeSchema)."""
    manifest.write.mode("append").option("mergeSchema", "true").parquet(path)


def field_inventory(spark: SparkSession, schema_by_endpoint: dict[str, T.StructType]) -> DataFrame:
    """(endpoint, field_name) sorted; the rows come from schemas, which are small."""
    rows = [(ep, f.name) for ep, s in schema_by_endpoint.items() for f in s.fields]
    return spark.createDataFrame(rows, "endpoint string, field_name string").orderBy("endpoint", "field_name")


def endpoint_summary(manifest: DataFrame) -> DataFrame:
    """Per dataset: records returned, files landed, total reported by the source, status, note.

    One aggregation: the reported total travels on each manifest row.
    """
    total = F.max("total_reported") if "total_reported" in manifest.columns else F.sum("item_count")
    s = manifest.groupBy("dataset_name").agg(
        F.sum("item_count").cast("bigint").alias("records_returned"),
        F.count(F.lit(1)).cast("bigint").alias("files_landed"),
        total.cast("bigint").alias("total_reported"))
    return s.withColumn("status", F.when(F.col("records_returned") > 0, "ok").otherwise("empty")) \
        .withColumn("note", F.when(F.col("records_returned") != F.col("total_reported"),
                                   F.lit("returned differs from reported total")).otherwise(F.lit("")))


def incident_url(id_col) -> F.Column:
    return F.concat(F.lit(INCIDENT_URL_PREFIX), id_col)


__all__ = ["conform", "land_details", "land_list_pages", "read_landed_json",
           "landed_files", "manifest_for_pages", "manifest_for_details", "append_manifest",
           "field_inventory", "endpoint_summary", "json_rows_to_df", "land_paged_collection", "work_dir"]
