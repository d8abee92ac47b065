"""Table access: the driver's parquet tables, catalog tables, counts and writes.

A9 ``read_table`` (required / optional), A6 and A7 overwrite writers, A8
``qualify_table``, A11 ``table_counts`` and A16 ``preview`` live here.  Paths
and ``spark.table`` calls are confined to this module and ``plans.pipeline``.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, required: bool = True,
               schema: T.StructType | None = None) -> DataFrame:
    """A required table that is missing raises; an optional one is an empty typed frame.

    The Parquet schema is inferred once per path and then passed explicitly, so
    building a plan that reads the same table many times does not re-read
    footers; every call still creates a fresh relation (no shared attributes).
    """
    path = table_path(sf_dir, name)
    if os.path.exists(path) or "://" in path:
        if path not in _SCHEMAS:
            _SCHEMAS[path] = spark.read.parquet(path).schema
        return spark.read.schema(_SCHEMAS[path]).parquet(path)
    if required:
        raise FileNotFoundError(f"required table {name!r} not found at {path}")
    return spark.createDataFrame([], schema or T.StructType([]))


def qualify_table(name: str, database: str | None = None) -> str:
    """Optional database prefix."""
    return f"{database}.{name}" if database else name


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> None:
    """Overwrite with schema replacement (a parquet overwrite rewrites the schema)."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record_count) ordered by name, one Spark job for all tables."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))
          .select(F.lit(name).alias("table_name"), "record_count")
        for name, df in sorted(frames.items())
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First n rows (a limit is the feature here)."""
    return df.limit(n)
