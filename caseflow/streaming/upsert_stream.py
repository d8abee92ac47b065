"""Streaming A12: newly landed update files merged into the keyed table per micro-batch.

``readStream`` over the landing folder (explicit schema) -> per-batch
pre-aggregation to one row per key (newest wins) -> ``foreachBatch`` merge
into a versioned Parquet table.  The checkpoint location lives under the
session's shared ``spark.checkpoint.dir``, so a restarted query resumes
after the last committed batch; a replayed batch that the table's newest
version holds is skipped, and a new checkpoint goes on from that version.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators.upsert import merge_into


def latest_per_key(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str]) -> DataFrame:
    """One row per key: the values of the newest row (``max_by``; ties by the values themselves)."""
    ordering = F.struct(F.col(order_col), *[F.col(c) for c in value_cols if c != order_col])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in value_cols]), ordering).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in value_cols])


def start_upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table_root: str,
                        checkpoint: str, keys: list[str], order_col: str, value_cols: list[str],
                        prepare=None, max_files_per_trigger: int = 1, available_now: bool = True):
    """Start the streaming merge; returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger) \
        .parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)

    source = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        upd = latest_per_key(batch, keys, order_col, value_cols)
        merge_into(batch.sparkSession, table_root, upd, keys, batch_id, order_col=order_col, source=source)

    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
