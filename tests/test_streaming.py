"""Streaming A12: a restarted query resumes from its checkpoint and the table ends in the
same state as one batch merge over all files (newest value per key wins)."""

from pyspark.sql import functions as F

from caseflow.operators.upsert import merge_into, read_current
from caseflow.sources import landing as LD
from caseflow.sources.domain import TicketModel
from caseflow.streaming.upsert_stream import latest_per_key, start_upsert_stream

VALUES = ["ts", "event_type", "value", "props"]


def test_stream_resumes_after_restart(spark, sf_dir):
    ev = TicketModel(spark, sf_dir).raw("events").withColumn("day", F.to_date("ts"))
    days = sorted(r.day for r in ev.select("day").distinct().collect())
    cut = days[len(days) // 2]
    root = LD.work_dir(spark, "stream-test")
    src, table, ckpt = f"{root}/incoming", f"{root}/table", f"{root}/_ckpt"
    schema = ev.schema
    ev.where(F.col("day") < F.lit(cut)).write.partitionBy("day").parquet(src)
    start_upsert_stream(spark, src, schema, table, ckpt, ["user_id"], "ts", VALUES).awaitTermination()
    first = read_current(spark, table, latest_per_key(ev, ["user_id"], "ts", VALUES).schema).count()
    assert first > 0
    # more files arrive; the restarted query processes only the new ones
    ev.where(F.col("day") >= F.lit(cut)).write.mode("append").partitionBy("day").parquet(src)
    start_upsert_stream(spark, src, schema, table, ckpt, ["user_id"], "ts", VALUES).awaitTermination()
    expected = latest_per_key(ev.drop("day"), ["user_id"], "ts", VALUES)
    got = read_current(spark, table, expected.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_new_checkpoint_goes_on_from_the_table_and_replays_are_skipped(spark):
    root = LD.work_dir(spark, "stream-test")
    src, table = f"{root}/incoming", f"{root}/table"
    schema = "k long, ts timestamp_ntz, v string"

    def land(k, day):
        spark.sql(f"SELECT CAST({k} AS BIGINT) AS k, TIMESTAMP_NTZ'2026-01-{day:02d}' AS ts, 'v{k}' AS v") \
            .write.mode("append").parquet(src)

    def keys(checkpoint):
        start_upsert_stream(spark, src, spark.createDataFrame([], schema).schema, table, f"{root}/{checkpoint}", ["k"],
                            "ts", ["ts", "v"]).awaitTermination()
        return sorted(r.k for r in read_current(spark, table, spark.createDataFrame([], schema).schema).collect())

    for i in (1, 2, 3):
        land(i, i)
        assert keys("one") == list(range(1, i + 1))
    land(99, 9)
    assert keys("two") == [1, 2, 3, 99]
    up = spark.createDataFrame([(5, None, "five")], schema)
    first = merge_into(spark, table, up, ["k"], 7, source="s")
    assert merge_into(spark, table, up, ["k"], 7, source="s") == first
