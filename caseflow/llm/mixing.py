"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of equal-token slots.  Golden-ratio points, mapped through
the cumulative target shares, name each slot's source; a slot's rank among
those of its source names the block it gets: the source's documents in a
hashed order, laid end to end and repeated up to ``MAX_EPOCHS`` times, cut
into blocks of equal token counts.  Positions come from a two-level prefix
sum (buckets, then rows of a bucket), so no source passes through one task.
Each source is then settled against its own target, to the word: its last
block is cut there, slots beyond it stay empty, and blocks that the schedule
has no slot for (all of a source whose target is below a slot) follow the last
slot.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caseflow.llm.common import small_batches, write_once

MAX_EPOCHS = 3
BASE_WEIGHTS = (5, 2, 1)
#: Most words in a block; smaller mixes take the 65,536th part of all words.
BLOCK_WORDS = 1_000_000
#: Rows of one bucket of a source, about.
BUCKET_ROWS = 4096
#: Sources one mix may hold; their totals are read by the driver.
MAX_SOURCES = 100_000
CHUNK = 65_536
GOLDEN = (math.sqrt(5) - 1) / 2


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (long); a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.size(F.array_remove(parts, "")).cast("long")


def count_words(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, th, size) of each row; a null text has no words."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.xxhash64(F.col(text)).alias("th"), word_count(F.col(text)).alias("size"))


def spread_targets(sizes: list[int], weights: list[float], max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Share ``sum(sizes)`` by weight; no target above ``max_epochs`` times its size, the excess reshared."""
    target, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_ and left > 0:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * unit >= max_epochs * sizes[i]}
        for i in full or open_:
            target[i] = float(max_epochs * sizes[i]) if full else weights[i] * unit
        if not full:
            break
        left -= sum(target[i] for i in full)
        open_ -= full
    return target


@dataclass
class Plan:
    """What the driver knows of a mix: totals of each source, block size, number of slots."""

    sources: list[str | None]
    sizes: list[int]
    rows: list[int]
    targets: list[float]
    block: int
    slots: int

    def quotas(self) -> list[int]:
        """Words each source gives: its target in whole words, what rounding leaves to the largest fractions."""
        out = [math.floor(t + 1e-6) for t in self.targets]
        left = round(sum(self.targets)) - sum(out)
        for i in sorted(range(len(out)), key=lambda i: (out[i] - self.targets[i], i)):
            if left > 0 and out[i] < MAX_EPOCHS * self.sizes[i]:
                out[i] += 1
                left -= 1
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per source, a bounded table: its totals, target, words to give and number of buckets."""
        rows = [(s, z, t, q, max(1, math.ceil(n / BUCKET_ROWS)), i) for i, (s, z, n, t, q) in
                enumerate(zip(self.sources, self.sizes, self.rows, self.targets, self.quotas()))]
        return spark.createDataFrame(
            rows, "source string, source_size long, target double, quota long, buckets int, k int")


def plan_mix(sized: DataFrame, block_words: int = BLOCK_WORDS) -> Plan:
    """Totals and targets; sources by code point, null last, weigh 5, 2, 1 and so on."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")) \
        .limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in rows]
    total = sum(sizes)
    block = max(1, min(block_words, total // CHUNK))
    weights = [BASE_WEIGHTS[i % len(BASE_WEIGHTS)] for i in range(len(rows))]
    return Plan([r.source for r in rows], sizes, [r.n for r in rows], spread_targets(sizes, weights), block,
                math.ceil(total / block))


def slot_schedule(spark: SparkSession, plan: Plan) -> DataFrame:
    """(slot, k, rank): the source k of each slot, and how many earlier slots it has."""
    total = sum(plan.targets)
    edges = np.cumsum(plan.targets) / total if total else np.zeros(0)
    if len(edges):
        edges[np.flatnonzero(plan.targets)[-1]:] = 1.0
    n, slots = max(1, math.ceil(plan.slots / CHUNK)), plan.slots

    def deal(batches):
        for b in batches:
            for c in b.column(0).to_pylist():
                slot = np.arange(c * CHUNK, min(slots, (c + 1) * CHUNK), dtype=np.int64)
                k = np.searchsorted(edges, (slot + 0.5) * GOLDEN % 1.0, side="right")
                order = np.argsort(k, kind="stable")
                first = np.searchsorted(k[order], k[order])
                rank = np.empty(len(k), np.int64)
                rank[order] = np.arange(len(k)) - first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (slot, np.full(len(k), c), k, rank)],
                    names=["slot", "chunk", "k", "rank"])

    if not plan.slots:
        return spark.createDataFrame([], "slot long, k long, rank long")
    dealt = spark.range(n).repartition(min(n, 1000)).mapInArrow(deal, "slot long, chunk long, k long, rank long")
    if n == 1:
        return dealt.select("slot", "k", "rank")
    before = dealt.groupBy("k", "chunk").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("k").orderBy("chunk")) - F.col("n"))
    return dealt.join(before, ["k", "chunk"]).select("slot", "k", (F.col("rank") + F.col("before")).alias("rank"))


def settled_slots(spark: SparkSession, plan: Plan) -> DataFrame:
    """(slot, k, rank) of every block that a source gives: scheduled ones, and those without a slot after them."""
    schedule = slot_schedule(spark, plan)
    blocks = [math.ceil(q / plan.block) for q in plan.quotas()]
    got = dict(schedule.groupBy("k").agg(F.count(F.lit(1))).collect())  # a row per source, like the plan
    missing = sorted((rank, (k + 0.5) * GOLDEN % 1.0, k) for k, n in enumerate(blocks) for rank in range(got.get(k, 0), n))
    most = spark.createDataFrame([*enumerate(blocks)], "k long, blocks long")
    after = spark.createDataFrame([(plan.slots + i, k, rank) for i, (rank, _, k) in enumerate(missing)],
                                  "slot long, k long, rank long")
    return schedule.join(F.broadcast(most), "k").where("rank < blocks").select("slot", "k", "rank").unionByName(after)


def place(rows: DataFrame, plan: Plan, seed: int = 0) -> DataFrame:
    """``rows`` (source, doc_id, th, size and more) with k, bucket, rn and start, the words of its source before it."""
    sources = plan.table(rows.sparkSession).withColumnRenamed("source", "s_")
    h = F.xxhash64(F.lit(seed), "doc_id", "th")
    keyed = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("s_"))).drop("s_") \
        .withColumn("h", h).withColumn("bucket", F.pmod("h", F.col("buckets")).cast("int"))
    sums = keyed.groupBy("k", "bucket").agg(F.sum("size").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("k").orderBy("bucket")) - F.col("n")) \
        .drop("n")
    w = Window.partitionBy("k", "bucket").orderBy("h", "doc_id", "th", "size")
    return keyed.withColumns({"rn": F.row_number().over(w),
                              "run": F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0))}) \
        .join(before, ["k", "bucket"]) \
        .withColumn("start", F.col("before") + F.col("run") - F.col("size")).drop("before", "run", "h")


def block_pieces(placed: DataFrame, plan: Plan) -> DataFrame:
    """Each document's part in each block: (k, rank, epoch, from_word, n_words) beside its own columns."""
    size, n = F.col("size"), F.lit(plan.block)
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    out = placed.where("size > 0") \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1)))) \
        .withColumn("begin", begin.cast("long")).where("begin < quota") \
        .withColumn("end", F.least(F.col("begin") + size, F.col("quota"))) \
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("begin") / n), F.floor((F.col("end") - 1) / n))))
    low, high = F.greatest("begin", F.col("rank") * n), F.least("end", (F.col("rank") + 1) * n)
    return out.withColumns({"from_word": low - F.col("begin"), "n_words": high - low}).drop("begin", "end")


def mix_slots(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
              seed: int = 0, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, Plan]:
    """(documents with their places, mixed pieces, plan).

    A piece is (slot, k, doc_id, epoch, from_word, n_words): slot gives the
    order of the mix.  Null and wordless texts get places and no piece.  A null
    source is a source.  Rows that repeat are rows of their own.  An empty
    table gives no slots.  The blocks of a source join its slots on (source,
    rank), a key that holds one block, so no hot key arises.
    """
    sized = write_once(count_words(docs, doc_id, text, source), "mix-sizes")
    plan = plan_mix(sized, block_words)
    placed = write_once(place(sized, plan, seed), "mix-places")
    pieces = block_pieces(placed, plan).join(settled_slots(docs.sparkSession, plan), ["k", "rank"])
    return placed, pieces, plan


def mix_report(docs: DataFrame, **columns: str) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot, first_offset) of each row of ``docs``.

    first_slot and first_offset say where in the mix a document begins: the
    slot that the schedule gives its first block, and the words of that block
    before it; null for a document that isn't taken.
    """
    placed, pieces, plan = mix_slots(docs, **columns)
    cols = ["k", "bucket", "rn", "doc_id", "size", "source_size", "target"]
    begin = F.pmod(F.col("epoch") * F.col("source_size") + F.col("start") + F.col("from_word"), F.lit(plan.block))
    both = placed.select(*cols, F.lit(0).cast("long").alias("taken"),
                         F.lit(None).cast("struct<first_slot:long,first_offset:long>").alias("at")) \
        .unionByName(pieces.select(*cols, F.col("n_words").cast("long").alias("taken"), F.struct(
            F.col("slot").alias("first_slot"), begin.cast("long").alias("first_offset")).alias("at")))
    return both.groupBy(*cols).agg(F.sum("taken").alias("taken"), F.min("at").alias("at")) \
        .select("doc_id", F.col("size"), "source_size", "target", "taken", "at.first_slot", "at.first_offset")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word; null where text is null."""
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def cut(t: str | None, k: int) -> str | None:
        if t is None:
            return None
        for i, m in enumerate(word.finditer(t), 1):
            if i == k:
                return t[:m.end()]
        return t

    @pandas_udf("string")
    def prefix(ts: pd.Series, ks: pd.Series) -> pd.Series:
        return pd.Series([cut(t, k) for t, k in zip(ts, ks)], dtype=object)

    return prefix(text, n)


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mix holds it: a row for each time a document is taken, in the order of the schedule.

    A row comes with the slot of the block it begins in, after what that block
    holds before it; rows are range-partitioned by slot and sorted, so a table
    written from them follows the schedule from file to file, and any first
    part of it holds the sources by their targets.  Each source gives its
    target in whole words, so it ends within one document, whose text is cut
    after the last word taken.  Null and wordless texts aren't taken; a null
    source is a source, repeated rows are rows of their own, an empty table
    gives no rows.  Returns the columns of ``docs``.
    """
    spark = docs.sparkSession
    plan = plan_mix(count_words(docs, doc_id, text, source), block_words)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(doc_id).alias("doc_id"),
                       F.col(source).cast("string").alias("source"), F.xxhash64(F.col(text)).alias("th"),
                       word_count(F.col(text)).alias("size")).where("size > 0")
    placed = place(rows, plan, seed)
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    out = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1)))) \
        .withColumn("begin", begin.cast("long")) \
        .withColumn("take", F.least(F.col("quota") - F.col("begin"), F.col("size"))).where("take > 0") \
        .withColumn("rank", F.floor(F.col("begin") / F.lit(plan.block)))
    slots = write_once(settled_slots(spark, plan), "mix-slots")
    ordered = out.join(slots, ["k", "rank"]).repartitionByRange("slot", "begin").sortWithinPartitions("slot", "begin")
    whole = F.col("take") == F.col("size")
    body = F.col("row")[text]
    cut = F.when(whole, body).otherwise(first_words(F.when(~whole, body), F.col("take").cast("long")))
    return ordered.withColumn("cut", cut).select(*[
        F.col("cut").alias(c) if c == text else F.length("cut").cast("long").alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c) for c in names])
