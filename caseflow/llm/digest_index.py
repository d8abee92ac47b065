"""Exact dedup against a minimal perfect hash of the digests seen before.

A text is known by the SHA-256 of its normalised form.  The distinct digests of
the history are dealt by hash into shards of bounded size; each shard is a
minimal perfect hash (levels of bit planes: a digest belongs to the first plane
in which it was alone at its place, and the rank of that bit is its slot) whose
slots hold the full digest and the locator of the row that stays.  New digests,
grouped first so that a frequent text is one row, look up their slot and are
compared with its digest byte by byte: members are repeats of a historical row,
nonmembers are groups of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import join_hot, mix64, write_once

#: Digests of a shard, about.
SHARD_DIGESTS = 1 << 16
#: Places in a plane for each digest that has none yet.
SPARE = 2.0
DIGEST_BYTES = 32
_P = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> Column:
    """The text, null as empty, with one space for each run of blanks."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest, as four 64-bit words, in the plane of a level."""
    h = mix64(np.full(len(keys), level + 1, np.uint64) * _P)
    for i in range(keys.shape[1]):
        h = mix64(h ^ keys[:, i])
    return (h % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes of the planes, their bits as booleans, slot of each key) for distinct keys."""
    sizes, planes, at = [], [], np.zeros(len(keys), np.int64)
    left, before = np.arange(len(keys)), 0
    while len(left):
        size = max(8, 8 * math.ceil(SPARE * len(left) / 8))
        place = _places(keys[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        own = alone[place]
        at[left[own]] = before + place[own]
        left = left[~own]
        sizes.append(size)
        planes.append(alone)
        before += size
    bits = np.concatenate(planes) if planes else np.zeros(0, bool)
    return sizes, bits, np.cumsum(bits)[at] - 1 if len(keys) else at


def find_slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key; a key that wasn't built in has some slot, or -1."""
    out, left, before, rank = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0, np.cumsum(bits)
    for level, size in enumerate(sizes):
        place = before + _places(keys[left], level, size)
        own = bits[place]
        out[left[own]] = rank[place[own]] - 1
        left = left[~own]
        before += size
    return out


def _words(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, DIGEST_BYTES // 8)


def digest_groups(rows: DataFrame) -> DataFrame:
    """(digest, keep, n): the row of least id, the first of equal ids, and the number of rows, for each digest.

    ``rows`` has row, doc_id and digest; ``keep`` is a locator (unknown, doc_id,
    row), so null ids come after all others.
    """
    locator = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    return rows.groupBy("digest").agg(F.min(locator).alias("keep"), F.count(F.lit(1)).alias("n"))


def _shard(digest: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """One row for each shard of the distinct digests in ``groups`` (digest, keep)."""
    key = groups.schema["keep"].dataType["doc_id"].dataType.simpleString()

    def build(table: pa.Table) -> pa.Table:
        digests = table.column("digest").to_pylist()
        sizes, bits, slot = build_hash(_words(table.column("digest")))
        order = np.argsort(slot)
        return pa.Table.from_arrays(
            [table.column("shard").slice(0, 1), pa.array([sizes], pa.list_(pa.int32())),
             pa.array([np.packbits(bits).tobytes()], pa.binary()),
             pa.array([b"".join(digests[i] for i in order)], pa.binary()),
             *(pa.array([table.column(c).take(pa.array(order)).to_pylist()], pa.list_(table.schema.field(c).type))
               for c in ("id", "row"))], names=["shard", "planes", "bits", "digests", "ids", "rows"])

    return groups.select(_shard("digest", shards).alias("shard"), "digest", F.col("keep.doc_id").alias("id"),
                         F.col("keep.row").alias("row")).groupBy("shard").applyInArrow(
        build, f"shard int, planes array<int>, bits binary, digests binary, ids array<{key}>, rows array<long>")


def look_up(groups: DataFrame, index: DataFrame, shards: int, parts: int = 1) -> DataFrame:
    """(digest, member, keep_id, keep_row) for each distinct digest of ``groups``.

    ``parts`` deals a shard's queries to so many tasks, where there are many
    more of them than digests in the index.
    """
    key = index.schema["ids"].dataType.elementType.simpleString()

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = _words(left.column("digest"))
        member = np.zeros(len(asked), bool)
        slot = np.full(len(asked), -1, np.int64)
        if right.num_rows and len(asked):
            held = right.slice(0, 1).to_pylist()[0]
            full = np.frombuffer(held["digests"], "<u8").reshape(-1, DIGEST_BYTES // 8)
            bits = np.unpackbits(np.frombuffer(held["bits"], np.uint8)).astype(bool)
            slot = find_slots(asked, held["planes"], bits)
            member = (slot >= 0) & (full[slot] == asked).all(axis=1)
            ids, rows = ([held[c][s] if m else None for s, m in zip(slot.tolist(), member.tolist())]
                         for c in ("ids", "rows"))
        else:
            ids = rows = [None] * len(asked)
        types = right.schema.field("ids").type.value_type
        return pa.Table.from_arrays(
            [left.column("digest"), pa.array(member), pa.array(ids, types), pa.array(rows, pa.int64())],
            names=["digest", "member", "keep_id", "keep_row"])

    part = F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(parts)).cast("int")
    asked = groups.select(_shard("digest", shards).alias("shard"), part.alias("part"), "digest")
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return asked.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(
        look, f"digest binary, member boolean, keep_id {key}, keep_row long")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", history: float = 0.5) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) of each row of ``docs``.

    Rows with the least ids, a share of about ``history``, are the history whose
    digests are indexed; the others are looked up.  Of equal texts (null as
    empty, a run of blanks as one space) the row of least id stays, a null id
    after all others, and the first of rows that repeat id and text; group_size
    counts all of them.  An empty table gives no rows.  ``row`` numbers the rows
    of this run.  Texts are compared by SHA-256.
    """
    rows = write_once(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest")), "digest-rows")
    known = rows.agg(F.percentile_approx("doc_id", history).alias("edge"), F.count(F.lit(1)).alias("n")).first()
    old = F.coalesce(F.col("doc_id") <= F.lit(known.edge), F.lit(False)) if known.edge is not None else F.lit(False)
    past = write_once(digest_groups(rows.where(old)), "digest-past")
    fresh = write_once(digest_groups(rows.where(~old)), "digest-fresh")
    n_past, n_fresh = past.count(), fresh.count()
    shards = max(1, math.ceil(n_past / SHARD_DIGESTS))
    index = write_once(build_index(past, shards), "digest-index")
    found = look_up(fresh, index, shards, max(1, math.ceil(n_fresh / (shards * SHARD_DIGESTS))))
    found = write_once(fresh.join(found, "digest"), "digest-found")

    repeats = found.where("member").select("digest", F.col("n").alias("more"))
    groups = past.join(repeats, "digest", "left").select(
        "digest", "keep", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")) \
        .unionByName(found.where("not member").select("digest", "keep", "n"))
    groups = write_once(groups.select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"),
                                      F.col("n").alias("group_size")), "digest-groups")
    return join_hot(rows, groups, "digest", "group_size", known.n).select(
        "row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB's words for it.
ORACLE = """
WITH h AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM h
"""
