"""Best-fit packing by the sum-of-squares rule.

Pieces are placed one after another, longest first.  For each piece, of all
open bins it fits the one is taken that makes the sum over residual gaps of
the squared number of open bins with that gap smallest; a new bin is opened
where it fits none (letting a new bin compete leaves some 1.6 % more bins).
Only the number of bins per gap matters, so a step costs at most ``capacity``
additions.  Pieces are dealt by hash into groups of bounded size; each group
is packed by itself.  A piece of ``capacity`` ids is a sequence of its own and
goes to no group.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm import tokens
from caseflow.llm.common import sliced, small_batches, write_once

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Pieces of one group, about; a group is packed in one task.
GROUP_PIECES = 16_384
_NONE = np.iinfo(np.int64).max


def sum_of_squares_pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first, under the sum-of-squares rule.

    Between equal sums the smallest gap wins; between bins of one gap the one
    opened or changed last.  A length of ``capacity`` gets a bin of its own.
    """
    n_open = np.zeros(capacity + 1, np.int64)  # open bins by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size, gap = int(lengths[i]), capacity
        if size < capacity:
            # change of the sum for each gap g from size on: N(g) falls by one, N(g - size) rises by one
            change = 2 * (n_open[:capacity - size] - n_open[size:capacity]) + 2
            change[0] = 1 - 2 * n_open[size]  # a full bin has no gap to count
            change[n_open[size:capacity] == 0] = _NONE
            at = int(np.argmin(change))
            if change[at] != _NONE:
                gap = size + at
        if gap == capacity:
            bin_ = len(used)
            used.append(0)
        else:
            bin_ = by_gap[gap].pop()
            n_open[gap] -= 1
        left = gap - size
        bins[i], offsets[i] = bin_, used[bin_]
        used[bin_] += size
        if left:
            by_gap[left].append(bin_)
            n_open[left] += 1
    return bins, offsets


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, and its ids where asked for.

    A document is its token ids and ``end_id``, so even a null or empty text
    has one id.  A document longer than ``capacity`` is cut into pieces of
    ``capacity`` ids, the first of which takes what is left over.
    """
    small_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]):
        enc = tokens.encoder(tokenizer)
        for b in sliced(batches):
            rows = []
            flat, bounds = enc.encode_flat(b.column(1))
            data, bounds = flat.tobytes(), (4 * bounds).tolist()
            for key, low, high in zip(b.column(0).to_pylist(), bounds, bounds[1:]):
                ids = data[low:high] + end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                edges = [0, *range(first, n + 1, capacity)]
                for k, (i, j) in enumerate(zip(edges, edges[1:])):
                    piece = ids[4 * i:4 * j]
                    rows.append((key, k, i, j - i, zlib.crc32(piece), piece if with_ids else None))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (b.column(0).type, pa.int32(), pa.int64(), pa.int64(),
                                                           pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if with_ids else out.drop("ids")


def pack(pieces: DataFrame, n_groups: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` must be from 1 to ``capacity``.

    Groups are dealt by a hash of the piece and of the task it comes from, so
    repeated rows spread too.  sequence_id is the group's number times 2^32
    plus the bin's; a piece of ``capacity`` has a negative one, from
    ``monotonically_increasing_id``.
    """
    whole = pieces.where(F.col("length") == capacity).withColumns({
        "sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    salted = pieces.where(F.col("length") < capacity).withColumn("group", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()), F.lit(n_groups)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", na_position="first")
        bins, offsets = sum_of_squares_pack(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(rows["group"].to_numpy() << 32) + bins, offset=offsets).drop(columns="group")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return salted.groupBy("group").applyInPandas(place, f"{schema}, sequence_id long, offset long").unionByName(whole)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Token pieces of all ``docs`` and their places in sequences of ``capacity`` ids.

    An empty table gives no rows; rows that repeat are packed as often as they
    occur.  The pieces are written once, and the number of groups follows the
    number of those shorter than ``capacity``.
    """
    pieces = write_once(token_pieces(docs, doc_id, text, capacity, end_id, tokenizer, with_ids), "pack-pieces")
    n_groups = max(1, math.ceil(pieces.where(F.col("length") < capacity).count() / GROUP_PIECES))
    return pack(pieces, n_groups, capacity)
