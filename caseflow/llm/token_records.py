"""Token ids in length-delimited binary records, with a separate offset index.

A record is an 8-byte little-endian length, a 4-byte masked checksum of the
length, the serialized sequence, and a 4-byte masked checksum of the sequence.
The checksum is CRC-32 (IEEE), rotated right by 15 bits plus 0xA282EAD8.  A
sequence is a byte that says whether an id follows (1) or the id is null (0),
the id in 8 bytes, and the token ids in ``width`` bytes each.  Beside every
``.rec`` file an ``.idx`` file holds the offset of each record and the end of
the file, 8 bytes each: a reader finds record i, or reads records in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm import tokens
from caseflow.llm.common import read_range, run_folder, sliced, small_batches, write_once

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Bytes of one id; two hold every vocabulary below 65,536.
WIDTH = 2
#: Bytes read at a time.
READ_BYTES = 8 << 20
#: Tasks that read shards, at most.
MAX_READERS = 20_000


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted, so that a checksum over checksums stays sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record: length, its checksum, payload, its checksum."""
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The payload of the record at ``at``; ValueError where a checksum or length is wrong."""
    size = data[at:at + 8]
    n, crc = struct.unpack("<QI", data[at:at + 12])
    payload = data[at + 12:at + 12 + n]
    if masked(size) != crc or len(payload) != n or data[at + 12 + n:at + 16 + n] != struct.pack("<I", masked(payload)):
        raise ValueError(f"damaged record at byte {at}")
    return payload


def serialize(doc_id: int | None, ids: bytes, width: int = WIDTH) -> bytes:
    """A sequence: id flag, id, token ids (given as little-endian 32-bit numbers); ValueError for an id beyond ``width``."""
    return struct.pack("<Bq", doc_id is not None, doc_id or 0) + narrow(np.frombuffer(ids, "<u4"), width)


def narrow(ids: np.ndarray, width: int = WIDTH) -> bytes:
    """Token ids in ``width`` bytes each; ValueError for one that doesn't fit."""
    if width < 4 and len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"token id {ids.max()} doesn't fit {width} bytes")
    return ids.astype(f"<u{width}").tobytes()


def parse(payload: bytes, width: int = WIDTH) -> tuple[int | None, bytes]:
    """(id, token ids as little-endian 32-bit numbers) of a sequence."""
    known, doc_id = struct.unpack("<Bq", payload[:9])
    body = np.frombuffer(payload[9:], f"<u{width}").astype("<u4").tobytes()
    return (doc_id if known else None), body


def read_record(uri: str, i: int, width: int = WIDTH) -> tuple[int | None, bytes]:
    """Record ``i`` of a ``.rec`` file, found through its index."""
    begin, end = struct.unpack("<QQ", read_range(uri.removesuffix(".rec") + ".idx", 8 * i, 16))
    return parse(unframe(read_range(uri, begin, end - begin)), width)


def write_records(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                  tokenizer: str = TOKENIZER, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """Encode every row and write shards in ascending id order; one row per shard written.

    Rows are dealt by ranges of the id and sorted within a range (null ids
    first, equal ids by the hash of the text), so shards in the order of their
    numbers hold all rows in order.  A null text is an empty one; each sequence
    ends with ``end_id``.  A task streams its shard to a file of its own name
    and moves it into place, so a rerun task replaces the file with the same
    bytes.  Returns (shard, uri, records, tokens), read back from the shared
    folder; an empty table gives no shard.
    """
    small_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]):
        enc = tokens.encoder(tokenizer)
        shard, end = TaskContext.get().partitionId(), narrow(np.array([end_id]), width)
        fs, path = pafs.FileSystem.from_uri(folder)
        name, mark = f"{path}/shard-{shard:06d}", uuid.uuid4().hex
        out, offsets, at, total = None, [], 0, 0
        for b in sliced(batches):
            if out is None and b.num_rows:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{name}.rec.{mark}", compression=None)
            flat, edges = enc.encode_flat(b.column(1))
            data, edges = narrow(flat, width), (width * edges).tolist()
            for key, i, j in zip(b.column(0).to_pylist(), edges, edges[1:]):
                record = frame(struct.pack("<Bq", key is not None, key or 0) + data[i:j] + end)
                out.write(record)
                offsets.append(at)
                at += len(record)
            total += len(flat) + b.num_rows
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{name}.idx.{mark}", compression=None) as index:
                index.write(np.array([*offsets, at], "<u8").tobytes())
            fs.move(f"{name}.idx.{mark}", f"{name}.idx")
            fs.move(f"{name}.rec.{mark}", f"{name}.rec")
            yield pa.RecordBatch.from_pydict({"shard": [shard], "uri": [f"{folder}/shard-{shard:06d}.rec"],
                                              "records": [len(offsets)], "tokens": [total]})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return write_once(rows.mapInArrow(write, "shard long, uri string, records long, tokens long"), "token-shards")


def read_records(shards: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record of the given shards, checksums verified.

    ``start`` counts the ids of all records before, over all shards in order.
    """
    def read(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                edges = np.frombuffer(read_range(uri.removesuffix(".rec") + ".idx"), "<u8").astype(np.int64)
                i = 0
                while i < len(edges) - 1:
                    j = max(i + 1, int(np.searchsorted(edges, edges[i] + READ_BYTES, side="right")) - 1)
                    data = read_range(uri, int(edges[i]), int(edges[j] - edges[i]))
                    found = [parse(unframe(data, int(e - edges[i])), width) for e in edges[i:j]]
                    n = np.array([len(ids) // 4 for _, ids in found], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in found], pa.int64()), pa.array(start + np.cumsum(n) - n),
                         pa.array(n), pa.array([ids for _, ids in found], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    start, i = start + int(n.sum()), j

    # one small row per shard; the shards' own rows never meet
    placed = shards.withColumn("start", F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens"))
    # a fixed number of tasks: few small rows stand for large files
    return placed.repartition(max(1, min(shards.count(), MAX_READERS)), "shard").select("uri", "start").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary")


def token_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as records into a new shared folder and read them back."""
    folder = run_folder(docs.sparkSession, "token-records")
    return read_records(write_records(docs, folder, doc_id, text))
