"""WARC archives: written with segmented records, read back and reassembled.

A capture is an HTTP response whose body is in chunked transfer framing.  A
block longer than ``segment_bytes`` is divided: the first segment is the
record itself, the others are ``continuation`` records that name it as their
origin.  The reader groups the segments by the origin's identifier, orders
them by segment number, verifies the total length that the last one states,
and only then decodes the chunked framing.  Captures with equal payloads are
stored once: the others are ``revisit`` records without a body.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import run_folder, small_batches, write_once

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4096
#: Payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 0
#: An archive file is closed when it has more bytes than this.
FILE_BYTES = 256 << 20
#: Tasks that read archive files, at most.
MAX_READERS = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n")


def digest32(data: bytes) -> str:
    """Base32 of the SHA-1 of ``data``, upper case."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        out.append(body[at:at + size])
        if len(out[-1]) != size or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Body of an HTTP response, its transfer framing undone."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("an HTTP head without end")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(text.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def segments(kind: str, fields: dict[str, object], block: bytes, size: int) -> Iterator[bytes]:
    """The records of one block: one, or as many segments as it takes."""
    if len(block) <= size:
        yield record(kind, fields, block)
        return
    parts = [block[i:i + size] for i in range(0, len(block), size)]
    yield record(kind, {**fields, "WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        yield record("continuation", {
            "WARC-Record-ID": f"<{uuid.uuid5(uuid.NAMESPACE_URL, fields['WARC-Record-ID'] + f'#{n}').urn}>",
            "WARC-Segment-Origin-ID": fields["WARC-Record-ID"], "WARC-Segment-Number": n,
            "WARC-Target-URI": fields.get("WARC-Target-URI"),
            "WARC-Segment-Total-Length": len(block) if n == len(parts) else None}, part)


def record_id(name: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>"


def header_value(value: object) -> str:
    """A value on one line: control characters as percent escapes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", str(value))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   segment_bytes: int = SEGMENT_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write every row of ``pages`` as a record; one row (uri) per archive file.

    Rows with equal payloads of ``min_bytes`` or more: the one with the largest
    page_id is the response (null the least; of rows that share the id the one
    of largest url, of repeated rows one), the others revisit it.  A null
    payload is an empty one, a null url is left out, control characters in urls
    are percent-escaped.  An empty table gives no file.  Other columns
    of ``pages`` are not read.

    Who responds is decided by values alone, so it holds whichever way a task's
    rows come when it is run again: a shared payload's response has an
    identifier made of its digest.  First records and continuations go to
    separate files, so that a capture must be put together across files.  A
    task writes to names of its own and moves whole files into place.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")) \
        .withColumn("sha", F.sha1("payload"))
    same = rows.where(F.octet_length("payload") >= min_bytes) \
        .groupBy("sha", "page_id", "url").agg(F.count(F.lit(1)).alias("rows")) \
        .groupBy("sha").agg(F.max(F.struct("page_id", "url", "rows")).alias("top"), F.sum("rows").alias("n")) \
        .where("n > 1").drop("n")
    same = write_once(same, "warc-same")
    top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    joined = rows.join(same, "sha", "left")
    shared, first = F.col("top").isNotNull(), F.coalesce(F.col("top").isNotNull() & top, F.lit(False))
    columns = ["page_id", "url", "payload", "sha"]
    plan = joined.select(*columns, shared.alias("shared"), (~shared | first).alias("response"),
                         (first & (F.col("top.rows") > 1)).alias("repeated"))
    repeats = same.where("top.rows > 1").select("sha", "top")
    if not repeats.isEmpty():
        # rows that repeat the one that responds: one payload of them, summed up where they are read, and a count
        again = rows.join(repeats, "sha").where(top).groupBy("sha", "page_id", "url") \
            .agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("n")) \
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        again = again.select("page_id", "url", F.when(F.col("copy") == 1, F.col("payload")).otherwise(F.lit(b""))
                             .alias("payload"), "sha", F.lit(True).alias("shared"),
                             (F.col("copy") == 1).alias("response"), F.lit(False).alias("repeated"))
        plan = plan.where("not repeated").unionByName(again)

    def write(batches: Iterator[pa.RecordBatch]):
        fs, path = pafs.FileSystem.from_uri(folder)
        files: dict[str, list] = {}  # by kind: stream, final name, number
        done = []

        def put(kind: str, data: bytes) -> None:
            if kind not in files or files[kind][0].tell() > FILE_BYTES:
                n = close(kind) + 1 if kind in files else 0
                fs.create_dir(path, recursive=True)
                name = f"{kind}-{TaskContext.get().partitionId():06d}-{n:04d}.warc.gz"
                part = f"{path}/{name}.{uuid.uuid4().hex}"
                files[kind] = [fs.open_output_stream(part, compression=None), part, name, n]
            files[kind][0].write(data)

        def close(kind: str) -> int:
            stream, part, name, n = files.pop(kind)
            stream.close()
            fs.move(part, f"{path}/{name}")
            done.append(f"{folder}/{name}")
            return n

        for b in batches:
            for r in b.to_pylist():
                common = record_id(f"payload:{r['sha']}")
                own = common if r["shared"] and r["response"] else f"<{uuid.uuid4().urn}>"
                fields = {"WARC-Record-ID": own, "WARC-Target-URI": None if r["url"] is None else header_value(r["url"]),
                          "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(r['sha'])).decode()}",
                          "X-Page-ID": None if r["page_id"] is None else quote(str(r["page_id"]), safe=""), "Content-Type": "application/http; msgtype=response"}
                if r["response"]:
                    first = True
                    for data in segments("response", fields, HTTP_HEAD + chunked(r["payload"]), segment_bytes):
                        put("capture" if first else "segment", data)
                        first = False
                else:
                    fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": common}
                    put("capture", record("revisit", fields, HTTP_HEAD))
        for kind in list(files):
            close(kind)
        yield pa.RecordBatch.from_pydict({"uri": pa.array(done, pa.string())})

    return write_once(plan.select(*columns, "shared", "response").mapInArrow(write, "uri string"), "warc-files")


def _fetch(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive file, read a bounded number of bytes at a time."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as src:
        held, unpacker, plain = b"", zlib.decompressobj(31), io.BytesIO()
        while True:
            data = held or src.read(1 << 20)
            if not data:
                break
            plain.write(unpacker.decompress(data))
            held = unpacker.unused_data
            if unpacker.eof:
                yield from _one(plain.getvalue())
                unpacker, plain = zlib.decompressobj(31), io.BytesIO()
        if plain.tell():
            raise ValueError(f"{uri} ends within a record")


def _one(plain: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    yield fields, rest[:size]


def read_archives(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, record_id, record_type, payload, payload_digest, refers_id) of each capture in ``files`` (uri).

    Segments meet by the identifier of their origin; a capture with a missing
    segment, a wrong total length, a broken chunk or a wrong digest raises an
    error.  A revisit has no payload of its own.
    """
    def read(batches: Iterator[pa.RecordBatch]):
        names = ["origin", "record_type", "segment", "total", "page_id", "digest", "refers_id", "block"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows, held = [], 0
                for f, block in _fetch(uri):
                    total = f.get("warc-segment-total-length")
                    rows.append((f.get("warc-segment-origin-id", f["warc-record-id"]), f["warc-type"],
                                 int(f.get("warc-segment-number", 0)), total and int(total),
                                 unquote(f["x-page-id"]) if "x-page-id" in f else None,
                                 f.get("warc-payload-digest"), f.get("warc-refers-to"), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    # a fixed number of tasks: few small rows stand for large files
    parts = files.repartition(max(1, min(files.count(), MAX_READERS)), "uri").mapInArrow(
        read, "origin string, record_type string, segment int, total long, page_id string, digest string, "
              "refers_id string, block binary")
    whole = parts.groupBy("origin").agg(
        *[F.max(F.when(F.col("record_type") != "continuation", F.col(c))).alias(c)
          for c in ("record_type", "page_id", "digest", "refers_id")],
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))

    def decode(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out = []
            for r in b.to_pylist():
                numbers = [p["segment"] for p in r["parts"]]
                block = b"".join(p["block"] for p in r["parts"])
                if numbers != [0] and (numbers != list(range(1, len(numbers) + 1)) or len(block) != r["total"]):
                    raise ValueError(f"{r['origin']}: segments {numbers}, {len(block)} of {r['total']} bytes")
                digest = r["digest"].removeprefix("sha1:")
                payload = None
                if r["record_type"] != "revisit":
                    payload = payload_of(block)
                    if digest32(payload) != digest:
                        raise ValueError(f"{r['origin']}: wrong digest")
                out.append((r["page_id"], r["origin"], r["record_type"], payload, digest, r["refers_id"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], pa.binary() if i == 3 else pa.string()) for i in range(6)],
                names=["page_id", "record_id", "record_type", "payload", "payload_digest", "refers_id"])

    return whole.mapInArrow(decode, "page_id string, record_id string, record_type string, payload binary, "
                                    "payload_digest string, refers_id string") \
        .withColumn("page_id", F.col("page_id").cast(id_type))


def archive_report(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each row, from archives read back."""
    files = write_archives(pages, run_folder(pages.sparkSession, "warc"), page_id, url, html)
    kind = dict(pages.dtypes)[page_id]
    seen = write_once(read_archives(files, kind).select(
        "page_id", "record_id", "record_type", "payload_digest", "refers_id",
        F.octet_length("payload").cast("long").alias("payload_bytes")), "warc-captures")
    return resolve_revisits(seen).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each of the ``captures``.

    ``captures``: page_id, record_id, record_type, payload_digest, refers_id,
    payload_bytes.  A revisit takes the size and page_id of the response that
    it names; one whose response isn't there raises an error.
    """
    kept = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    found = captures.where("record_type = 'response'")
    origin = found.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"),
                          F.col("payload_bytes").alias("origin_bytes"))
    lost = F.raise_error(F.concat(F.lit("a revisit refers to a capture that isn't there: "), "refers_id")).cast("long")
    revisits = captures.where("record_type = 'revisit'").drop("payload_bytes").join(origin, "refers_id", "left") \
        .withColumn("payload_bytes", F.coalesce("origin_bytes", lost)).select(*kept, "refers_to")
    none = F.lit(None).cast(captures.schema["page_id"].dataType)
    return found.select(*kept, none.alias("refers_to")).unionByName(revisits)


_DIGIT = "('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4)) & 31"
#: DuckDB's words for ``archive_report`` over pages (base32 by groups of 20 bits).
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ({_DIGIT})::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN m USING (h)
"""
