import base64
import hashlib
import random

import pytest

from caseflow.llm import warc
from caseflow.llm.common import run_folder

TOP = "abcdefgh" * 20_000
ROWS = [(1, "http://a/1", "same"), (2, None, "same"), (9, "http://a/9", "same"), (3, "http://a/3", ""),
        (4, "http://a/4", None), (5, "http://a/5", TOP), (6, "http://a/6", "hé \r\n\r\n 0\r\n\r\n"),
        (None, "http://a/n", "only"), (7, "http://a/7", "again"), (7, "http://a/7", "again"), (8, "u", TOP)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "page_id long, url string, html string, row string, sha string")


def test_report_against_plain_python(spark):
    got = sorted((tuple(r) for r in warc.archive_report(pages(spark, ROWS)).collect()), key=str)
    top = {}
    for i, _, h in ROWS:
        top[h or ""] = max(i or -1, top.get(h or "", -1))
    want, used = [], set()
    for i, _, h in ROWS:
        data = (h or "").encode()
        first = (i is None or i == top[h or ""]) and data not in used
        if first:
            used.add(data)
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if first else "revisit", None if first else top[h or ""]))
    assert got == sorted(want, key=str)


def test_round_trip_of_payloads_with_small_segments(spark):
    rows = [(i, f"http://h/{i}", "".join(random.Random(i).choices("ab<>\r\né", k=i * 37))) for i in range(60)]
    files = warc.write_archives(pages(spark, rows), run_folder(spark, "warc-test"), segment_bytes=100)
    uris = [r.uri for r in files.collect()]
    assert any("segment" in u for u in uris) and any("capture" in u for u in uris)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(files).collect()}
    assert got == {i: h for i, _, h in rows}


def test_payloads_below_the_least_size_are_all_responses(spark):
    files = warc.write_archives(pages(spark, ROWS), run_folder(spark, "warc-test"), min_bytes=5)
    kinds = {(r.page_id, r.record_type) for r in warc.read_archives(files).collect()}
    assert {(1, "response"), (2, "response"), (9, "response"), (3, "response"), (4, "response")} <= kinds
    assert (5, "revisit") in kinds and (8, "response") in kinds


def test_lost_segment_is_noticed(spark):
    files = warc.write_archives(pages(spark, [(1, "u", TOP)]), run_folder(spark, "warc-test"))
    only = files.where("uri like '%capture%'")
    with pytest.raises(Exception, match="segments"):
        warc.read_archives(only).count() or warc.read_archives(only).collect()


def test_empty_table(spark):
    assert warc.archive_report(pages(spark, [])).count() == 0


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 10_000):
        data = bytes(random.Random(n).choices(range(256), k=n))
        assert warc.unchunked(warc.chunked(data)) == data
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


def test_rows_dealt_anew_lose_no_payload(spark):
    """Repeated rows in an input whose partitions come differently each time it is read."""
    rows = [(i, f"http://h/{i}", f"page {i % 40} " * 50) for i in range(250)]
    df = pages(spark, rows)
    out = warc.archive_report(df.unionByName(df).repartition(5)).collect()
    assert len(out) == 500 and all(r.payload_bytes for r in out)
    assert sum(r.record_type == "response" for r in out) == 40
    for r in out:
        assert r.refers_to == (None if r.record_type == "response" else max(i for i in range(250) if i % 40 == r.page_id % 40))


def test_odd_urls_and_ids(spark):
    urls = ["a\r\n\r\nb", "a\r\nContent-Length: 0", "\x00\x7f", " x ", "", "http://h/%20?q=é", "\n"]
    df = spark.createDataFrame([(f"id\r\n{i}% ", u, f"t{i}") for i, u in enumerate(urls)],
                               "page_id string, url string, html string")
    out = warc.archive_report(df).collect()
    assert sorted(r.page_id for r in out) == sorted(f"id\r\n{i}% " for i in range(len(urls)))
    assert all(r.record_type == "response" and r.payload_bytes == 2 for r in out)


def test_revisit_without_its_response_is_noticed(spark):
    files = warc.write_archives(pages(spark, [(1, "u", "same"), (2, "u", "same")]), run_folder(spark, "warc-test"))
    seen = warc.read_archives(files).selectExpr("*", "cast(length(payload) as long) as payload_bytes")
    assert warc.resolve_revisits(seen).count() == 2
    with pytest.raises(Exception, match="isn't there"):
        warc.resolve_revisits(seen.where("record_type = 'revisit'")).collect()
