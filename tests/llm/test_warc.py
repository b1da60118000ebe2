import base64
import hashlib

import pytest

from quire.llm import warc
from quire.session import scratch_path

PAYLOADS = ["", None, "a", "é" * 50, "x WARC/1.1\r\nWARC-Type: response\r\n\r\n y", "WARC/1.1", "WARC/1.1" * 30, "\r\n\r\n", "a", "日本" * 40, "\x00\x01", "line\r\n" * 40, "z" * 5000]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, page string, bytes int, digest string")


@pytest.mark.parametrize("size", [10, 64, 1 << 16])
def test_round_trip(spark, size):
    rows = [(k, f"http://a/{k} WARC/1.1", t) for k, t in enumerate(PAYLOADS)]
    got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(pages(spark, rows).repartition(3), size=size).collect()}
    first = {}
    for k, t in enumerate(PAYLOADS):
        first.setdefault(t or "", k)
    for k, t in enumerate(PAYLOADS):
        f = first[t or ""]
        assert got[k] == (len((t or "").encode()), digest(t), "response" if f == k else "revisit", None if f == k else f), t


@pytest.mark.parametrize("payload", PAYLOADS)
def test_chunks_are_whole_and_hold_no_version_line(payload):
    raw = (payload or "").encode()
    parts = [bytes(c) for c in warc.chunks(memoryview(raw), 7 if len(raw) < 100 else 16)]
    assert b"".join(parts) == raw and all(len(p) <= 16 for p in parts)
    assert not any(b"WARC/1.1" in p for p in parts) and [p.decode() for p in parts]


def test_archives_are_warc_records(spark):
    path = scratch_path(spark, "warc-test")
    warc.write(pages(spark, [(1, "http://x/", "abc" * 10), (2, "http://x/", "abc" * 10)]), path, size=12)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert text.startswith("WARC/1.1\r\nWARC-Type: ") and text.endswith("\r\n\r\n")
    assert "WARC-Segment-Total-Length: 30" in text and text.count("WARC-Type: continuation") == 2 and text.count("WARC-Type: revisit") == 1


def test_least_bytes_and_repeated_rows(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (2, "u", "same"), (None, "u", "same"), (3, None, "ab"), (4, None, "ab")]
    got = [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages(spark, rows), least_bytes=3).collect()]
    assert sorted(got, key=str) == sorted([(1, "response", None), (1, "response", None), (2, "revisit", 1), (None, "revisit", 1), (3, "response", None), (4, "response", None)], key=str)
    assert warc.round_trip(pages(spark, rows).limit(0)).collect() == []


def test_a_damaged_archive_is_refused(spark):
    path = scratch_path(spark, "warc-damaged")
    warc.write(pages(spark, [(1, "u", "abcdef")]), path)
    bad = scratch_path(spark, "warc-bad")
    spark.read.text(path, wholetext=True).selectExpr("replace(value, 'abcdef', 'abcdeg') AS value").write.option("lineSep", "\r\n\r\n").text(bad)
    with pytest.raises(Exception, match="damaged|differ"):
        warc.read(spark, bad).collect()
