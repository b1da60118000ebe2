"""WARC archives by way of a chunked record table.

A payload is never copied as a whole: it is walked in chunks of at most
``CHUNK`` bytes, and each chunk is a row (record, chunk number) with the digest
of the payload so far. Each row becomes a WARC record of its own: the first
is the response, the others are its continuation segments, so that writers
and readers hold one chunk at a time. Revisits carry no payload.

Archives are written with Spark's text writer, one record after another, as
gzip files of bounded length. They are read back with the version line
``WARC/1.1`` as the separator, so a row is a segment again; lengths and block
digests are checked, and payloads are digested anew, chunk by chunk.
Chunks are cut inside any ``WARC/1.1`` that a payload holds, and where
characters end.

Of equal payloads of at least ``least_bytes``, the page with the smallest id is
the response, and the others revisit it. Only digests are grouped.

Defined results: a null payload is empty; repeated rows of the smallest id are
all responses; a null id counts as larger than any other; a null url is
empty; an empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only
from quire.session import scratch_path

CHUNK = 1 << 16
FILE_RECORDS = 50_000   # segments in one archive file
BATCH_BYTES = 4 << 20
VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunks(payload: memoryview, size: int = CHUNK) -> Iterator[memoryview]:
    """Pieces of at most ``size`` bytes (one empty piece for an empty payload) that
    end where a character ends and hold no version line."""
    mark = VERSION.encode()
    n, lo = len(payload), 0
    while True:
        hi = min(n, lo + size)
        while lo < hi < n and payload[hi] & 0xC0 == 0x80:
            hi -= 1
        # a version line in it, or across its end, is cut behind its fourth byte
        at = bytes(payload[lo:min(n, hi + len(mark) - 1)]).find(mark)
        if at >= 0 and lo + at + 4 < hi:
            hi = lo + at + 4
        yield payload[lo:hi]
        lo = hi
        if lo >= n:
            return


def measured(pages: DataFrame) -> DataFrame:
    """(page, url, html, bytes, digest): length and digest of each payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for html in batch.column("html"):
                buf = html.as_buffer() if html.is_valid else b""
                sizes.append(len(buf) if not html.is_valid else buf.size)
                digests.append(base32(hashlib.sha1(buf, usedforsecurity=False).digest()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=[*batch.schema.names, "bytes", "digest"])

    return pages.mapInArrow(run, f"page {pages.schema['page'].dataType.simpleString()}, url string, html string, bytes long, digest string")


def typed(pages: DataFrame, page_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """The measured pages with the id that each revisits (null for responses)."""
    rows = measured(only(pages, page=page_col, url=url_col, html=html_col).select("page", F.col("url").cast("string"), F.col("html").cast("string")))
    firsts = (rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("pages"))
              .filter("pages > 1").select("digest", "bytes", "first"))
    return rows.join(firsts, ["digest", "bytes"], "left").withColumn("refers", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")))


def record_chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunk table: (record, chunk, chunks_left, page, url, refers, bytes, digest, so_far, block)."""
    kind = rows.schema["page"].dataType.simpleString()
    src = rows.select(F.monotonically_increasing_id().alias("record"), "page", F.coalesce("url", F.lit("")).alias("url"), "refers", "bytes", "digest", F.coalesce("html", F.lit("")).alias("html"))
    names = ["record", "chunk", "last", "page", "url", "refers", "bytes", "digest", "so_far", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [pa.int64(), pa.int64(), pa.bool_(), batch.column("page").type, pa.string(), batch.column("refers").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            out, held = [], 0
            for k in range(batch.num_rows):
                record, page, url, refers, size_, digest = (batch.column(c)[k].as_py() for c in ("record", "page", "url", "refers", "bytes", "digest"))
                html = batch.column("html")[k]
                payload = memoryview(html.as_buffer() if refers is None else b"")
                sha, done = hashlib.sha1(usedforsecurity=False), 0
                for number, block in enumerate(chunks(payload, size)):
                    sha.update(block)
                    done += len(block)
                    out.append((record, number, done >= len(payload), page, url, refers, size_, digest, base32(sha.digest()), str(block, "utf-8")))
                    held += len(block) + 500
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return src.mapInArrow(run, f"record long, chunk long, last boolean, page {kind}, url string, refers {kind}, bytes long, digest string, so_far string, block string")


def header(r: dict) -> str:
    """The header block of one segment."""
    block = r["block"].encode()
    origin = f"<urn:quire:record:{r['record']}:0>"
    first, alone = r["chunk"] == 0, r["chunk"] == 0 and r["last"]
    told = lambda v: json.dumps(v).replace("/", "\\/")  # noqa: E731  no version line in it
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in r["url"]).replace(VERSION, VERSION.replace("/", "%2F"))
    lines = [f"WARC-Type: {'continuation' if not first else 'revisit' if r['refers'] is not None else 'response'}",
             f"WARC-Record-ID: <urn:quire:record:{r['record']}:{r['chunk']}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
             f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block, usedforsecurity=False).digest())}", f"Quire-Digest-So-Far: sha1:{r['so_far']}"]
    if first:
        lines += [f"WARC-Payload-Digest: sha1:{r['digest']}", f"Quire-Payload-Length: {r['bytes']}", f"Quire-Page: {told(r['page'])}"]
    if r["refers"] is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Quire-Refers-To-Page: {told(r['refers'])}"]
    if not alone:
        lines += [f"WARC-Segment-Number: {r['chunk'] + 1}"] + ([] if first else [f"WARC-Segment-Origin-ID: {origin}"]) + ([f"WARC-Segment-Total-Length: {r['bytes']}"] if r["last"] else [])
    return "\r\n".join([VERSION, *lines, "Content-Type: text/html", f"Content-Length: {len(block)}", "", ""])


def write(pages: DataFrame, path: str, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, size: int = CHUNK) -> None:
    """Write the pages as archives under ``path`` (a folder that all executors share)."""
    table = record_chunks(typed(pages, page_col, url_col, html_col, least_bytes), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([header(r) + r["block"] for r in batch.to_pylist()], pa.string())], names=["value"])

    table.mapInArrow(run, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def segments(spark, path: str, id_type: str) -> DataFrame:
    """The segments of the archives under ``path``: (origin, chunk, page, type, refers,
    bytes, digest, block, whole); ``whole`` is the payload digest of a record of one
    segment, whose block is then not carried on."""
    pa_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    rows = spark.read.option("lineSep", f"{VERSION}\r\n").text(path)
    names = ["origin", "chunk", "page", "type", "refers", "bytes", "digest", "length", "block"]
    kinds = [pa.string(), pa.int64(), pa_id, pa.string(), pa_id, pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(0):
                raw = value.as_py()
                if not raw:
                    continue   # before the first version line of a file
                head, _, rest = raw.partition("\r\n\r\n")
                f = dict(x.split(": ", 1) for x in head.split("\r\n"))
                block = rest.encode()[:int(f["Content-Length"])]
                if len(block) != int(f["Content-Length"]) or rest.encode()[len(block):] != b"\r\n\r\n" or f["WARC-Block-Digest"] != "sha1:" + base32(hashlib.sha1(block, usedforsecurity=False).digest()):
                    raise ValueError(f"damaged record {f.get('WARC-Record-ID')}")
                number = int(f.get("WARC-Segment-Number", 1)) - 1
                alone = "WARC-Segment-Number" not in f
                told = lambda name: json.loads(f[name]) if name in f else None  # noqa: E731, B023
                digest = f["WARC-Payload-Digest"][5:] if number == 0 else None
                if alone and f["WARC-Type"] == "response" and f["WARC-Block-Digest"][5:] != digest:
                    raise ValueError(f"payload and digest differ in {f['WARC-Record-ID']}")
                out.append((f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), number, told("Quire-Page"), f["WARC-Type"], told("Quire-Refers-To-Page"),
                            int(f["Quire-Payload-Length"]) if number == 0 else None, digest, len(block), None if alone else block))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, f"origin string, chunk long, page {id_type}, type string, refers {id_type}, bytes long, digest string, length long, block binary")


def read(spark, path: str, id_type: str = "bigint", page_col: str = "page_id") -> DataFrame:
    """One row per record: page id, payload_bytes and payload_digest (of the whole
    payload, digested anew segment by segment), record_type, refers_to."""
    rows = segments(spark, path, id_type).repartition("origin").sortWithinPartitions("origin", "chunk")
    names = [page_col, "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = sha = None
        length = count = 0
        kinds: list = []

        def done() -> tuple:
            if record["type"] == "revisit":
                return record["page"], record["bytes"], record["digest"], "revisit", record["refers"]
            if length != record["bytes"] or sha is not None and base32(sha.digest()) != record["digest"]:
                raise ValueError(f"segments of {record['origin']} don't make its payload")
            return record["page"], length, record["digest"] if sha is None else base32(sha.digest()), "response", None

        for batch in batches:
            out = []
            kinds = [batch.column("page").type, pa.int64(), pa.string(), pa.string(), batch.column("page").type]
            for r in batch.to_pylist():
                if r["chunk"] == 0:
                    if record:
                        out.append(done())
                    record, length, count = r, 0, 0
                    sha = None if r["block"] is None else hashlib.sha1(usedforsecurity=False)
                if record is None or r["origin"] != record["origin"] or r["chunk"] != count:
                    raise ValueError(f"segment missing before {r['origin']}, {r['chunk']}")
                count += 1
                length += r["length"]
                if r["block"] is not None:
                    sha.update(r["block"])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
        if record:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(done(), kinds)], names=names)

    return rows.mapInArrow(run, f"`{page_col}` {id_type}, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}")


def round_trip(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, size: int = CHUNK) -> DataFrame:
    """Write the pages into the shared folder and read the archives back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, page_col, url_col, html_col, least_bytes, size)
    return read(pages.sparkSession, path, pages.schema[page_col].dataType.simpleString(), page_col)
