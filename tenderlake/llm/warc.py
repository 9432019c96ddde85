"""WARC archives: records written in segments with chunked bodies, read back and reassembled."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import map_batches, materialize, table
from tenderlake.session import scratch_root

#: Bytes of a block from which on it is cut into a record and its continuations.
SEGMENT = 32 << 10
#: Bytes of a piece of a chunked body.
CHUNK = 4 << 10
#: Records in a file; with the segment size it bounds a file, which one task reads whole.
FILE_RECORDS = 2000
#: Payloads below this many bytes are always written in full.
REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
END = "\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            raise ValueError("chunked body ends within a size line")
        size = int(body[at:stop].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = stop + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("chunked body is shorter than its sizes say")
        out.append(body[stop + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("response without the end of its header")
    coding = [v.strip().lower() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:]) if k.strip().lower() == b"transfer-encoding"]
    return dechunked(body) if b"chunked" in coding else body


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def page_records(name: str, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit without payload, or a response in as many segments as it takes."""
    common = {"WARC-Date": DATE, "WARC-Target-URI": quote(url or "", safe="%/:?#[]@!$&'()*+,;=~"), "WARC-Payload-Digest": f"sha1:{digest}"}
    kind = {"Content-Type": "application/http; msgtype=response"}
    own = f"<urn:page:{name}>"
    if refers_to is not None:
        refers = {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": IDENTICAL}
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": own} | common | refers | kind, b"")
        return
    block = HEAD + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    first = {"WARC-Type": "response", "WARC-Record-ID": own} | common | kind
    yield _record(first | ({"WARC-Segment-Number": 1} if len(parts) > 1 else {}), parts[0])
    for number, part in enumerate(parts[1:], 2):
        last = {"WARC-Segment-Total-Length": len(block)} if number == len(parts) else {}
        yield _record({"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:page:{name}:{number}>", "WARC-Date": DATE, "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": number} | last, part)


def records_in(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an uncompressed archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("archive ends within a record")
        yield fields, block


def write_archive(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Write a WARC file of gzip members into each part of the folder ``path``, through Spark's own text writer.

    Of pages with equal payloads of at least ``least`` bytes, those of the smallest page_id are
    responses and the others revisits of it. Only digests that occur twice take part in a join,
    so payloads move only when these are many. A null html is empty; a null page_id stays null
    and never comes first unless all are null; repeated rows get a record each.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"), F.sha1(html).alias("sha1"))
    twice = materialize(
        named.filter(F.octet_length("payload") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    )
    marked = named.join(twice, "sha1", "left").withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))

    def step(batch: pa.RecordBatch) -> dict:
        out = []
        part = TaskContext.get().partitionId()
        mark = uuid.uuid4().hex[:8]  # keeps records of repeated page ids apart
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "first")), strict=True)
        for at, (page, url, payload, sha1, first) in enumerate(rows):
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            out += page_records(f"{'' if page is None else page}:{part}-{mark}-{at}", url, payload, digest, first)
        return {"record": out}

    records = map_batches(marked, "record binary", step).select(F.col("record").cast("string"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _page(identifier: str | None) -> int | None:
    found = (identifier or "").removeprefix("<urn:page:").removesuffix(">").split(":")[0]
    return int(found) if found else None


_KEPT = "page_id long, record_type string, refers_to long, header_digest string"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, header_digest, payload) of every page of an archive.

    Files are read through Spark, so any storage will do. Records cut into segments are grouped
    by their origin's identifier, ordered by number, and put together; a gap or a length other
    than the stated total is an error, as is a payload whose digest is not the stated one.
    """
    parts = spark.read.format("binaryFile").load(path + "/*.gz").select("content")
    schema = f"{_KEPT}, origin string, number int, total long, block binary"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                size = 0
                for f, block in records_in(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    number = int(f.get("warc-segment-number", 0))
                    total = f.get("warc-segment-total-length")
                    origin = f.get("warc-segment-origin-id") or f["warc-record-id"]
                    refers = _page(f.get("warc-refers-to"))
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append((_page(origin), f["warc-type"], refers, digest, origin, number, int(total) if total else None, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    types = [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("header_digest", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], schema=pa.schema(types))

    records = parts.mapInArrow(parse, schema)
    # A record's own segments: as many as its length asks for.
    cut = records.filter("number > 0").groupBy("origin").agg(
        F.first("page_id", True).alias("page_id"),
        F.max(F.when(F.col("number") == 1, F.col("header_digest"))).alias("header_digest"),
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
    ).select("page_id", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "header_digest", "origin", "total", "parts.number", "parts.block")
    whole = records.filter("number = 0").select(
        "page_id", "record_type", "refers_to", "header_digest", "origin", F.octet_length("block").cast("long").alias("total"),
        F.array(F.lit(1)).alias("number"), F.array("block").alias("block"),
    )

    def assemble(batch: pa.RecordBatch) -> dict:
        payloads = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("origin", "record_type", "header_digest", "total", "number", "block")), strict=True)
        for origin, kind, digest, total, numbers, blocks in rows:
            block = b"".join(blocks)
            if numbers != list(range(1, len(numbers) + 1)) or len(block) != total:
                raise ValueError(f"{origin}: {len(block)} bytes in segments {numbers[:5]}, {total} are stated")
            payload = payload_of(block) if kind == "response" else None
            if payload is not None and digest_of(payload) != digest:
                raise ValueError(f"{origin}: the payload's digest differs")
            payloads.append(payload)
        return {n: batch.column(n) for n in ("page_id", "record_type", "refers_to", "header_digest")} | {"payload": payloads}

    # Two stages rather than a union: segments are few, whole records are not shuffled.
    out = f"{_KEPT}, payload binary"
    return map_batches(whole, out, assemble).unionByName(map_batches(cut, out, assemble))


def op5_segment_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the archive of ``pages``, a row for each of its rows; a null html is an empty payload.

    Repeated rows get a record each, a null id is reported as null; an empty table gives no rows.
    """
    pages = table(spark, sf_dir, "pages")
    path = f"{scratch_root(spark)}/tenderlake/{uuid.uuid4().hex}"
    write_archive(pages, path)
    read = materialize(
        read_archive(spark, path).select("page_id", "record_type", "refers_to", "header_digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    )
    # A revisit has no payload of its own: its length is that of the response it refers to.
    revisited = read.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id")).distinct()
    lengths = (
        read.filter("record_type = 'response'")
        .join(revisited, "page_id", "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"))
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    return read.join(lengths, "refers_to", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        F.col("header_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
