"""WARC archives of pages: writing with segments and revisits, and reassembly on reading.

A page is an HTTP response with a chunked body.  A block longer than ``SEGMENT`` bytes is cut
into a first record and continuation records, which may land in other files.  Of pages with equal payloads the
one with the largest id is archived in full, the others as revisits of it.  Archives are gzip files
of at most ``PER_FILE`` records, written by Spark's own text writer (a record ends with two line
breaks, its line separator), so they can lie in any store that Spark reaches.

Reading brings the records of one origin together, puts them in order of their segment numbers, checks that
none is missing and that they add up to the total length, and takes the chunk framing off.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retally.llm.common import kept, ready, slices, texts, workspace

SEGMENT = 16_384
CHUNK = 4096
PER_FILE = 1000
END = b"\r\n"


def digest(payload: str) -> Column:
    """Upper-case base 32 of SHA-1, by groups of 20 bits."""
    code = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def framed(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + CHUNK]), payload[i:i + CHUNK]) for i in range(0, len(payload), CHUNK)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """Payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(END, at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        start = line + 2
        if body[start + size:start + size + 2] != END:
            raise ValueError("chunk without its end")
        out.append(body[start:start + size])
        at = start + size + 2


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items() if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + END + block


def records(page: int | None, url: str | None, payload: bytes, code: str, refers_to: int | None, name: str) -> Iterator[bytes]:
    """The records of one page, without the line breaks behind them."""
    about = {"WARC-Record-ID": f"<urn:uuid:{name}>", "WARC-Date": "1970-01-01T00:00:00Z",
             "WARC-Target-URI": " ".join(url.split()) if url else None, "WARC-Payload-Digest": f"sha1:{code}", "Page-Id": page}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    http = {"Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        yield _record("revisit", about | http | {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "Refers-To-Page-Id": refers_to}, head)
        return
    block = head + framed(payload)
    if len(block) <= SEGMENT:
        yield _record("response", about | http, block)
        return
    cuts = range(0, len(block), SEGMENT)
    yield _record("response", about | http | {"WARC-Segment-Number": 1}, block[:SEGMENT])
    for number, at in enumerate(cuts[1:], 2):
        yield _record("continuation", {
            "WARC-Record-ID": f"<urn:uuid:{name}-{number}>", "WARC-Date": about["WARC-Date"],
            "WARC-Segment-Origin-ID": about["WARC-Record-ID"], "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if at == cuts[-1] else None}, block[at:at + SEGMENT])


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, count = TaskContext.get().partitionId(), 0
    for batch in slices(batches, "html"):
        out = []
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "digest", "refers_to"))
        for page, url, code, refers, payload in zip(*columns, texts(batch, "html")):
            count += 1
            name = hashlib.md5(f"{part}/{count}/{page}".encode()).hexdigest()
            out += records(page, url, payload, code, refers, name)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write(pages: DataFrame, path: str, least: int = 0) -> None:
    """Archive every row of ``pages(page_id, url, html)``; null html is empty.

    Payloads of fewer than ``least`` bytes are never revisits.  A row with a null id is archived in full; so are
    repeated rows with the largest id of their payload.  Other columns are not read.
    """
    ready(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    code = kept(pages.select("page_id", digest("html").alias("digest"), F.octet_length("html").alias("n")), f"{path}-digests")
    last = code.where(F.col("n") >= least).groupBy("digest").agg(F.max("page_id").alias("refers_to"))
    roles = code.select("page_id", "digest").distinct().join(last, "digest").where("page_id < refers_to").select(
        "page_id", F.col("digest").alias("told"), "refers_to")
    keyed = pages.withColumn("digest", digest("html"))
    known = keyed.join(roles.hint("shuffle_hash"), (keyed.page_id == roles.page_id) & (keyed.digest == roles.told), "left").select(
        keyed.page_id, "url", "html", "digest", "refers_to")
    known.mapInArrow(_written, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)


_PARSED = pa.schema([("kind", pa.string()), ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()),
                     ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])


def parsed(data: bytes) -> Iterator[tuple]:
    """Records of one archive, by their content lengths."""
    at, number = 0, lambda v: None if v is None else int(v)
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        field = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        start, size = stop + 4, int(field["content-length"])
        yield (field["warc-type"], field.get("warc-segment-origin-id", field["warc-record-id"]),
               number(field.get("warc-segment-number")), number(field.get("warc-segment-total-length")),
               number(field.get("page-id")), number(field.get("refers-to-page-id")),
               field.get("warc-payload-digest", "").removeprefix("sha1:") or None, data[start:start + size])
        at = start + size + 4


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            columns = list(zip(*parsed(gzip.decompress(data.as_py()))))
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)


_PAGE = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("digest", pa.string()), ("payload", pa.binary()), ("complete", pa.bool_())])


def whole(parts: list[dict]) -> tuple:
    """One page from its records, in order of segment numbers.  Damaged ones have no payload and are not complete."""
    parts = sorted(parts, key=lambda r: r["number"] or 1)
    first, block = parts[0], b"".join(r["block"] for r in parts)
    about = (first["page_id"], first["kind"], first["refers_to"], first["digest"])
    if first["kind"] == "revisit":
        return (*about, None, True)
    in_order = [r["number"] or 1 for r in parts] == list(range(1, len(parts) + 1))
    total = parts[-1]["total"]
    if first["kind"] != "response" or not in_order or (first["number"] is not None and total != len(block)):
        return (*about, None, False)
    head, _, body = block.partition(b"\r\n\r\n")
    payload = unframed(body) if b"transfer-encoding: chunked" in head.lower() else body
    same = base64.b32encode(hashlib.sha1(payload).digest()).decode() == first["digest"]
    return (*about, payload if same else None, same)


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAGE)], schema=_PAGE)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records come sorted by origin and number; only those of one origin are held."""
    held: list[dict] = []
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = {f.name: batch.column(j)[i].as_py() for j, f in enumerate(_PARSED)}
            if held and held[0]["origin"] != row["origin"]:
                out.append(whole(held))
                held = []
            held.append(row)
        yield _pages(out)
    if held:
        yield _pages([whole(held)])


_PAGE_COLUMNS = "page_id long, record_type string, refers_to long, digest string, payload binary, complete boolean"


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, record_type, refers_to, digest, payload, complete)`` of the pages in the archives under ``path``.

    Revisits have no payload.  A page with missing segments, a wrong total length or a wrong digest has no payload
    and is not complete.
    """
    ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    columns = ("kind string, origin string, number long, total long, page_id long, refers_to long, digest string, block binary")
    found = files.mapInArrow(_parse, columns)
    # records of one piece need no partner; the others meet by origin
    return found.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(_assemble, _PAGE_COLUMNS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive all pages and read them back: size, digest and role of every page."""
    spark = pages.sparkSession
    path = workspace(spark, "warc")
    write(pages, path)
    facts = kept(read(spark, path).select("page_id", "record_type", "refers_to", F.col("digest").alias("payload_digest"),
                                          F.octet_length("payload").cast("long").alias("n")), f"{path}-facts")
    full = facts.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to")).agg(
        F.max("n").alias("known"))
    return facts.join(full, "refers_to", "left").select(
        "page_id", F.coalesce("n", "known").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
