"""Operator 4: WARC archives through a chunked record table.

Writing: pages with equal payloads of at least ``REVISIT_BYTES`` keep one
``response`` (the largest page id), the others become ``revisit`` records. Each
task streams its records into an archive of its own, one gzip member per record,
and reports the byte ranges it wrote; only archives of tasks that finished are in
the manifest, so a lost or repeated task leaves at most an unread file.

Reading: every byte range is streamed member by member into rows of record number
and chunk number. A chunk row carries the running length and SHA-1 of the payload
so far, so the last chunk of a record has both for the whole payload and no step
holds more than ``CHUNK`` bytes of it. A digest that differs from the record's
header fails the read.

Defined results: null html is an empty payload, null url an empty target; empty
payloads and payloads below ``REVISIT_BYTES`` are always ``response``; repeated
rows of the largest page id are all ``response``; a null page id refers to
nothing and is a ``revisit`` of an equal payload that has an id; an empty table
writes no archive and returns no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, read_table
from lakeward.session import scratch_path

REVISIT_BYTES = 1000
CHUNK = 1 << 20           # payload bytes per chunk row, at most
QUERY_CHUNK = 1 << 14     # the query's chunk rows: a page of usual size is several of them
RANGE_BYTES = 16 << 20    # compressed bytes per range of the manifest
READ_TASKS = 20_000       # most tasks that read archives; each takes its share of the ranges
WARC_DATE = "1970-01-01T00:00:00Z"  # the table has no capture time
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CRLF = b"\r\n"


def record_uri(page_id: str | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def uri_page(uri: str | None) -> str | None:
    return (uri or "")[len("<urn:x-page:"):-1] or None


def with_record_types(pages: DataFrame) -> DataFrame:
    """Adds ``payload`` digest and length, ``record_type`` and ``refers_to`` to the pages."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(raw).alias("sha1"),
                        F.octet_length(raw).cast("long").alias("n_bytes"))
    # One row per repeated payload, pre-aggregated in each task; a payload that a
    # third of the pages share is one row here.
    kept = (rows.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy("sha1", "n_bytes")
            .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
            .select(F.col("sha1").alias("k_sha1"), F.col("n_bytes").alias("k_bytes"), "keeper"))
    joined = rows.join(kept, (rows["sha1"] == kept["k_sha1"]) & (rows["n_bytes"] == kept["k_bytes"]), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select(
        F.col("page_id").cast("string").alias("page"), "url",
        F.when(~revisit, F.col("html")).alias("html"), "sha1", "n_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper").cast("string")).alias("refers_to"))


def _header(page, url, sha1, n_bytes, kind, refers_to) -> tuple[bytes, bytes]:
    """WARC header and HTTP header of a record."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % n_bytes)
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_uri(page)}",
             f"WARC-Date: {WARC_DATE}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response"]
    block = len(http)
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    else:
        block += n_bytes
    lines += [f"Content-Length: {block}", "", ""]
    return "\r\n".join(lines).encode(), http


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """Writes the records below ``folder`` and returns the manifest of what was written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, name, at, start, held = None, None, 0, 0, 0
        ranges = []
        for pdf in batches:
            for page, url, html, sha1, n_bytes, kind, refers in zip(
                    pdf["page"], pdf["url"], pdf["html"], pdf["sha1"], pdf["n_bytes"],
                    pdf["record_type"], pdf["refers_to"]):
                if out is None:  # a name of its own for every attempt
                    fs.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                head, http = _header(page, url, sha1, n_bytes, kind, refers)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                parts = [member.compress(head + http)]
                if kind == "response" and html:
                    payload = memoryview(html.encode())
                    for i in range(0, len(payload), CHUNK):
                        parts.append(member.compress(payload[i:i + CHUNK]))
                        at += sum(map(len, parts))
                        out.write(b"".join(parts))
                        parts = []
                parts.append(member.compress(CRLF + CRLF) + member.flush())
                at += sum(map(len, parts))
                out.write(b"".join(parts))
                held += 1
                if at - start >= RANGE_BYTES:
                    ranges.append((name, start, at, held))
                    start, held = at, 0
        if out is not None:
            out.close()
            if held:
                ranges.append((name, start, at, held))
            yield pd.DataFrame(ranges, columns=["file", "range_start", "range_end", "n_records"])

    return typed.mapInPandas(
        run, "file string, range_start bigint, range_end bigint, n_records bigint")


class _Members:
    """Bytes of the gzip members of one file range, decompressed a piece at a time."""

    def __init__(self, stream, start: int, end: int, piece: int = 1 << 16):
        stream.seek(start)
        self.stream, self.left, self.piece = stream, end - start, piece
        self.inflate, self.raw, self.buffer = zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Adds at least one byte to the buffer; False at the end of the range."""
        while True:
            if self.inflate.eof:  # the next member begins behind the end of this one
                self.raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            if not self.raw and self.left > 0:
                self.raw = self.stream.read(min(self.piece, self.left))
                if not self.raw:
                    raise ValueError("archive is shorter than its manifest says")
                self.left -= len(self.raw)
            drained = not self.raw
            got = self.inflate.decompress(self.raw, self.piece)
            self.raw = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                self.buffer += got
                return True
            if drained and not self.inflate.eof:
                return False

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and including ``mark``; None at the end of the range."""
        while (k := self.buffer.find(mark)) < 0:
            if not self.more():
                if self.buffer:
                    raise ValueError("archive ends inside a record header")
                return None
        got, self.buffer = self.buffer[:k + len(mark)], self.buffer[k + len(mark):]
        return got

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("archive ends inside a record")
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


_CHUNK_COLUMNS = ["file", "range_start", "record_no", "chunk_no", "uri", "target", "record_type",
                  "refers_uri", "data", "payload_bytes", "payload_sha1", "is_last"]


def read_chunks(manifest: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """The chunk table: one row per record and chunk, with running length and digest."""
    def range_rows(stream, name, start, end, n_records) -> Iterator[tuple]:
        src = _Members(stream, start, end)
        for number in range(n_records):
            head = src.until(CRLF + CRLF)
            if head is None:
                raise ValueError(f"{name}: {number} records instead of {n_records}")
            h = _fields(head)
            http = src.until(CRLF + CRLF)
            left = int(h["content-length"]) - len(http)
            said = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
            full = int(_fields(http)["content-length"])
            base = (h["warc-record-id"], h["warc-target-uri"], h["warc-type"], h.get("warc-refers-to"))
            if h["warc-type"] == "revisit":
                yield (name, start, number, 0, *base, None, full, said, True)
            else:
                digest, done, k = hashlib.sha1(), 0, 0
                while True:
                    data = src.take(min(chunk, left - done))
                    digest.update(data)
                    done += len(data)
                    last = done == left
                    if last and (digest.hexdigest() != said or done != full):
                        raise ValueError(f"{name}: payload of {base[0]} differs from its digest")
                    yield (name, start, number, k, *base, data, done, digest.hexdigest(), last)
                    if last:
                        break
                    k += 1
            if src.take(4) != CRLF + CRLF:
                raise ValueError(f"{name}: record {number} has no end")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for pdf in batches:
            for name, start, end, n in zip(pdf["file"], pdf["range_start"], pdf["range_end"], pdf["n_records"]):
                with fs.open_input_file(f"{root}/{name}") as stream:
                    rows, size = [], 0
                    for row in range_rows(stream, name, start, end, n):
                        rows.append(row)
                        size += 300 + len(row[8] or b"")
                        if size > 8 * CHUNK:
                            yield pd.DataFrame(rows, columns=_CHUNK_COLUMNS)
                            rows, size = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=_CHUNK_COLUMNS)

    # A number of partitions of its own: the manifest is a few rows, which adaptive
    # execution would otherwise hand to one task with all archives behind them.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    dealt = manifest.repartition(tasks, F.col("file"), F.col("range_start"))
    return dealt.mapInPandas(
        run, "file string, range_start bigint, record_no bigint, chunk_no bigint, uri string, "
             "target string, record_type string, refers_uri string, data binary, "
             "payload_bytes bigint, payload_sha1 string, is_last boolean")


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns their manifest, itself written so that it is final."""
    return cut(write_archives(with_record_types(pages), folder), "warc-manifest")


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: what its last chunk says, once its rows are all there.

    The bytes of the chunk rows must add up to the running length of the last one, and
    their numbers must be gapless; a table that lost or repeated a chunk fails the query.
    """
    last = F.max_by(F.struct("uri", "target", "record_type", "refers_uri", "payload_bytes", "payload_sha1"),
                    "chunk_no")
    held = chunks.groupBy("file", "range_start", "record_no").agg(
        last.alias("last"), F.count("*").alias("rows"), F.max("chunk_no").alias("top"),
        F.count_if("is_last").alias("ends"), F.sum(F.octet_length("data")).alias("bytes"))
    whole = (F.col("rows") == F.col("top") + 1) & (F.col("ends") == 1) & (
        (F.col("last.record_type") == "revisit") | (F.col("bytes") == F.col("last.payload_bytes")))
    checked = F.when(whole, F.col("last")).otherwise(F.raise_error(F.concat(
        F.lit("chunk rows of a record are missing or repeated: "), F.col("last.uri"))).cast(
            "struct<uri:string,target:string,record_type:string,refers_uri:string,payload_bytes:bigint,payload_sha1:string>"))
    return held.select(checked.alias("r")).select("r.*")


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    chunks = read_chunks(archive_pages(pages, folder), folder, QUERY_CHUNK)
    id_type = pages.schema["page_id"].dataType

    def page(uri):  # <urn:x-page:ID>
        return F.regexp_extract(uri, "^<urn:x-page:(.*)>$", 1).try_cast(id_type)

    return records(chunks).select(
        page(F.col("uri")).alias("page_id"), "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"), "record_type",
        page(F.col("refers_uri")).alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
k AS (SELECT html, max(page_id) AS keeper FROM p WHERE n >= {REVISIT_BYTES} GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html"""
