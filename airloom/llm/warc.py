"""WARC archives through a chunked record table.

Payloads travel as rows (record, chunk number, bytes): a payload longer than `CHUNK` is cut
into several rows in the task that reads it, the writer streams them into a gzip member of
its archive, and the reader yields rows of the same form, each with the number of bytes
and the SHA-1 of the payload up to there. Neither side holds a whole record.

Equal payloads (length and SHA-1) of `min_bytes` or more are stored once: the record with the
smallest id is the response, the others are revisits that name it and keep its digest, with
the HTTP header (which has the payload's length) but no payload.

Each task writes one archive under a random name; only archives listed by finished tasks are
read, so tasks may be repeated or lost.

Defined results: a null payload is the empty payload; several rows of one id are records of
their own, and those that equal the first response are responses too; rows without id are
responses, never referred to; a null address becomes the record's id, control and white-space characters
of an address are percent-encoded; further columns are ignored; an empty table gives no
archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from gzip import GzipFile
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.shared import shared_folder, stored

CHUNK = 65536
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, chunk_no long, last boolean, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, data binary"
)


def typed(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """page_id, url, payload (bytes), bytes, sha1 (hexadecimal), refers_to (null: a response)."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        data.alias("payload"),
        F.octet_length(data).cast("long").alias("bytes"),
        F.sha1(data).alias("sha1"),
    )
    shared = rows.filter((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull())
    shared = shared.groupBy("sha1", "bytes").agg(F.min("page_id").alias("first"), F.max("page_id").alias("top"))
    # written, so that both sides of the join below are plain and its hot digests can be split
    firsts = stored(shared.filter("top > first").drop("top"))
    found = rows.join(firsts, ["sha1", "bytes"], "left")
    return found.withColumn("refers_to", F.expr("nullif(first, page_id)")).withColumn(
        "refers_to", F.when(F.col("page_id").isNotNull(), F.col("refers_to"))
    )


def chunked(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk, in order within its record; revisits have one, without bytes."""
    size = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0)
    last = F.greatest(F.ceil(size / chunk) - 1, F.lit(0))
    rows = records.withColumn("n", last).withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    piece = F.substring("payload", (F.col("chunk_no") * chunk + 1).cast("int"), F.lit(chunk))
    return rows.select(
        "page_id", "url", "bytes", "sha1", "refers_to", "chunk_no", (F.col("chunk_no") == F.col("n")).alias("last"),
        F.when(F.col("refers_to").isNull(), piece).otherwise(F.lit(b"")).alias("data"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    number = name.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _header(row: dict) -> bytes:
    """The record's header, an empty line, and the HTTP header that begins its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n"
    revisit = row["refers_to"] is not None
    target = row["url"] or _name(row["page_id"]).strip("<>")
    target = "".join(c if c > " " and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in target)
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(row['page_id'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['bytes'])}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(row['refers_to'])}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write(chunks: DataFrame, folder: str) -> DataFrame:
    """Archives of the chunk rows, one for each task: file, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name, records, sink, member, seen = f"{base}/pages-{uuid4().hex}.warc.gz", 0, None, None, None
        for batch in batches:
            meta, data = batch.drop_columns(["data"]).to_pylist(), batch.column("data")
            for row, piece in zip(meta, data):
                sink = sink or fs.open_output_stream(name, compression=None)  # the members are compressed already
                if row["chunk_no"] == 0:
                    member, seen = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
                    sink.write(member.compress(_header(row)))
                    records += 1
                piece = piece.as_buffer()
                if piece is not None and piece.size:
                    seen.update(piece)
                    sink.write(member.compress(piece))
                if row["last"]:
                    if row["refers_to"] is None and seen.hexdigest() != row["sha1"]:
                        raise ValueError(f"record {row['page_id']}: the chunks do not make up the payload")
                    sink.write(member.compress(b"\r\n\r\n") + member.flush())
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [records]})

    return chunks.mapInArrow(run, "file string, records long")


def _fields(source) -> dict[str, str]:
    """Header lines up to the empty one; empty at the end of the archive."""
    found = {}
    while (line := source.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        found[name.lower()] = value
    return found


def records(source, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows (see RECORDS) of an open archive."""
    while head := _fields(source):
        length = int(head["content-length"])
        http_line = source.readline()
        http, used = {}, len(http_line)
        while (line := source.readline()) != b"\r\n":
            used += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            http[name.lower()] = value
        left, kind = length - used - 2, head["warc-type"]
        key, refers = _id(head["warc-record-id"]), head.get("warc-refers-to")
        if kind == "revisit":
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            yield key, 0, True, kind, _id(refers), int(http["content-length"]), digest, b""
        else:
            seen, total, number = hashlib.sha1(), 0, 0
            while True:
                data = source.read(min(chunk, left))
                if left and not data:
                    raise EOFError("the archive ends within a record")
                left -= len(data)
                total += len(data)
                seen.update(data)
                digest = base64.b32encode(seen.digest()).decode()
                yield key, number, left == 0, kind, None, total, digest, data
                number += 1
                if not left:
                    break
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its header says")


def read(archives: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives in the column `file`; without data, the last of each record."""
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as raw, GzipFile(fileobj=raw) as source:
                    for row in records(source, chunk):
                        if not with_data and not row[2]:
                            continue
                        rows.append(row if with_data else (*row[:-1], None))
                        held += len(row[-1]) if with_data else 0
                        if held > 8_000_000 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return archives.select("file").mapInArrow(run, RECORDS)


def write_and_read(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes all pages to archives and returns what the archives hold, a row for each page."""
    folder = shared_folder(pages.sparkSession)
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    archives = stored(write(chunked(typed(pages, min_bytes, key, url, payload)), folder))
    archives = archives.repartition(max(1, archives.count()))  # a row for each archive
    found = read(archives, folder, with_data=False)
    return found.select(F.col("page_id").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 by hand: five hexadecimal digits make four letters.
ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT h, n, min(page_id) AS first FROM p GROUP BY h, n)
SELECT page_id, n AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)
    for i in range(0, 32)], '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p JOIN f USING (h, n)
"""
