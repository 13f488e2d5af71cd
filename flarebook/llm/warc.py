"""WARC archives: written with one gzip member per record, read back one after another.

Records with equal payloads are stored once: the first is a response, others
are revisits of it that carry its digest and HTTP header only.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flarebook.llm.tables import utf8

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # window bits of a gzip member
HEAD_END = b"\r\n\r\n"

DATE = "2000-01-01T00:00:00Z"  # pages carry no date
ARCHIVE_BYTES = 8_000_000
READ_BYTES = 1 << 16


def sha1(data: bytes | memoryview) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(head: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member; the same record gives the same bytes."""
    lines = [VERSION, *(f"{name}: {value}" for name, value in head), f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    record = "\r\n".join(lines).encode() + HEAD_END + block + HEAD_END
    return squeeze.compress(record) + squeeze.flush()


def name_of(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page: int | None, url: str | None, payload: memoryview, first: int | None, revisit: bool) -> bytes:
    digest = sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name_of(page)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if revisit:
        head += [("WARC-Refers-To", name_of(first)), ("WARC-Profile", PROFILE)]
    return member(head, block)


def closing() -> bytes:
    """The record that ends an archive. It is what Spark's text writer puts after each row."""
    block = b"software: flarebook\r\nformat: WARC File Format 1.1\r\n"
    head = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", "<urn:archive:end>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/warc-fields"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
    ]
    return member(head, block)


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id``, ``digest`` and ``first_id`` of the pages whose payload an earlier page has."""
    payload = F.coalesce("html", F.lit(""))
    narrow = pages.filter(F.octet_length(payload) >= least_bytes).select(
        "page_id", F.unhex(F.sha2(payload, 256)).alias("digest")
    )
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return (
        narrow.join(firsts.filter("n > 1").drop("n"), "digest")
        .filter(F.coalesce(F.col("page_id") > F.col("first_id"), F.col("first_id").isNotNull()))
        .distinct()
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archive ``page_id``, ``url`` and ``html`` of all rows into gzip files of ``folder``.

    A null html is empty, a null url is left out. Of payloads of at least
    ``least_bytes`` that are equal, the one with the smallest ``page_id`` is
    the response; a null ``page_id`` is the largest. Rows that repeat the
    smallest ``page_id`` are responses too. Records gather to archives of
    ``archive_bytes`` at most, unless a single one is larger. Spark writes the
    files, so a lost task is just run again.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            known = [batch.column(c).to_pylist() for c in ("page_id", "url", "first_id", "revisit")]
            for page, url, first, revisit, payload in zip(*known, utf8(batch.column("html"))):
                made = record(page, url, payload, first, revisit)
                if held and size + len(made) > archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], names=["archive"])
                    held, size = [], 0
                held.append(made)
                size += len(made)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], names=["archive"])

    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    again = revisits(given, least_bytes).select(
        F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first_id"
    )
    # The payload moves by page, never by digest: copies of one page are spread.
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (
        F.unhex(F.sha2("html", 256)) == F.col("again_digest")
    )
    marked = given.join(again, same, "left").select(
        "page_id", "url", "html", "first_id", F.col("again_digest").isNotNull().alias("revisit")
    )
    (
        marked.mapInArrow(archives, "archive binary")
        .select(F.col("archive").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", closing().decode("latin-1"))
        .option("maxRecordsPerFile", 1)  # a row is a whole archive
        .text(folder)
    )


def members(content: memoryview, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The records of an archive, inflated piece by piece."""
    at = 0
    while at < len(content):
        inflate, parts = zlib.decompressobj(GZIP), []
        while not inflate.eof:
            if at >= len(content):
                raise ValueError("an archive ends within a record")
            piece = content[at : at + read_bytes]
            parts.append(inflate.decompress(piece))
            at += len(piece)
        at -= len(inflate.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Head and block of a record, framed by its length; digests must agree."""
    end = data.index(HEAD_END)
    version, *lines = data[:end].decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:20]}")
    head = dict(line.split(": ", 1) for line in lines)
    start = end + len(HEAD_END)
    length = int(head["Content-Length"])
    block = data[start : start + length]
    if len(block) != length or data[start + length :] != HEAD_END:
        raise ValueError(f"wrong length: {head['WARC-Record-ID']}")
    if head["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
        raise ValueError(f"wrong block digest: {head['WARC-Record-ID']}")
    return head, block


def page_row(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = head["WARC-Type"]
    http, payload = block.split(HEAD_END, 1)
    said = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != said or sha1(payload) != digest):
        raise ValueError(f"wrong payload: {head['WARC-Record-ID']}")
    first = page_of(head["WARC-Refers-To"]) if kind == "revisit" else None
    kept = payload if with_payload and kind == "response" else None
    return page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), said, digest, kind, first, kept


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    Every record's length and digests are verified; a bad one fails the job. A
    revisit has the size and digest of the full payload and a null ``payload``.
    An archive is one row here, so it must stay below 2 GB.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in utf8(batch.column("content")):
                rows, size = [], 0
                for head, block in map(parse, members(content)):
                    if head["WARC-Type"] not in ("response", "revisit"):
                        continue
                    rows.append(page_row(head, block, with_payload))
                    size += 200 + len(block)
                    if size >= 8_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(
        records,
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary",
    )
