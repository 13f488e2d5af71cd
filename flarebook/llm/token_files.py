"""Flat token files and the scan that finds their documents again.

A token file holds 16-bit ids and nothing else: no header, no index. A
document ends at the separator id. The scan reads a file in blocks, looks for
the separator in a whole block at once, and learns where documents begin and
end from a prefix scan over the blocks: the last separator seen before a block
is where its first document started, however many blocks ago that was.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flarebook.llm.tables import utf8

BLOCK_IDS = 1 << 19
LABEL_IDS = 5  # a 64-bit number and a flag, 15 bits in each id
FILE_DOCUMENTS = 100_000  # a file is read as one value
LABEL_BITS = 15


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def label_ids(number: int | None) -> list[int]:
    """A document's number as ids below 2^15; null is a value of its own."""
    value = 1 << 64 if number is None else number % (1 << 64)
    return [(value >> (LABEL_BITS * i)) % (1 << LABEL_BITS) for i in range(LABEL_IDS)]


def labels(ids: np.ndarray) -> list[int | None]:
    """The numbers back from rows of ids."""
    out = []
    for row in ids.tolist():
        value = sum(v << (LABEL_BITS * i) for i, v in enumerate(row))
        out.append(None if value >> 64 else value - (1 << 64) if value >> 63 else value)
    return out


def write_token_files(
    docs: DataFrame, folder: str, ranks: str, pattern: str, separator: int, file_documents: int = FILE_DOCUMENTS
) -> None:
    """Tokenize all documents into flat files of ``folder``, each of at most ``file_documents`` of one task.

    ``ranks`` is a file of byte pieces and ranks, ``pattern`` what splits a
    text before merging. ``separator`` must be free in the vocabulary and lie
    between 2^15 and 2^16. A document's stream is its number (``LABEL_IDS``
    ids that are never the separator), its tokens, the separator. Null and
    empty texts have no tokens. Spark writes the files: what its text writer
    puts after each row is the separator, so a lost task is just run again.
    """
    if not 1 << LABEL_BITS <= separator < 1 << 16:
        raise ValueError("the separator must lie between 2^15 and 2^16")

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks, pattern)
        for batch in batches:
            rows = []
            for number, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                ids = np.array(label_ids(number) + encoding.encode_ordinary(str(text, "utf-8")))
                if len(ids) and (ids.max() >= 1 << 16 or (ids == separator).any()):
                    raise ValueError("the vocabulary does not fit into 16 bits or holds the separator")
                rows.append(ids.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(streams, "ids binary")
    (
        found.select(F.col("ids").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator.to_bytes(2, "little").decode("latin-1"))
        .option("maxRecordsPerFile", file_documents)
        .text(folder)
    )


def separators(ids: np.ndarray, separator: int, block_ids: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Of each block of a file: its number, how many ids it has, and the separators' places in the file."""
    for block, start in enumerate(range(0, len(ids), block_ids)):
        part = ids[start : start + block_ids]
        yield block, len(part), start + np.flatnonzero(part == separator)


def numbers_at(ids: np.ndarray, places: np.ndarray) -> list[int | None]:
    """Of the documents that begin at ``places``; null where a file ends before the number does."""
    whole = places + LABEL_IDS <= len(ids)
    read = iter(labels(ids[places[whole][:, None] + np.arange(LABEL_IDS)]))
    return [next(read) if ok else None for ok in whole]


def scan_token_files(spark: SparkSession, folder: str, separator: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``doc_id``, ``file``, ``start``, ``n_tokens``, ``complete`` of each document in flat files.

    ``start`` counts ids from the file's start to the document's first token.
    A file is one row here, so it must stay below 2 GB (the writer makes one
    per input split). Ids after the last separator are a document that is not
    ``complete``: the file was cut off. An empty file has no documents.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "n_ids", "ends", "numbers", "first_number"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), utf8(batch.column("content"))):
                ids = np.frombuffer(content[: len(content) // 2 * 2], "<u2")
                first = numbers_at(ids, np.array([0]))[0]
                for block, held, ends in separators(ids, separator, block_ids):
                    row = (path, block, held, ends.tolist(), numbers_at(ids, ends + 1), first)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    found = files.mapInArrow(
        blocks, "file string, block long, n_ids long, ends array<long>, numbers array<long>, first_number long"
    )
    # The prefix scan: from the blocks before it, each block learns where its
    # first document began and which one that is. It orders blocks, not documents.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    n_ends = F.size("ends")
    last = F.when(
        n_ends > 0, F.struct(F.get("ends", n_ends - 1).alias("end"), F.get("numbers", n_ends - 1).alias("number"))
    )
    none_yet = F.struct(F.lit(-1).cast("long").alias("end"), F.col("first_number").alias("number"))
    scanned = found.select(
        "file",
        "ends",
        "numbers",
        F.coalesce(F.max(last).over(before), none_yet).alias("open"),
        (F.coalesce(F.sum("n_ids").over(before), F.lit(0)) + F.col("n_ids")).alias("ids_so_far"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("closes"),
    )
    begun = F.concat(
        F.array("open"),
        F.zip_with("ends", "numbers", lambda e, n: F.struct(e.alias("end"), n.alias("number"))),
    )
    cut_off = F.col("closes") & (F.col("ids_so_far") > F.get("begun", n_ends).getField("end") + 1)
    documents = (
        scanned.withColumn("begun", begun)
        .withColumn("n_complete", n_ends)
        .select(
            "file",
            "begun",
            "n_complete",
            F.posexplode(F.when(cut_off, F.concat("ends", F.array("ids_so_far"))).otherwise(F.col("ends"))).alias(
                "place", "end"
            ),
        )
        .withColumn("begun", F.get("begun", F.col("place")))
    )
    first_token = F.col("begun.end") + 1 + LABEL_IDS
    return documents.select(
        F.col("begun.number").alias("doc_id"),
        "file",
        first_token.alias("start"),
        F.greatest(F.col("end") - first_token, F.lit(0)).alias("n_tokens"),
        (F.col("place") < F.col("n_complete")).alias("complete"),
    )
