"""Packing by powers of two: no sequence holds parts of two documents.

A document of n tokens is cut into the binary digits of n: as many pieces of
the greatest length as fit, then one piece for each further bit that is set,
longest first. Pieces of equal length form a bucket; each piece is a sequence
of its own, whose length is a power of two, so nothing is ever padded.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flarebook.llm.tables import held_here, utf8, word_chunks

END_OF_TEXT = 1
KNOWN_PIECES = 300_000
KNOWN_BYTES = 24_000_000  # of these pieces and their ids
IDS_AT_ONCE = 1_000_000  # in a batch of pieces

# How the tokenizer splits normalized text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Of characters that are the same in every version of Unicode and composed already.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-įı-ſ‐-‧]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+")


class WordTokens(dict):
    """Pieces of words and their ids as little-endian 32-bit values.

    For tokenizers whose tokens never span a blank, so that the ids of a text
    are those of its words. Where the tokenizer splits words by ``SPLIT`` after
    making them lower case, and a word has plain characters only, its pieces
    are looked up; otherwise whole words are. When more than ``most`` pieces
    or ``most_bytes`` of them are known, only those that are met again before
    that many new ones stay; that bounds memory and changes no result.
    """

    def __init__(self, tokenizer, most: int = KNOWN_PIECES, most_bytes: int = KNOWN_BYTES):
        super().__init__()
        self.tokenizer, self.most, self.most_bytes, self.bytes = tokenizer, most, most_bytes, 0
        self.older: dict[str, bytes] = {}
        shape = json.loads(tokenizer.to_str())
        steps = (shape["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        normal = [step["type"] for step in (shape["normalizer"] or {}).get("normalizers", [])]
        self.splits = steps[0].get("pattern") == {"Regex": SPLIT} and normal == ["NFC", "Replace", "Lowercase"]

    def ids(self, text: memoryview) -> bytes:
        return b"".join(map(self._chunk, word_chunks(text)))

    def _chunk(self, chunk: bytes) -> bytes:
        if not self.splits:
            return self._join([w.decode() for w in chunk.split()])
        text = chunk.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            return self._join(PIECE.findall(text.lower()))
        pieces: list[str] = []
        for word in map(bytes.decode, chunk.split()):
            plain = PLAIN.fullmatch(word) and "<|" not in word
            pieces += PIECE.findall(word.lower()) if plain else [word]
        return self._join(pieces)

    def _join(self, pieces: list[str]) -> bytes:
        if len(self) > self.most or self.bytes > self.most_bytes:
            self.older = dict(self) if self.bytes <= 2 * self.most_bytes else {}
            self.clear()
            self.bytes = 0
        return b"".join(map(self.__getitem__, pieces))

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece) or self._encoded(piece)
        self[piece] = found
        self.bytes += len(piece) + len(found)
        return found

    def _encoded(self, piece: str) -> bytes:
        if self.splits and piece.isascii() and piece.isprintable() and PIECE.fullmatch(piece):
            # One word without special characters: only the merges are left to do.
            ids = [token.id for token in self.tokenizer.model.tokenize(piece)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def _words(path: str) -> WordTokens:
    """One per Python worker, kept from task to task."""
    from tokenizers import Tokenizer

    return held_here(f"words of {path}", lambda: WordTokens(Tokenizer.from_file(path)))


def binary_pieces(n: int, longest: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of n tokens."""
    start = 0
    for _ in range(n // longest):
        yield start, longest
        start += longest
    length = longest >> 1
    while length:
        if n & length:
            yield start, length
            start += length
        length >>= 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    longest: int = 2048,
    end_id: int = END_OF_TEXT,
) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset`` of each piece.

    ``tokenizer`` is a file of the tokenizers library whose tokens do not span
    blanks, ``longest`` a power of two. Reads ``doc_id`` and ``text`` only. A
    null or empty text is one piece with ``end_id``; a null ``doc_id`` stays
    null; repeated rows are packed each. ``ids`` are little-endian 32-bit
    values. Nothing is shuffled: ``sequence_id`` grows along a partition.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the greatest length must be a power of two")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _words(tokenizer), struct.pack("<I", end_id)
        for batch in batches:
            held: list[tuple] = []
            weight = 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                ids = words.ids(text) + end
                total = len(ids) // 4
                for start, length in binary_pieces(total, longest):
                    held.append((doc, start, length, ids[4 * start : 4 * (start + length)], total))
                    weight += length
                    if weight >= IDS_AT_ONCE:
                        yield _rows(held)
                        held, weight = [], 0
            if held:
                yield _rows(held)

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        pieces, "doc_id long, start long, length long, ids binary, doc_tokens long"
    )
    return found.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """One folder per length, so a reader draws batches of equal lengths."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(folder)
