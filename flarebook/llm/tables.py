"""Tables, scratch folders and batches that the operators of this package share."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: What separates words: the ASCII blanks. A fixed value of the word rules.
WORD = r"[^\x20\x09-\x0D]+"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def give_back() -> None:
    """Hand memory that is free again back to the system, as a worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Held = TypeVar("Held")
_held: dict[str, object] = {}


def held_here(name: str, make: Callable[[], Held]) -> Held:
    """What one operator keeps in this Python worker from task to task; what another one kept goes first."""
    if name not in _held:
        if _held:
            _held.clear()
            give_back()
        _held[name] = make()
    return _held[name]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors share.

    It lies in the folder named by ``spark.checkpoint.dir``; where that is not
    set, in the session's warehouse, which is shared as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def utf8(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each text of an Arrow column without copies; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width, kind = 8, "q"
    else:
        width, kind = 4, "i"
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return
    ends = memoryview(offsets).cast("B")[column.offset * width : (column.offset + len(column) + 1) * width].cast(kind)
    view = memoryview(data) if data is not None else memoryview(b"")
    for start, end in zip(ends[:-1], ends[1:]):
        yield view[start:end]


def word_chunks(text: memoryview, size: int = 4_000_000) -> Iterator[bytes]:
    """A text in chunks of about ``size`` bytes that end at blanks, so no word is cut."""
    start = 0
    while len(text) - start > size:
        found = _BLANK.search(text, start + size)
        if not found:
            break
        yield bytes(text[start : found.end()])
        start = found.end()
    yield bytes(text[start:])
