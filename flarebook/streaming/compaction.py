"""Many small files of a stream as few large ones, next to it.

A stream's folder has a log that names its files, and other streams remember
which of them they have read. So nothing in it is changed. What has arrived is
written again as a segment in another folder, with a list of the files that it
covers; small segments are taken into the next one. Batch readers read the
segments and those files that none covers yet, so they see each row once at any
time. Streams go on reading the folder itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flarebook.workspace import children, read_lines, remove, size_of, write_lines

SEGMENT = "segment-"
# In a segment's folder: it is complete, with the segments that it replaces; and the files that it covers.
COMPLETE, COVERS = "_replaces", "_covers"
TARGET_BYTES = 256 << 20

Prepare = Callable[[DataFrame], DataFrame]


def _complete(spark: SparkSession, segments: str) -> dict[str, list[str]]:
    """Complete segments and what each replaces."""
    names = [name for name in children(spark, segments) if name.startswith(SEGMENT)]
    found = {name: read_lines(spark, f"{segments}/{name}/{COMPLETE}") for name in names}
    return {name: replaced for name, replaced in found.items() if replaced is not None}


def current(spark: SparkSession, segments: str) -> list[str]:
    """Names of the segments that hold the rows now."""
    found = _complete(spark, segments)
    replaced = {name for names in found.values() for name in names}
    return sorted(set(found) - replaced)


def _covered(spark: SparkSession, segments: str) -> set[str]:
    found: set[str] = set()
    for name in current(spark, segments):
        found.update(read_lines(spark, f"{segments}/{name}/{COVERS}") or ())
    return found


def _rows(
    spark: SparkSession, names: list[str], segments: str, fresh: list[str], path: str, schema: StructType, prepare: Prepare
) -> DataFrame:
    rows = prepare(spark.createDataFrame([], schema))
    stored = rows.schema
    if fresh:
        rows = prepare(spark.read.schema(schema).option("basePath", path).parquet(*fresh))
    for name in names:
        rows = rows.unionByName(spark.read.schema(stored).parquet(f"{segments}/{name}"))
    return rows


def _fresh(spark: SparkSession, path: str, segments: str, schema: StructType) -> list[str]:
    """Files that the stream's log names and no segment covers."""
    return sorted(set(spark.read.schema(schema).parquet(path).inputFiles()) - _covered(spark, segments))


def read_compacted(
    spark: SparkSession, path: str, segments: str, schema: StructType | str, prepare: Prepare = lambda rows: rows
) -> DataFrame:
    """All rows of a stream's folder, once each, from as few files as there are.

    ``prepare`` is what they were compacted with.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fresh = _fresh(spark, path, segments, schema)
    return _rows(spark, current(spark, segments), segments, fresh, path, schema, prepare)


def compact(
    spark: SparkSession,
    path: str,
    segments: str,
    schema: StructType | str,
    partition_by: tuple[str, ...] = (),
    target_bytes: int = TARGET_BYTES,
    prepare: Prepare = lambda rows: rows,
) -> str | None:
    """Write what is new in a stream's folder, and segments below the target size, as one segment.

    ``prepare`` adds to the rows what segments have folders by. Returns its name, None if there was nothing to do. A segment counts once its
    last small file is written, and replaces others in the same moment; one that
    is not complete is removed by the next run, as are segments replaced in the
    run before, which a reader may still have open.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = _complete(spark, segments)
    now = current(spark, segments)
    for name in children(spark, segments):
        if name.startswith(SEGMENT) and name not in now and name not in found.get(max(found, default=""), ()):
            remove(spark, f"{segments}/{name}")
    fresh = _fresh(spark, path, segments, schema)
    if not fresh:
        return None
    small = [name for name in now if size_of(spark, f"{segments}/{name}") < target_bytes]
    number = max((int(name.removeprefix(SEGMENT)) for name in children(spark, segments) if name.startswith(SEGMENT)), default=0)
    name = f"{SEGMENT}{number + 1:010d}"
    place = f"{segments}/{name}"
    rows = _rows(spark, small, segments, fresh, path, schema, prepare)
    if partition_by:
        rows.hint("rebalance", *map(F.col, partition_by)).write.partitionBy(*partition_by).parquet(place)
    else:
        lengths = spark.read.format("binaryFile").load(fresh).agg(F.sum("length")).first()[0]
        files = math.ceil((lengths + sum(size_of(spark, f"{segments}/{one}") for one in small)) / target_bytes)
        rows.repartition(files).write.parquet(place)
    covered = set(fresh).union(*(read_lines(spark, f"{segments}/{one}/{COVERS}") or () for one in small))
    write_lines(spark, f"{place}/{COVERS}", sorted(covered))
    write_lines(spark, f"{place}/{COMPLETE}", small)
    return name
