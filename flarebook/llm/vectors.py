"""Vectors as columns and matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, zero: bool = True) -> Column:
    """Not null, all components finite; with ``zero=False`` at least one of them not zero."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))
    kept = vector.isNotNull() & finite
    return kept if zero else kept & F.exists(vector, lambda x: x != 0)


def vectors(rows: DataFrame, zero: bool = True) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the usable rows that have an id."""
    vector = F.col("embedding").cast("array<double>")
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector"), zero))
    )


def widest(rows: DataFrame) -> int:
    """Components of the longest vector; shorter ones count as ending in zeros."""
    return rows.agg(F.max(F.size("vector"))).first()[0] or 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths])] = values
    return out
