"""Business and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The visible separator and the visible sign for null.
SEPARATOR = "\u241f"
NULL_SIGN = "\u2400"


def notice_key(trigger: Column, record: Column) -> Column:
    """``trigger-record``, ``trigger`` without a record, null without a trigger.

    ``record`` is the text of the digits: a number too long for its column
    still tells two revisions apart.
    """
    return F.when(trigger.isNotNull(), F.concat_ws("-", trigger.cast("string"), record))


def revision_order(key: Column, trigger: Column) -> list[Column]:
    """Sorts the revisions of a trigger by record number, exact for any length.

    Read back from the notice key; a revision without a record comes first.
    Among negative numbers more digits, and larger ones, mean less.
    """
    record = F.substr(key, F.length(trigger.cast("string")) + 2)
    negative = F.startswith(record, F.lit("-"))
    turned = F.translate(record, "0123456789", "9876543210")
    return [
        (F.length(record) > 0).alias("has_record"),
        (~negative).alias("not_negative"),
        F.when(negative, -F.length(record)).otherwise(F.length(record)).alias("digits"),
        F.when(negative, turned).otherwise(record).alias("record"),
    ]


def surrogate_key(*names: str) -> Column:
    """Hash of the member values: a rebuild gives the same key."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_SIGN)) for n in names]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
