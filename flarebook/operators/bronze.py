"""Kafka records to Bronze: the payload as sent, with its broker coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_bronze(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("value").cast("string").alias("payload"),
        F.col("key").cast("string").alias("message_key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at"),
    )
