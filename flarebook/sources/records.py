"""Kafka-shaped records from a broker, a replay folder or text documents."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flarebook.schemas import ENVELOPE

RECORD_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")


@dataclass(frozen=True)
class FeedConfig:
    """What to subscribe to. Login settings of a broker go to ``extra_options``."""

    bootstrap_servers: str
    topic: str
    starting_offsets: str = "earliest"
    # Suits a live feed; None drains a large backlog without a cap per batch.
    max_offsets_per_trigger: int | None = 5_000
    # A broker keeps a bounded history. A lost range does not stop the job, unless
    # asked for; ``quality.reconcile`` counts the offsets that are missing.
    fail_on_data_loss: bool = False
    extra_options: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return {**options, **self.extra_options}


def kafka_stream(spark: SparkSession, feed: FeedConfig) -> DataFrame:
    return spark.readStream.format("kafka").options(**feed.options()).load().select(*RECORD_COLUMNS)


def replay_stream(
    spark: SparkSession,
    folder: str,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
    ignore_missing: bool = True,
    since: str | None = None,
) -> DataFrame:
    """Stored records as a stream, with the limits a broker source would have.

    ``since``, a time as text, leaves out the records before it, as a
    subscription does that starts at the latest ones.
    """
    reader = spark.readStream.schema(ENVELOPE).option("ignoreMissingFiles", str(ignore_missing).lower())
    reader = reader.option("latestFirst", str(latest_first).lower())
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = reader.parquet(folder)
    return records if since is None else records.where(F.col("timestamp") >= F.lit(since).cast("timestamp"))


def replay_batch(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(folder)


def documents(spark: SparkSession, path: str, topic: str = "documents") -> DataFrame:
    """One notice per text file. The file time stands in for the broker time."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.encode(F.col("_metadata.file_path"), "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("_metadata.file_path").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
