"""The two streaming steps. Each run drains what has arrived and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from flarebook.operators.bronze import to_bronze
from flarebook.operators.gold import BURST_DAY, burst_day
from flarebook.operators.silver import LaterField, parse_notices, with_later_fields
from flarebook.schemas import BRONZE, SILVER, SILVER_COLUMNS
from flarebook.session import settings
from flarebook.streaming.compaction import TARGET_BYTES, compact, read_compacted
from flarebook.workspace import exists

# Several tasks share a file by whole row groups, whose size is counted as packed. One of
# Parquet's own size holds close to a million notices, which a single task would parse.
BRONZE_FILES = {"parquet.block.size": 1 << 20}


def drain(
    frame: DataFrame,
    checkpoint: str,
    path: str,
    table: str | None = None,
    partition_by: tuple[str, ...] = (),
    file_format: str = "parquet",
) -> StreamingQuery:
    """Append everything available to ``path``, also known as ``table`` if given.

    The file sink commits each batch by its log, so a batch run again after a
    lost job replaces its own files and adds no rows.
    """
    writer = (
        frame.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.toTable(table) if table else writer.start()
    query.awaitTermination()
    return query


def bronze_writer(bronze: DataFrame) -> DataFrameWriter:
    """Writes Bronze in row groups small enough that even one file is parsed by many tasks."""
    return bronze.write.options(**BRONZE_FILES)


def ingest_bronze(
    records: DataFrame, checkpoint: str, path: str, table: str | None = None, file_format: str = "parquet"
) -> StreamingQuery:
    """Land the payloads as sent. Nothing is parsed, so Silver can be rebuilt."""
    # A stream's writer hands no options to Parquet.
    with settings(records.sparkSession, BRONZE_FILES):
        return drain(to_bronze(records), checkpoint, path, table, file_format=file_format)


def bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def route_silver(
    bronze: DataFrame,
    checkpoint: str,
    path: str,
    file_format: str = "parquet",
    later_fields: tuple[LaterField, ...] = (),
) -> StreamingQuery:
    """Parse once and route by folder: each notice lands in exactly one of the
    two tables, which are partitions of one sink with one checkpoint.

    With ``later_fields`` the stream goes on, from now on with these columns."""
    notices = with_later_fields(parse_notices(bronze), later_fields)
    return drain(notices, checkpoint, path, partition_by=("is_parsed",), file_format=file_format)


def rebuild_silver(
    bronze: DataFrame, path: str, file_format: str = "parquet", later_fields: tuple[LaterField, ...] = ()
) -> None:
    """Silver from all of Bronze, in place of what was there."""
    with_later_fields(parse_notices(bronze), later_fields).write.format(file_format).mode("overwrite").partitionBy("is_parsed").save(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).option("mergeSchema", "true").parquet(path)


def read_silver(
    spark: SparkSession, path: str, file_format: str = "parquet", later_fields: tuple[LaterField, ...] = ()
) -> DataFrame:
    """All notices. Files are read by name: what is older than a field has it among the rescued ones."""
    reader = spark.read.format(file_format)
    # Only plain files need to be told; the other formats know their schema.
    schema = ", ".join([SILVER, *[f"{field.name} {field.kind}" for field in later_fields]])
    reader = reader.schema(schema) if file_format == "parquet" else reader
    notices = with_later_fields(reader.load(path), later_fields)
    return notices.select(*SILVER_COLUMNS, *[field.name for field in later_fields])


def compact_silver(spark: SparkSession, path: str, segments: str, target_bytes: int = TARGET_BYTES) -> str | None:
    """Few large files of what the routing stream has written so far, in folders by result and day of the burst."""
    return compact(spark, path, segments, SILVER, ("is_parsed", BURST_DAY), target_bytes, _with_day)


def _with_day(silver: DataFrame) -> DataFrame:
    return silver.withColumn(BURST_DAY, burst_day())


def read_compacted_silver(spark: SparkSession, path: str, segments: str) -> DataFrame:
    """All notices with their day, from segments and from files that are newer than these.

    A filter on the day reads only the folders of these days, and the newer files.
    """
    return read_compacted(spark, path, segments, SILVER, _with_day).select(*SILVER_COLUMNS, BURST_DAY)


def silver_stream(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(file_format)
    reader = reader.schema(SILVER) if file_format == "parquet" else reader
    return reader.load(path).select(*SILVER_COLUMNS)


def each_batch(frame: DataFrame, checkpoint: str, work: Callable[[DataFrame], None]) -> StreamingQuery:
    """Hand everything that has arrived to ``work``, which must bear a repetition."""
    query = (
        frame.writeStream.foreachBatch(lambda batch, _: work(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def create_silver_views(spark: SparkSession, path: str, schema: str, file_format: str = "parquet") -> None:
    """Names for the two tables; a filter on the folder column prunes the other.

    The folder column reads back as text, since Spark takes no flags from paths.
    Before the first notice there are no files to learn columns from, and the
    names stand for empty tables.
    """
    if not exists(spark, path) or read_silver(spark, path, file_format).isEmpty():
        kinds = spark.createDataFrame([], SILVER).select(*SILVER_COLUMNS).dtypes
        nothing = ", ".join(f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in kinds)
        for name in ("notices_cleaned", "notices_quarantine"):
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT {nothing} WHERE false")
        return
    columns = ", ".join(
        f"CAST({c} AS BOOLEAN) AS {c}" if c == "is_parsed" else f"`{c}`" for c in SILVER_COLUMNS
    )
    for name, flag in (("notices_cleaned", "true"), ("notices_quarantine", "false")):
        spark.sql(
            f"CREATE OR REPLACE VIEW {schema}.{name} AS"
            f" SELECT {columns} FROM {file_format}.`{path}` WHERE is_parsed = '{flag}'"
        )
