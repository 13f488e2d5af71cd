"""The three scheduled jobs over named tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flarebook.operators.gold import GOLD_TABLES
from flarebook.operators.silver import cleaned
from flarebook.operators.upsert import build_gold, create_schemas
from flarebook.schemas import SILVER, SILVER_COLUMNS
from flarebook.session import configure_session
from flarebook.streaming import jobs
from flarebook.workspace import exists

RAW = "notices_raw"
PARSED = "notices"


@dataclass(frozen=True)
class Layout:
    """Where tables, their files and the progress of the streams are kept.

    ``root`` must be a folder that all executors share. To parse all of Bronze
    again, after a change of the parser, go on with a new ``parser_version``: the
    next run starts from the beginning, in files and progress of its own, and
    then moves the Silver views there.
    """

    root: str
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    file_format: str = "parquet"
    parser_version: str = "1"

    def schema(self, layer: str) -> str:
        name = getattr(self, layer)
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}".rstrip("/")

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def silver_segments(self) -> str:
        return self.path("silver", f"{PARSED}-{self.parser_version}-segments")

    @property
    def silver_path(self) -> str:
        return self.path("silver", f"{PARSED}-{self.parser_version}")

    def create(self, spark: SparkSession) -> None:
        create_schemas(spark, [self.schema(layer) for layer in ("bronze", "silver", "gold")], f"{self.root}/schemas")


def ingest(spark: SparkSession, records: DataFrame, layout: Layout) -> None:
    """Append what the source has to Bronze. Build ``records`` with a source."""
    configure_session(spark)
    jobs.ingest_bronze(
        records,
        layout.checkpoint(RAW),
        layout.path("bronze", RAW),
        layout.table("bronze", RAW),
        layout.file_format,
    )


def parse(spark: SparkSession, layout: Layout) -> None:
    """Parse what is new in Bronze and route it to the two Silver tables."""
    configure_session(spark)
    bronze = spark.readStream.table(layout.table("bronze", RAW))
    progress = layout.checkpoint(f"{PARSED}-{layout.parser_version}")
    jobs.route_silver(bronze, progress, layout.silver_path, layout.file_format)
    jobs.create_silver_views(spark, layout.silver_path, layout.schema("silver"), layout.file_format)


def compact(spark: SparkSession, layout: Layout) -> None:
    """Gather Silver's small files for those who read all of it, as ``model`` does. Streams are not affected."""
    configure_session(spark)
    if layout.file_format == "parquet" and exists(spark, layout.silver_path):
        jobs.compact_silver(spark, layout.silver_path, layout.silver_segments)


def model(spark: SparkSession, layout: Layout) -> None:
    """Bring Gold up to date with what is new in Silver.

    The stream over Silver only tells which notices are new. A batch run again
    after a lost job builds the same groups from all of Silver once more. The
    first batch finds no tables and builds them in full; tables that are
    missing later, when nothing is new, are built in full as well.
    """
    configure_session(spark)

    def bring_up(silver: DataFrame, changed: DataFrame | None) -> None:
        build_gold(cleaned(silver), layout.schema("gold"), layout.path("gold", ""), layout.file_format, changed)

    def everything(session: SparkSession) -> DataFrame:
        if layout.file_format == "parquet":
            return jobs.read_compacted_silver(session, layout.silver_path, layout.silver_segments).select(*SILVER_COLUMNS)
        return jobs.read_silver(session, layout.silver_path, layout.file_format)

    if not exists(spark, layout.silver_path):
        bring_up(spark.createDataFrame([], SILVER), None)
        return
    jobs.each_batch(
        jobs.silver_stream(spark, layout.silver_path, layout.file_format),
        layout.checkpoint(f"gold-{layout.parser_version}"),
        lambda batch: bring_up(everything(batch.sparkSession), cleaned(batch)),
    )
    if not all(spark.catalog.tableExists(layout.table("gold", name)) for name, _, _ in GOLD_TABLES):
        bring_up(everything(spark), None)
    # The stream has a session of its own; this one may remember the last version.
    for name, _, _ in GOLD_TABLES:
        spark.catalog.refreshTable(layout.table("gold", name))
