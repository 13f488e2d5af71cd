"""The stored layers behind the registered queries.

A layer is derived from the given tables by Spark jobs, written once per
application and table folder, and read by every query that needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flarebook.operators.bronze import to_bronze
from flarebook.operators.gold import GOLD_TABLES, latency_sketches
from flarebook.operators.silver import cleaned, quarantine
from flarebook.operators.upsert import folder_column, in_folders, laid_out
from flarebook.session import configure_session
from flarebook.sources.records import replay_batch
from flarebook.sources.sample import write_replay
from flarebook.streaming.jobs import read_silver, rebuild_silver
from flarebook.workspace import changed_at, new_folder

_STORED: dict[tuple, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Layers:
    def __init__(self, spark: SparkSession, tables: str):
        self.spark = configure_session(spark)
        self.tables = tables

    def _stored(self, layer: str, write) -> str:
        """Path of a layer; it only counts as stored once its job is complete."""
        changed = changed_at(self.spark, f"{self.tables}/events.parquet")
        key = (self.spark.sparkContext.applicationId, self.tables, changed, layer)
        if key not in _STORED:
            path = new_folder(self.spark, layer)
            write(path)
            _STORED[key] = path
        return _STORED[key]

    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.tables}/events.parquet")

    def replay(self) -> str:
        return self._stored("replay", lambda path: write_replay(self.spark, self.events(), path))

    def records(self) -> DataFrame:
        return replay_batch(self.spark, self.replay())

    def bronze(self) -> DataFrame:
        return to_bronze(self.records())

    def silver(self) -> DataFrame:
        path = self._stored("silver", lambda path: rebuild_silver(self.bronze(), path))
        return read_silver(self.spark, path)

    def cleaned(self) -> DataFrame:
        return cleaned(self.silver())

    def quarantine(self) -> DataFrame:
        return quarantine(self.silver())

    def gold(self, name: str) -> DataFrame:
        def write(path: str) -> None:
            key, builder = {table: (key, build) for table, key, build in GOLD_TABLES}[name]
            frame = laid_out(builder(self.cleaned()), name, key)
            in_folders(frame, folder_column(name)).save(path)
            _SCHEMAS[path] = frame.schema

        path = self._stored(name, write)
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def shown(self, name: str) -> DataFrame:
        """A Gold table without the column of its folders."""
        return self.gold(name).drop(folder_column(name))

    def fact(self) -> DataFrame:
        return self.gold("fact_notices")

    def timing(self) -> DataFrame:
        return self.gold("dim_event_timing")

    def spatial(self) -> DataFrame:
        return self.gold("dim_spatial_coords")

    def sun_moon(self) -> DataFrame:
        return self.gold("dim_sun_moon_coords")

    def latency_sketches(self) -> DataFrame:
        path = self._stored("latency-sketches", lambda path: latency_sketches(self.timing()).write.parquet(path))
        return self.spark.read.parquet(path)
