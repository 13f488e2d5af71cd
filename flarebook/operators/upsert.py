"""Keep a table current by key: create it, merge into it, or rewrite the folders that change."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flarebook.operators.gold import BURST_DAY, GOLD_DAYS, GOLD_SCOPES, GOLD_TABLES, burst_day, latency_sketches
from flarebook.workspace import children, read_lines, remove, write_lines

# Formats whose tables take MERGE INTO.
MERGE_FORMATS = frozenset({"delta", "iceberg"})

VERSION = "version-"
STAGED = "staged-"
# Files in a version's folder: it is complete (with the names of folders that became empty); the table has it.
COMPLETE, SWITCHED = "_complete", "_switched"

# Fixed value: how Spark names the folder of null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Folders by a hash of the key: so many that a few new keys rewrite a small part.
BUCKET = "key_bucket"
BUCKETS = 32

# The delays of each day, and the folder of a day's row.
SKETCHES = "latency_sketches"
BURST_YEAR = "burst_year"


def create_schemas(spark: SparkSession, names: list[str], location: str | None = None) -> None:
    for name in names:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def _described(spark: SparkSession, table: str, entry: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == entry).collect()
    return rows[0].data_type if rows else ""


def provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Provider").lower()


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Location")


def merge(updates: DataFrame, table: str, key: str) -> None:
    """For formats that change rows in place."""
    same = F.col(f"new_rows.{key}") == F.col(f"{table}.{key}")
    updates.alias("new_rows").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merged(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """What a merge leaves: all updates, and current rows no update replaces."""
    kept = current.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates)


def folder_column(name: str) -> str:
    return BURST_DAY if name in GOLD_DAYS else BUCKET


def laid_out(frame: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """With the column that the table has folders by, last."""
    if name in GOLD_DAYS:
        return frame
    return frame.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def in_folders(frame: DataFrame, folders: str, file_format: str = "parquet") -> DataFrameWriter:
    """Writer of a table with folders. Rows of a folder come together; large ones are split, small ones share a task."""
    return frame.hint("rebalance", F.col(folders)).write.format(file_format).partitionBy(folders)


def folder_name(folders: str, value: object) -> str:
    return f"{folders}={NULL_FOLDER if value is None else value}"


def _partition(name: str) -> str:
    """The partition that a folder holds, in SQL. Its values are days or numbers, which paths spell as they are."""
    column, value = name.split("=", 1)
    return f"PARTITION ({column} = {'null' if value == NULL_FOLDER else repr(value)})"


def _in(folders: str, values: list) -> Column:
    column, known = F.col(folders), [value for value in values if value is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in values else found


def _versions(spark: SparkSession, location: str) -> list[str]:
    return [name for name in children(spark, location) if name.startswith(VERSION)]


def _folders_of(spark: SparkSession, version: str) -> set[str]:
    """Folders that a version brought or emptied."""
    return {name for name in children(spark, version) if "=" in name} | set(read_lines(spark, f"{version}/{COMPLETE}") or ())


def switch(spark: SparkSession, table: str, version: str) -> None:
    """Point the table's partitions to a version's folders; done again, it changes nothing."""
    places = {name: f"LOCATION '{version}/{name}'" for name in children(spark, version) if "=" in name}
    there = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [name for name in places if name not in there]
    if new:
        added = " ".join(f"{_partition(name)} {places[name]}" for name in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for name in places:
        # How the partition of null is shown differs, so it is set in any case.
        if name in there or name.endswith(f"={NULL_FOLDER}"):
            spark.sql(f"ALTER TABLE {table} {_partition(name)} SET {places[name]}")
    for name in read_lines(spark, f"{version}/{COMPLETE}") or ():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(name)}")
    write_lines(spark, f"{version}/{SWITCHED}", [])
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, table: str, location: str) -> None:
    """End what an earlier run left, and remove what nobody reads any more.

    A version that is complete but not switched to is switched to now; one that
    is not complete goes. Folders that were replaced stay for readers that have
    begun, until the run after.
    """
    newer: set[str] = set()
    newest = True
    for name in reversed(_versions(spark, location)):
        version = f"{location}/{name}"
        if read_lines(spark, f"{version}/{COMPLETE}") is None:
            remove(spark, version)
            continue
        if newest and read_lines(spark, f"{version}/{SWITCHED}") is None:
            switch(spark, table, version)
        own = _folders_of(spark, version)
        held = {folder for folder in children(spark, version) if "=" in folder}
        for folder in newer & held:
            remove(spark, f"{version}/{folder}")
        if not newest:
            newer |= own
        newest = False
    for name in children(spark, location):
        if name.startswith(STAGED):
            remove(spark, f"{location}/{name}")


def upsert(
    updates: DataFrame,
    table: str,
    key: str,
    location: str,
    file_format: str = "parquet",
    folders: str = BUCKET,
    moves: bool = False,
) -> None:
    """Merge ``updates``, unique by ``key``, into ``table``, whose files lie in ``location``.

    The table is partitioned by the column ``folders``. Of a plain file table
    only those partitions are written again that updates go to or, where a key
    can move, come from; of the others at most the keys are read. A version is
    a folder with the new files of these partitions. Once it is complete, the
    catalog's partitions are pointed there one by one, so each partition is
    seen as it was or as it is. A job that dies before leaves the table as it
    was; one that dies in between is ended by the next run.
    """
    spark = updates.sparkSession
    if not spark.catalog.tableExists(table):
        for name in children(spark, location):  # of runs that did not come to a table
            remove(spark, f"{location}/{name}")
        path = f"{location}/{VERSION}{1:010d}"
        in_folders(updates, folders, file_format).option("path", path).saveAsTable(table)
        for marker in (COMPLETE, SWITCHED):
            write_lines(spark, f"{path}/{marker}", [])
        return
    kind = provider(spark, table)
    if kind in MERGE_FORMATS:
        merge(updates, table, key)
        return
    recover(spark, table, location)
    number = int(_versions(spark, location)[-1].removeprefix(VERSION)) + 1
    # The updates are read several times below, so they are computed once and stored.
    staged, path = f"{location}/{STAGED}{uuid.uuid4().hex}", f"{location}/{VERSION}{number:010d}"
    try:
        updates.write.format(kind).save(staged)
        stored = spark.read.schema(updates.schema).format(kind).load(staged)
        current = spark.read.table(table).select(*updates.columns)
        touched = stored.select(folders)
        if moves:
            touched = touched.union(current.select(key, folders).join(stored.select(key), key, "left_semi").select(folders))
        values = [row[0] for row in touched.distinct().collect()]
        rows = merged(current.where(_in(folders, values)), stored, key)
        in_folders(rows, folders, kind).save(path)
        names = {folder_name(folders, value) for value in values}
        write_lines(spark, f"{path}/{COMPLETE}", sorted(names - set(children(spark, path))))
        switch(spark, table, path)
    finally:
        remove(spark, staged)


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """A plain file table by its files as they are now, whatever becomes of the name."""
    frame = spark.read.table(table)
    partitions = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    schema = StructType([field for field in frame.schema if field.name not in partitions])
    files = frame.inputFiles()
    return spark.read.schema(schema).format(provider(spark, table)).load(files) if files else spark.createDataFrame([], schema)


def affected(silver: DataFrame, changed: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """All notices of the groups by ``scope`` that changed ones belong to.

    Groups are told apart by a short hash of their columns. Two that share one
    are both taken, each as a whole, so what is built from them is the same.
    Only the columns that a table is built from pass through the join.
    """
    group = F.xxhash64(*scope)
    groups = changed.select(group.alias("group")).distinct()
    return silver.withColumn("group", group).join(groups, "group", "left_semi").drop("group")


def build_gold(
    silver: DataFrame,
    schema: str,
    root: str,
    file_format: str = "parquet",
    changed: DataFrame | None = None,
) -> None:
    """Bring all Gold tables up to date with Silver; a second run changes nothing.

    With ``changed`` notices only, just their triggers, positions and times are
    built again, each from all of its notices. A table that is not there yet is
    built in full. The days' latency sketches follow the timing table.
    """
    spark = silver.sparkSession
    there = {name: spark.catalog.tableExists(f"{schema}.{name}") for name, _, _ in GOLD_TABLES}
    partial = changed is not None and any(there.values())
    for name, key, builder in GOLD_TABLES:
        whole = not partial or not there[name]
        source = silver if whole else affected(silver, changed, GOLD_SCOPES[name])
        rows = laid_out(builder(source), name, key)
        place = f"{root}/{name}"
        upsert(rows, f"{schema}.{name}", key, place, file_format, folder_column(name), GOLD_DAYS.get(name, False))
    sketches = f"{schema}.{SKETCHES}"
    timing = spark.read.table(f"{schema}.dim_event_timing")
    if partial and spark.catalog.tableExists(sketches):
        timing = timing.where(_in(BURST_DAY, [row[0] for row in changed.select(burst_day()).distinct().collect()]))
    rows = latency_sketches(timing).withColumn(BURST_YEAR, F.year(BURST_DAY))
    upsert(rows, sketches, BURST_DAY, f"{root}/{SKETCHES}", file_format, BURST_YEAR)
