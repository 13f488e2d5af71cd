"""Sources, streaming steps, upsert and folders."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flarebook import pipeline, workspace
from flarebook.operators.bronze import to_bronze
from flarebook.operators.silver import LaterField, cleaned, parse_notices, with_later_fields
from flarebook.operators import upsert as gold_upsert
from flarebook.operators.gold import GOLD_TABLES
from flarebook.operators.upsert import build_gold, create_schemas, table_location, upsert
from flarebook.plans import reports
from flarebook.schemas import BRONZE, ENVELOPE
from flarebook.sources.records import FeedConfig, documents, replay_batch, replay_stream
from flarebook.sources.sample import write_replay
from flarebook.streaming import compaction, jobs
from flarebook.streaming.compaction import compact, current, read_compacted
from notices import FULL, STRAY, bronze_frame, notice

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def replay(spark):
    path = workspace.new_folder(spark, "replay")
    write_replay(spark, spark.read.parquet(f"{TABLES}/events.parquet"), path)
    return path


@pytest.fixture
def schema(spark):
    name = f"s_{uuid.uuid4().hex}"
    create_schemas(spark, [name], workspace.new_folder(spark, "schemas"))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def folder(spark):
    return workspace.new_folder(spark, "test")


def test_feed_options():
    options = FeedConfig("host:9092", "topic", extra_options={"kafka.security.protocol": "SASL_SSL"}).options()
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "SASL_SSL",
    }
    backlog = FeedConfig("h", "t", starting_offsets="latest", max_offsets_per_trigger=None).options()
    assert backlog["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in backlog
    assert FeedConfig("h", "t", fail_on_data_loss=True).options()["failOnDataLoss"] == "true"


def test_bronze_shape(spark, replay):
    frame = to_bronze(replay_batch(spark, replay))
    assert ", ".join(f"{n} {k}" for n, k in frame.dtypes) == BRONZE
    assert ", ".join(f"{n} {k}" for n, k in replay_batch(spark, replay).dtypes) == ENVELOPE


def test_ingest_in_batches_and_only_once(spark, replay):
    path, progress = folder(spark), folder(spark)
    first = jobs.ingest_bronze(replay_stream(spark, replay, max_files_per_trigger=3), progress, path)
    assert len([p for p in first.recentProgress if p["numInputRows"]]) > 1
    assert jobs.read_bronze(spark, path).count() == 1000
    second = jobs.ingest_bronze(replay_stream(spark, replay), progress, path)
    assert not [p for p in second.recentProgress if p["numInputRows"]]
    assert jobs.read_bronze(spark, path).count() == 1000


def test_new_records_are_picked_up(spark):
    source, path, progress = folder(spark), folder(spark), folder(spark)
    record = spark.createDataFrame([(None, b"x", "t", 0, 1, None, 0)], ENVELOPE)
    for expected in (1, 2):
        record.write.mode("append").parquet(source)
        jobs.ingest_bronze(replay_stream(spark, source), progress, path)
        assert jobs.read_bronze(spark, path).count() == expected


def test_table_sink(spark, replay, schema):
    path = folder(spark)
    jobs.ingest_bronze(replay_stream(spark, replay), folder(spark), path, table=f"{schema}.notices_raw")
    assert spark.read.table(f"{schema}.notices_raw").count() == 1000
    assert spark.readStream.table(f"{schema}.notices_raw").isStreaming


def test_routing_and_views(spark, replay, schema):
    bronze, silver = folder(spark), folder(spark)
    jobs.ingest_bronze(replay_stream(spark, replay), folder(spark), bronze)
    query = jobs.route_silver(jobs.bronze_stream(spark, bronze, 2), folder(spark), silver)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    jobs.create_silver_views(spark, silver, schema)
    clean, rest = (spark.read.table(f"{schema}.notices_{n}") for n in ("cleaned", "quarantine"))
    assert clean.count() + rest.count() == 1000
    assert clean.where("trigger_num IS NULL").count() == 0 == rest.where("trigger_num IS NOT NULL").count()
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_parsed" in plan


def test_evolved_bronze_files_read_together(spark):
    path = folder(spark)
    rows = bronze_frame(spark, [FULL])
    rows.write.parquet(path)
    rows.withColumn("headers", F.lit("h")).write.mode("append").parquet(path)
    assert jobs.read_bronze(spark, path).count() == 2
    assert "headers" in spark.read.option("mergeSchema", "true").parquet(path).columns


def test_documents_are_one_notice_each(spark, tmp_path):
    for name, text in (("a", FULL), ("b", STRAY)):
        (tmp_path / f"{name}.txt").write_text(text)
    parsed = parse_notices(to_bronze(documents(spark, str(tmp_path))))
    assert sorted(r.is_parsed for r in parsed.collect()) == [False, True]


def bucketed(spark, rows):
    return spark.createDataFrame(rows, "k string, v int").withColumn("b", F.col("v") % 10)


def put(rows, table, place, **options):
    upsert(rows, table, "k", place, folders="b", moves=True, **options)


def stored(spark, table):
    return sorted((r.k, r.v) for r in spark.read.table(table).collect())


def files_of(spark, table):
    return {"/".join(f.rsplit("/", 2)[1:]) for f in spark.read.table(table).inputFiles()}


def test_upsert_creates_updates_and_inserts(spark, schema):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", 1), ("b", 2)]), table, place)
    for _ in range(3):
        put(bucketed(spark, [("b", 3), ("c", 4)]), table, place)
        assert stored(spark, table) == [("a", 1), ("b", 3), ("c", 4)]
    folders = {name: [n for n in workspace.children(spark, f"{place}/{name}") if "=" in n] for name in workspace.children(spark, place)}
    # What "b" left behind at first is gone; what the last two runs replaced is kept for readers that have begun.
    assert folders == {
        "version-0000000001": ["b=1"], "version-0000000002": ["b=3", "b=4"], "version-0000000003": ["b=3", "b=4"],
        "version-0000000004": ["b=3", "b=4"],
    }


def test_upsert_keeps_null_folders(spark, schema):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", None), ("b", None), ("c", 1)]), table, place)
    put(bucketed(spark, [("a", 5), ("c", None), ("d", None)]), table, place)
    put(bucketed(spark, []), table, place)
    assert sorted(spark.read.table(table).select("k", "v").collect()) == [("a", 5), ("b", None), ("c", None), ("d", None)]


def test_untouched_folders_keep_their_files(spark, schema):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [(f"k{i}", i) for i in range(100)]), table, place)
    before = files_of(spark, table)
    put(bucketed(spark, [("k3", 13), ("new", 23)]), table, place)
    after = files_of(spark, table)
    assert len(stored(spark, table)) == 101 and len(before - after) == len(after - before) == 1


def test_failed_update_leaves_the_table_and_no_files(spark, schema, monkeypatch):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", 1)]), table, place)
    names = workspace.children(spark, place)
    monkeypatch.setattr(gold_upsert, "merged", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        put(bucketed(spark, [("b", 3)]), table, place)
    assert stored(spark, table) == [("a", 1)] and workspace.children(spark, place) == names


@pytest.mark.parametrize("statements", range(3))
def test_a_run_that_stopped_while_partitions_are_switched_is_ended_by_the_next(spark, schema, monkeypatch, statements):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", 1), ("b", 2), ("c", 3)]), table, place)
    left, run = iter(range(statements)), type(spark).sql

    def sql_or_stop(session, text, *more, **named):
        if text.startswith("ALTER") and next(left, None) is None:
            raise OSError("stopped")
        return run(session, text, *more, **named)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", sql_or_stop)
        with pytest.raises(OSError, match="stopped"):
            put(bucketed(spark, [("a", 4), ("b", 12)]), table, place)
    put(bucketed(spark, [("c", 13)]), table, place)
    assert stored(spark, table) == [("a", 4), ("b", 12), ("c", 13)]


def test_a_version_that_is_not_complete_counts_for_nothing(spark, schema):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", 1)]), table, place)
    bucketed(spark, [("a", 11)]).write.partitionBy("b").parquet(f"{place}/version-0000000002")
    put(bucketed(spark, [("b", 2)]), table, place)
    assert stored(spark, table) == [("a", 1), ("b", 2)]
    assert workspace.children(spark, f"{place}/version-0000000002")[-1] == "b=2"


def test_a_reader_that_has_begun_can_end(spark, schema):
    table, place = f"{schema}.t", folder(spark)
    put(bucketed(spark, [("a", 1), ("b", 2)]), table, place)
    begun = gold_upsert.table_files(spark, table)
    put(bucketed(spark, [("a", 11)]), table, place)
    assert sorted((r.k, r.v) for r in begun.collect()) == [("a", 1), ("b", 2)]


def test_one_new_notice_rewrites_few_files(spark, replay, schema):
    silver, place = cleaned(parse_notices(to_bronze(replay_batch(spark, replay)))), folder(spark)
    path = folder(spark)
    silver.write.parquet(path)
    silver = spark.read.parquet(path)
    build_gold(silver, schema, place)
    tables = [f"{schema}.{name}" for name, _, _ in GOLD_TABLES]
    before = {table: files_of(spark, table) for table in tables}
    new = cleaned(parse_notices(bronze_frame(spark, [FULL])))
    build_gold(silver.unionByName(new), schema, place, changed=new)
    for table in tables:
        after = files_of(spark, table)
        assert len(before[table]) > 20 and len(before[table] - after) <= 1 and 1 <= len(after - before[table]) <= 2


def test_only_recent_days_are_read(spark, replay, schema):
    build_gold(cleaned(parse_notices(to_bronze(replay_batch(spark, replay)))), schema, folder(spark))
    fact, timing, spatial = (
        spark.read.table(f"{schema}.{name}") for name in ("fact_notices", "dim_event_timing", "dim_spatial_coords")
    )
    recent = reports.recent_bursts(fact, timing, spatial, F.lit("2024-02-28 12:00:00").cast("timestamp"))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(burst_day") == 2
    days = lambda frame: {f.split("burst_day=")[1].split("/")[0] for f in frame.inputFiles() if "burst_day=" in f}
    assert len(days(fact)) > 25 and days(recent) == {day for day in days(fact) if "2024-01-29" <= day < "3"}
    assert len(recent.inputFiles()) <= 2 * len(days(recent)) + len(spatial.inputFiles())
    whole = fact.where("is_latest_revision").join(timing, "timing_key").join(spatial, "spatial_key")
    since = F.lit("2024-01-29 12:00:00").cast("timestamp")
    assert recent.count() == whole.where(F.col("burst_time") >= since).count() > 0


def test_gold_rerun_changes_nothing_and_new_revision_moves_the_flag(spark, schema):
    def silver(*payloads):
        return cleaned(parse_notices(bronze_frame(spark, payloads)))

    def facts():
        return sorted((r.notice_key, r.is_latest_revision) for r in spark.read.table(f"{schema}.fact_notices").collect())

    old, place = [notice("RECORD_NUM: 1"), notice("RECORD_NUM: 2")], folder(spark)
    for _ in range(2):
        build_gold(silver(*old), schema, place)
        assert facts() == [("1-1", False), ("1-2", True)]
    build_gold(silver(*old, notice("RECORD_NUM: 3")), schema, place)
    assert facts() == [("1-1", False), ("1-2", False), ("1-3", True)]
    # What vanished from Silver stays in Gold.
    build_gold(silver(notice("RECORD_NUM: 9", trigger="7")), schema, place)
    assert ("1-3", True) in facts() and ("7-9", True) in facts()


def test_new_notices_only_touch_their_groups(spark, schema):
    def silver(*payloads):
        return cleaned(parse_notices(bronze_frame(spark, payloads)))

    def facts():
        return {r.notice_key: (r.is_latest_revision, r.comments) for r in spark.read.table(f"{schema}.fact_notices").collect()}

    place = folder(spark)
    old = [notice("RECORD_NUM: 1"), notice("RECORD_NUM: 2"), notice("RECORD_NUM: 5", "COMMENTS: old", trigger="8")]
    build_gold(silver(*old), schema, place)
    late = notice("RECORD_NUM: 3000000000", "COMMENTS: late")
    # Trigger 8 reads differently now, but none of its notices is new.
    every = [*old[:2], notice("RECORD_NUM: 5", "COMMENTS: other", trigger="8"), late]
    for _ in range(2):
        build_gold(silver(*every), schema, place, changed=silver(late))
        assert facts() == {
            "1-1": (False, None), "1-2": (False, None), "1-3000000000": (True, "late"), "8-5": (True, "old")
        }


def test_pipeline_over_named_tables(spark, replay, monkeypatch):
    tag = uuid.uuid4().hex
    layout = pipeline.Layout(folder(spark), bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}")
    assert pipeline.Layout("r", catalog="c").table("gold", "t") == "c.gold.t"
    layout.create(spark)
    facts, built = [], []
    whole = gold_upsert.upsert

    def seen(rows, table, *more):
        built.append(table.rsplit(".", 1)[-1])
        whole(rows, table, *more)

    monkeypatch.setattr(gold_upsert, "upsert", seen)
    for _ in range(3):
        pipeline.ingest(spark, replay_stream(spark, replay), layout)
        pipeline.parse(spark, layout)
        pipeline.compact(spark, layout)
        pipeline.model(spark, layout)
        assert spark.read.table(layout.table("bronze", "notices_raw")).count() == 1000
        facts.append(sorted(r.notice_key for r in spark.read.table(layout.table("gold", "fact_notices")).collect()))
    clean = spark.read.table(layout.table("silver", "notices_cleaned"))
    for name, _, _ in GOLD_TABLES:
        place = layout.path("gold", name)
        assert f"{layout.root}/gold/{name}/version-" in table_location(spark, layout.table("gold", name))
        assert workspace.children(spark, place) == ["version-0000000001"]
        # Built once: the first batch does, the later runs have nothing to do.
        assert built.count(name) == 1
    assert facts[0] == facts[1] == facts[2] == sorted(r.notice_key for r in clean.select("notice_key").distinct().collect())
    rows = clean.count()
    for _ in range(2):
        pipeline.parse(spark, replace(layout, parser_version="2"))
        again = spark.read.table(layout.table("silver", "notices_cleaned"))
        assert any("notices-2" in f for f in again.inputFiles())
        assert again.count() == rows
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {layout.schema(layer)} CASCADE")


@pytest.mark.parametrize("payloads", [[], [STRAY]])
def test_pipeline_without_notices(spark, payloads):
    tag, source = uuid.uuid4().hex, folder(spark)
    layout = pipeline.Layout(folder(spark), bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}")
    layout.create(spark)

    def run(texts):
        rows = [(None, text.encode(), "t", 0, i, None, 0) for i, text in enumerate(texts)]
        spark.createDataFrame(rows, ENVELOPE).write.mode("append").parquet(source)
        pipeline.ingest(spark, replay_stream(spark, source), layout)
        pipeline.parse(spark, layout)
        pipeline.model(spark, layout)
        count = lambda layer, name: spark.read.table(layout.table(layer, name)).count()
        return count("silver", "notices_cleaned"), count("silver", "notices_quarantine"), count("gold", "fact_notices")

    assert run(payloads) == (0, len(payloads), 0)
    assert run([FULL]) == (1, len(payloads), 1)
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {layout.schema(layer)} CASCADE")


def small_files(spark, path, batches, first=0):
    """A stream that has written a file for each of so many batches."""
    source, progress = f"{path}-source", f"{path}-progress"
    rows = spark.range(first, first + batches).select("id", (F.col("id") % 2).cast("int").alias("odd"))
    rows.repartition(batches, "id").write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long, odd int").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.drain(stream.coalesce(1), progress, path, partition_by=("odd",))


def test_compaction_of_many_batches(spark):
    path, segments, schema = folder(spark), folder(spark), "id long, odd int"
    read = lambda: read_compacted(spark, path, segments, schema)
    ids = lambda frame: sorted(r.id for r in frame.collect())
    small_files(spark, path, 200)
    before = len(read().inputFiles())
    assert before > 100 and ids(read()) == list(range(200))
    assert compact(spark, path, segments, schema, ("odd",)) == "segment-0000000001"
    assert len(read().inputFiles()) <= 4 < before and ids(read()) == list(range(200))
    # Nothing new: nothing is written.
    assert compact(spark, path, segments, schema, ("odd",)) is None
    # The stream goes on, its own checkpoint and readers do not mind.
    small_files(spark, path, 10, 200)
    assert ids(spark.read.schema(schema).parquet(path)) == ids(read()) == list(range(210))
    open_reader = read()
    assert compact(spark, path, segments, schema, ("odd",)) == "segment-0000000002"
    assert ids(open_reader) == ids(read()) == list(range(210)) and len(read().inputFiles()) <= 4
    assert current(spark, segments) == ["segment-0000000002"]
    seen = []
    again = jobs.each_batch(
        spark.readStream.schema(schema).parquet(path), folder(spark), lambda batch: seen.extend(ids(batch))
    )
    assert again.exception() is None and sorted(seen) == list(range(210))


def test_a_segment_that_is_not_complete_counts_for_nothing(spark, monkeypatch):
    path, segments, schema = folder(spark), folder(spark), "id long, odd int"
    small_files(spark, path, 8)
    compact(spark, path, segments, schema)
    small_files(spark, path, 8, 8)
    whole = compaction.write_lines
    for stops_at in (0, 1):
        left = iter(range(stops_at))

        def write_or_stop(*given):
            if next(left, None) is None:
                raise OSError("stopped")
            whole(*given)

        with monkeypatch.context() as patched:
            patched.setattr(compaction, "write_lines", write_or_stop)
            with pytest.raises(OSError, match="stopped"):
                compact(spark, path, segments, schema)
        assert sorted(r.id for r in read_compacted(spark, path, segments, schema).collect()) == list(range(16))
    compact(spark, path, segments, schema)
    assert sorted(r.id for r in read_compacted(spark, path, segments, schema).collect()) == list(range(16))
    assert current(spark, segments) == [workspace.children(spark, segments)[-1]]


def test_compacted_silver_is_read_by_day(spark, replay):
    bronze, silver, progress, segments = (folder(spark) for _ in range(4))
    every = to_bronze(replay_batch(spark, replay))
    for half in (0, 1):
        every.where(F.col("offset") % 2 == half).write.mode("append").parquet(bronze)
        jobs.route_silver(jobs.bronze_stream(spark, bronze), progress, silver)
        if half == 0:
            jobs.compact_silver(spark, silver, segments)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    whole = jobs.read_compacted_silver(spark, silver, segments)
    recent = whole.where("is_parsed AND burst_day >= '2024-01-29'")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall(r"PartitionFilters: \[[^\]]*burst_day#\d+ >= 2024-01-29", plan)) == 1, plan
    wanted = cleaned(parse_notices(every)).where("burst_time >= '2024-01-29'")
    assert whole.count() == 1000 and recent.count() == wanted.count() > 0


def test_large_segments_are_left_alone(spark):
    path, segments, schema = folder(spark), folder(spark), "id long, odd int"
    for first in (0, 4):
        small_files(spark, path, 4, first)
        compact(spark, path, segments, schema, target_bytes=1)
    assert current(spark, segments) == ["segment-0000000001", "segment-0000000002"]
    assert sorted(r.id for r in read_compacted(spark, path, segments, schema).collect()) == list(range(8))


def test_silver_of_two_versions_and_the_same_gold(spark, replay):
    bronze, silver, progress = folder(spark), folder(spark), folder(spark)
    later = (LaterField("spacecraft", "SPACECRAFT"), LaterField("unit", "SPACECRAFT", "bigint"), LaterField("none", "NOT_SENT", "double"))
    every = to_bronze(replay_batch(spark, replay))
    for half, fields in ((0, ()), (1, later)):
        every.where(F.col("offset") % 2 == half).write.mode("append").parquet(bronze)
        jobs.route_silver(jobs.bronze_stream(spark, bronze), progress, silver, later_fields=fields)
    old, new = jobs.read_silver(spark, silver), jobs.read_silver(spark, silver, later_fields=later)
    columns = ["offset", "rescued_fields", "spacecraft", "unit", "none"]
    wanted = with_later_fields(parse_notices(every), later)
    shown = lambda frame: sorted(map(str, frame.select(*columns).collect()))
    assert shown(new) == shown(wanted) == shown(with_later_fields(new, later)) and old.count() == 1000
    assert new.where("spacecraft IS NOT NULL").count() > 100 == new.where("array_contains(map_keys(rescued_fields), 'SPACECRAFT')").count() + 100
    for _, _, build in GOLD_TABLES:
        digests = [sorted(map(str, build(cleaned(s)).drop("ingested_at").collect())) for s in (old, new)]
        assert digests[0] == digests[1]


def test_replay_from_the_latest_records(spark, replay):
    path, middle = folder(spark), "2024-01-16 00:00:00"
    jobs.ingest_bronze(replay_stream(spark, replay, since=middle), folder(spark), path)
    rows = jobs.read_bronze(spark, path)
    late = replay_batch(spark, replay).where(F.col("timestamp") >= F.lit(middle).cast("timestamp"))
    assert 0 < rows.count() == late.count() < 1000


class _Session:
    """Just enough of a session to see which folder is chosen."""

    def __init__(self, **conf):
        self.conf = {"spark.sql.warehouse.dir": "hdfs://tables", **conf}


def test_shared_folder_is_the_configured_one():
    assert workspace.shared_dir(_Session(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert workspace.shared_dir(_Session()) == "hdfs://tables"
    assert workspace.new_folder(_Session(), "a", "hdfs://given").startswith("hdfs://given/flarebook/a-")


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
