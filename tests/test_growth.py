"""What a job moves and how it is dealt out, as the input grows."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from flarebook.operators.gold import GOLD_SCOPES, GOLD_TABLES
from flarebook.operators.silver import cleaned
from flarebook.operators.upsert import affected
from flarebook.plans.layers import Layers
from flarebook.plans.queries import as_sent
from flarebook.session import SHORT_METHODS
from flarebook.sources import sample
from flarebook.sources.records import replay_stream
from flarebook.streaming import jobs
from flarebook.workspace import children, new_folder
from notices import FULL, STRAY, bronze_frame, notice


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_payloads_stay_out_of_the_join_with_what_was_sent(spark):
    rows = bronze_frame(spark, [FULL, STRAY, None, "Ü"]).drop("ingested_at")

    class Sent(Layers):
        def __init__(self):
            self.spark = spark

        def records(self):
            return rows.selectExpr("encode(if(offset = 3, 'U', payload), 'UTF-8') AS value", "topic", "partition", "offset")

    found = as_sent(rows, Sent(), "payload")
    assert {row.offset: row.as_sent for row in found.collect()} == {0: True, 1: True, 2: None, 3: False}
    above = optimized(found).split("Join Inner", 1)
    assert "payload" not in above[0]


def test_a_column_that_no_table_needs_is_not_read_for_changed_groups(spark):
    payloads = [FULL, notice("RECORD_NUM: 1", trigger="5"), notice("RECORD_NUM: 2", trigger="5"), notice(trigger="6")]
    path = new_folder(spark, "silver")
    jobs.rebuild_silver(bronze_frame(spark, payloads), path)
    silver = cleaned(jobs.read_silver(spark, path))
    changed = silver.where("record_num = 2")
    for name, key, build in GOLD_TABLES:
        found = affected(silver, changed, GOLD_SCOPES[name])
        # Positions, times and sky contexts of the short notices are null, which is a group as well.
        numbers = {"5", "6"} if name != "fact_notices" else {"5"}
        assert {str(row.trigger_num) for row in found.collect()} == numbers
        assert found.columns == silver.columns
        plan = build(found)._jdf.queryExecution().executedPlan().toString()
        assert "raw_payload" not in plan and "rescued_fields" not in plan


def test_many_notices_in_a_file_are_parsed_by_many_tasks(spark):
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    assert size <= 16 << 20


def test_both_results_are_written_side_by_side(spark):
    path = new_folder(spark, "silver")
    jobs.rebuild_silver(bronze_frame(spark, [FULL, STRAY] * 20).coalesce(1), path)
    for result in ("true", "false"):
        assert spark.read.parquet(f"{path}/is_parsed={result}").count() == 20
        assert len([name for name in children(spark, f"{path}/is_parsed={result}") if name.startswith("part-")]) == 1
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def row_groups(spark, path: str) -> list[int]:
    """Row groups of each file with rows in a folder."""
    names = [name for name in children(spark, path) if name.startswith("part-")]
    files = [pq.ParquetFile(f"{path.removeprefix('file:')}/{name}") for name in names]
    return [file.num_row_groups for file in files if file.metadata.num_rows]


def test_one_bronze_file_of_a_batch_is_parsed_by_many_tasks(spark):
    # Texts that do not pack well: 8 MB of them in one file.
    payload = F.concat(F.lit("TRIGGER_NUM: "), F.col("id"), F.lit("\n"), *[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(16)])
    rows = spark.range(8000).select(
        payload.alias("payload"), F.lit(None).cast("string").alias("message_key"), F.lit("topic").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(0).cast("timestamp").alias("kafka_timestamp"),
        F.lit(0).cast("timestamp").alias("ingested_at"),
    ).coalesce(1)
    written = new_folder(spark, "bronze")
    jobs.bronze_writer(rows).parquet(written)
    records = new_folder(spark, "replay")
    rows.selectExpr(
        "encode(message_key, 'UTF-8') AS key", "encode(payload, 'UTF-8') AS value", "topic", "partition", "offset",
        "kafka_timestamp AS timestamp", "0 AS timestampType",
    ).write.parquet(records)
    streamed = new_folder(spark, "bronze")
    jobs.ingest_bronze(replay_stream(spark, records), new_folder(spark, "progress"), streamed)
    assert spark.conf.get("parquet.block.size", None) is None
    for path in (written, streamed):
        assert min(row_groups(spark, path)) >= 4
    silver = new_folder(spark, "silver")
    jobs.route_silver(jobs.bronze_stream(spark, written, 1), new_folder(spark, "progress"), silver)
    assert jobs.read_silver(spark, silver).where("is_parsed").count() == 8000
    assert len([name for name in children(spark, f"{silver}/is_parsed=true") if name.startswith("part-")]) > 1


def test_replay_is_written_by_code_that_the_jvm_compiles(spark, monkeypatch):
    limits = []
    limit, = SHORT_METHODS
    made = sample.envelope_from_events
    monkeypatch.setattr(sample, "envelope_from_events", lambda events: limits.append(spark.conf.get(limit)) or made(events))
    events = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1, i), i, "click", 1.0, "{}") for i in range(9)],
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    )
    before = spark.conf.get(limit)
    path = new_folder(spark, "replay")
    sample.write_replay(spark, events, path)
    assert limits == ["8000"] and spark.conf.get(limit) == before
    assert spark.read.parquet(path).count() == 9
