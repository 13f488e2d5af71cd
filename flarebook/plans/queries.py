"""Every operator as a query over the given tables.

Times and dates leave as text in UTC and maps as sorted entries, so that a
result reads the same in any session and engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flarebook.functions import notice_text as t
from flarebook.functions.geometry import angular_separation
from flarebook.functions.keys import surrogate_key
from flarebook.operators import gold, quality
from flarebook.operators.arrow_cut import with_arrow_entries
from flarebook.operators.arrow_parse import parse_in_python, register
from flarebook.operators.silver import LaterField, parse_notices, parsed_notice
from flarebook.operators.upsert import build_gold, create_schemas, table_files
from flarebook.plans import reports
from flarebook.plans.layers import Layers
from flarebook.schemas import LINEAGE, POSITION, SKY_CONTEXT
from flarebook.sources.records import replay_stream
from flarebook.streaming import jobs
from flarebook.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

# The sample starts on 2024-01-01 and covers 30 days.
SAMPLE_NOW = "2024-02-10 00:00:00"
SAMPLE_MIDDLE = "2024-01-16 00:00:00"
REPLAY_FILES_PER_BATCH = 4
SAMPLE_OFFSETS_PER_RANGE = 1000


def time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def map_text(column: str) -> Column:
    entries = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(entries), ";").alias(column)


def portable(frame: DataFrame) -> DataFrame:
    def shown(name: str, kind: str) -> Column:
        if kind.startswith("timestamp"):
            return time_text(name)
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if kind.startswith("map"):
            return map_text(name)
        return F.col(name)

    return frame.select(*[shown(name, kind) for name, kind in frame.dtypes])


def _layer_query(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, tables: portable(build(Layers(spark, tables)))


def _parsed(*columns: str) -> Query:
    """Chosen columns straight from Bronze: only these are parsed."""
    return _layer_query(lambda layers: parse_notices(layers.bronze(), columns).select("offset", *columns))


def _raw(**fields: Column) -> Query:
    """Raw fields straight from Bronze."""
    return _layer_query(
        lambda layers: t.with_entries(layers.bronze()).select(
            "offset", *[value.alias(name) for name, value in fields.items()]
        )
    )


def _deferred(build: Callable[[], Query]) -> Query:
    """Column expressions need a session, so they are made when a query runs."""
    return lambda spark, tables: build()(spark, tables)


def as_sent(frame: DataFrame, layers: Layers, payload: str) -> DataFrame:
    """The payload column replaced by whether all its bytes are those of the record.

    Each side takes its digest before the join, so no text is shuffled.
    """
    place = ["topic", "partition", "offset"]
    sent = layers.records().select(*place, F.unhex(F.sha2("value", 256)).alias("sent_digest"))
    digest = F.unhex(F.sha2(F.encode(payload, "UTF-8"), 256)).alias("own_digest")
    own = frame.select(*[c for c in frame.columns if c != payload], digest)
    same = F.col("own_digest") == F.col("sent_digest")
    return own.join(sent, place).withColumn("as_sent", same).drop("sent_digest", "own_digest")


def bronze_envelope(layers: Layers) -> DataFrame:
    bronze = layers.bronze().withColumn("has_title", F.startswith("payload", F.lit("TITLE:")))
    return as_sent(bronze.drop("ingested_at"), layers, "payload")


def _notices(silver: DataFrame, layers: Layers) -> DataFrame:
    return as_sent(silver.drop("ingested_at"), layers, "raw_payload")


def _ingested(layers: Layers, max_files: int | None = None) -> str:
    path = new_folder(layers.spark, "bronze")
    records = replay_stream(layers.spark, layers.replay(), max_files)
    jobs.ingest_bronze(records, new_folder(layers.spark, "bronze-progress"), path)
    return path


def _routed(layers: Layers) -> tuple[str, str, str]:
    bronze = _ingested(layers)
    silver, progress = new_folder(layers.spark, "silver"), new_folder(layers.spark, "silver-progress")
    jobs.route_silver(jobs.bronze_stream(layers.spark, bronze), progress, silver)
    return bronze, silver, progress


def bronze_replay(layers: Layers) -> DataFrame:
    """The replay source as a stream, a few files at a time."""
    bronze = jobs.read_bronze(layers.spark, _ingested(layers, REPLAY_FILES_PER_BATCH))
    return as_sent(bronze.drop("ingested_at"), layers, "payload")


def bronze_ingest(layers: Layers) -> DataFrame:
    bronze = jobs.read_bronze(layers.spark, _ingested(layers))
    return bronze.groupBy("topic", "partition").agg(
        F.count("*").alias("notices"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("ingested_at").alias("stamped"),
    )


def silver_stream(layers: Layers) -> DataFrame:
    _, silver, _ = _routed(layers)
    return _notices(jobs.read_silver(layers.spark, silver), layers)


def silver_evolved(layers: Layers) -> DataFrame:
    """A stream that was written by two versions of the schema, read as the later one."""
    spark = layers.spark
    bronze, silver, progress = (new_folder(spark, name) for name in ("bronze", "silver", "progress"))
    later = (LaterField("spacecraft", "SPACECRAFT"),)
    early = F.col("kafka_timestamp") < F.lit(SAMPLE_MIDDLE).cast("timestamp")
    for rows, fields in ((layers.bronze().where(early), ()), (layers.bronze().where(~early), later)):
        rows.write.mode("append").parquet(bronze)
        jobs.route_silver(jobs.bronze_stream(spark, bronze), progress, silver, later_fields=fields)
    notices = jobs.read_silver(spark, silver, later_fields=later)
    return notices.select("offset", "notice_key", "title", "spacecraft", "rescued_fields")


def silver_compacted(layers: Layers) -> DataFrame:
    """A stream of many small files, gathered twice while it goes on, and its newest files."""
    spark = layers.spark
    bronze, silver, progress, segments = (new_folder(spark, n) for n in ("bronze", "silver", "progress", "segments"))
    stages = layers.bronze().withColumn("stage", F.pmod("offset", F.lit(3)).cast("int"))
    for stage in range(3):
        rows = stages.where(F.col("stage") == stage).drop("stage")
        jobs.bronze_writer(rows.repartition(REPLAY_FILES_PER_BATCH)).mode("append").parquet(bronze)
        jobs.route_silver(jobs.bronze_stream(spark, bronze, 1), progress, silver)
        if stage < 2:
            jobs.compact_silver(spark, silver, segments)
    return _notices(jobs.read_compacted_silver(spark, silver, segments).drop(gold.BURST_DAY), layers)


def stream_rerun_noop(layers: Layers) -> DataFrame:
    """A second run over unchanged input adds nothing."""
    bronze, silver, progress = _routed(layers)
    jobs.route_silver(jobs.bronze_stream(layers.spark, bronze), progress, silver)
    return jobs.read_silver(layers.spark, silver).groupBy("is_parsed").agg(F.count("*").alias("notices"))


def rebuild_equals_stream(layers: Layers) -> DataFrame:
    bronze, streamed, _ = _routed(layers)
    rebuilt = new_folder(layers.spark, "silver-rebuilt")
    jobs.rebuild_silver(jobs.read_bronze(layers.spark, bronze), rebuilt)
    read = lambda path: jobs.read_silver(layers.spark, path)
    return quality.differences(read(streamed), read(rebuilt), ["topic", "partition"])


def parse_udf_equals_native(layers: Layers) -> DataFrame:
    bronze = layers.bronze().drop("ingested_at").withColumn("ingested_at", F.col("kafka_timestamp"))
    return quality.differences(
        parse_notices(bronze, cut=with_arrow_entries), parse_notices(bronze), ["topic", "partition"]
    )


def parse_python_equals_native(layers: Layers) -> DataFrame:
    bronze = layers.bronze().drop("ingested_at").withColumn("ingested_at", F.col("kafka_timestamp"))
    return quality.differences(parse_in_python(bronze), parse_notices(bronze), ["topic", "partition"])


def parse_as_column(layers: Layers) -> DataFrame:
    """The parse as one column of a select."""
    found = layers.bronze().select(parsed_notice("payload").alias("notice"), *LINEAGE, F.col("payload").alias("raw_payload"))
    return _notices(found.select("notice.*", *LINEAGE, "raw_payload"), layers)


def parse_in_sql(layers: Layers) -> DataFrame:
    """The parse as a function of SQL."""
    register(layers.spark)
    found = layers.spark.sql(
        f"SELECT parsed_notice(payload) AS notice, {', '.join(f'`{c}`' for c in LINEAGE)}, payload AS raw_payload"
        " FROM {bronze}",
        bronze=layers.bronze(),
    )
    return _notices(found.select("notice.*", *LINEAGE, "raw_payload"), layers)


def latency_sketches(layers: Layers) -> DataFrame:
    """Whether the percentiles out of the days' sketches are as near as promised."""
    found = reports.latency_percentiles_of(layers.latency_sketches()).first()
    return reports.rank_errors(layers.timing(), *found, reports.SKETCH_ERROR)


def replay_dedupe(layers: Layers) -> DataFrame:
    """All notices delivered a second time leave the fact as it was."""
    silver = layers.cleaned()
    again = silver.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    return gold.fact_notices(silver.unionByName(again)).drop("ingested_at", gold.BURST_DAY)


def _upserted(layers: Layers, *runs: tuple[DataFrame, DataFrame | None]) -> dict[str, DataFrame]:
    """Gold after runs over a state of Silver and what is new in it. The tables
    live in a schema of their own, which is dropped again; the files stay for
    the result."""
    spark = layers.spark
    root = new_folder(spark, "gold")
    schema = "gold_" + root.rsplit("-", 1)[-1]
    create_schemas(spark, [schema], f"{root}/schemas")
    frames = {}
    try:
        for silver, changed in runs:
            build_gold(silver, schema, root, changed=changed)
        for name, _, _ in gold.GOLD_TABLES:
            frames[name] = table_files(spark, f"{schema}.{name}")
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    return frames


def _table_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, keys and all columns of each table, but for when a row came in, as one sum of hashes."""
    parts = []
    for name, key, _ in gold.GOLD_TABLES:
        frame = portable(tables[name].drop("ingested_at"))
        shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(frame.columns)]
        # 52 bits of each row's hash, so that the sums are exact in any engine.
        bits = F.conv(F.substring(F.md5(F.concat_ws("|", *shown)), 1, 13), 16, 10).cast("decimal(38,0)")
        parts.append(
            frame.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("table_rows"),
                F.count_distinct(key).alias("table_keys"),
                F.sum(bits).cast("string").alias("digest"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _early(layers: Layers) -> DataFrame:
    return layers.cleaned().where(F.col("kafka_timestamp") < F.lit(SAMPLE_MIDDLE).cast("timestamp"))


def _late(layers: Layers) -> DataFrame:
    return layers.cleaned().where(F.col("kafka_timestamp") >= F.lit(SAMPLE_MIDDLE).cast("timestamp"))


def gold_upsert_first(layers: Layers) -> DataFrame:
    return _upserted(layers, (_early(layers), None))["fact_notices"].drop("ingested_at")


def gold_upsert(layers: Layers) -> DataFrame:
    """The second run knows the late notices as new: it keeps, changes and adds rows."""
    tables = _upserted(layers, (_early(layers), None), (layers.cleaned(), _late(layers)))
    return tables["fact_notices"].drop("ingested_at")


def gold_upsert_tables(layers: Layers) -> DataFrame:
    return _table_digests(_upserted(layers, (_early(layers), None), (layers.cleaned(), _late(layers))))


def gold_upsert_idempotent(layers: Layers) -> DataFrame:
    every = layers.cleaned()
    return _table_digests(_upserted(layers, (every, None), (every, None), (every, _late(layers))))


def surrogate_keys(layers: Layers) -> DataFrame:
    return layers.cleaned().select(
        "offset",
        surrogate_key(*gold.TIMING).alias("timing_key"),
        surrogate_key(*POSITION).alias("spatial_key"),
        surrogate_key(*SKY_CONTEXT).alias("sun_moon_key"),
    )


def sun_moon_separation(layers: Layers) -> DataFrame:
    angle = angular_separation(
        F.col("sun_ra_deg"), F.col("sun_dec_deg"), F.col("moon_ra_deg"), F.col("moon_dec_deg")
    )
    return layers.silver().select("offset", F.round(angle, 3).alias("separation_deg"))


def localisation_drift(layers: Layers) -> DataFrame:
    drift = reports.localisation_drift(layers.fact(), layers.spatial())
    return drift.withColumn("moved_deg", F.round("moved_deg", 3))


def recent_bursts(layers: Layers) -> DataFrame:
    now = F.lit(SAMPLE_NOW).cast("timestamp")
    return reports.recent_bursts(layers.fact(), layers.timing(), layers.spatial(), now)


def _extracted(**columns: Callable[[], Column]) -> Query:
    return _deferred(lambda: _raw(**{name: make() for name, make in columns.items()}))


def queries() -> dict[str, Query]:
    layered = {
        # Sources, sinks and streaming
        "bronze_envelope": bronze_envelope,
        "bronze_replay": bronze_replay,
        "bronze_ingest": bronze_ingest,
        "silver_stream": silver_stream,
        "silver_cleaned": lambda s: _notices(s.cleaned(), s),
        "silver_quarantine": lambda s: _notices(s.quarantine(), s),
        "silver_parse": lambda s: _notices(parse_notices(s.bronze()), s),
        "silver_compacted": silver_compacted,
        "silver_evolved": silver_evolved,
        "stream_rerun_noop": stream_rerun_noop,
        "rebuild_equals_stream": rebuild_equals_stream,
        "parse_udf_equals_native": parse_udf_equals_native,
        "parse_python_equals_native": parse_python_equals_native,
        "gold_upsert_first": gold_upsert_first,
        "gold_upsert": gold_upsert,
        "gold_upsert_tables": gold_upsert_tables,
        "gold_upsert_idempotent": gold_upsert_idempotent,
        "replay_dedupe": replay_dedupe,
        "parse_as_column": parse_as_column,
        "parse_in_sql": parse_in_sql,
        # Functions
        "surrogate_key": surrogate_keys,
        "cal_attributes": lambda s: s.cleaned().select("offset", *gold.calendar_parts()),
        "notice_latency": lambda s: s.cleaned().select(
            "offset", gold.notice_latency().alias("notice_latency_seconds")
        ),
        "angular_separation": sun_moon_separation,
        # Gold
        "dim_sun_moon": lambda s: s.shown("dim_sun_moon_coords"),
        "dim_spatial": lambda s: s.shown("dim_spatial_coords"),
        "dim_timing": lambda s: s.shown("dim_event_timing"),
        "fact_notices": lambda s: s.shown("fact_notices").drop("ingested_at"),
        "latest_revision": lambda s: s.fact().where("is_latest_revision").select(
            "trigger_num", "record_num", "notice_key"
        ),
        # Checks
        "dq_orphan_keys": lambda s: quality.orphan_keys(s.fact(), s.timing(), s.spatial(), s.sun_moon()),
        "dq_fact_grain": lambda s: quality.fact_grain(s.fact()),
        "dq_reconcile": lambda s: quality.reconcile(s.bronze(), s.cleaned(), s.quarantine()),
        "dq_missing_offsets": lambda s: quality.missing_ranges(s.bronze(), SAMPLE_OFFSETS_PER_RANGE),
        "dq_rescued_keys": lambda s: quality.unknown_field_counts(s.silver()),
        # Reports
        "q_recent_bursts": recent_bursts,
        "q_latency_percentiles": lambda s: reports.latency_rank_errors(s.timing()),
        "q_latency_sketches": latency_sketches,
        "q_latency_percentiles_exact": lambda s: reports.latency_percentiles_exact(s.timing()),
        "q_followup_candidates": lambda s: reports.followup_candidates(s.fact(), s.spatial(), s.sun_moon()),
        "q_localisation_drift": localisation_drift,
        "q_data_quality": lambda s: reports.data_quality(s.cleaned()),
        "q_quarantine_window": lambda s: reports.quarantine_window(s.quarantine(), "kafka_timestamp"),
    }
    parsing = {
        "parse_nbsp": _extracted(title=lambda: t.text_field("TITLE")),
        "parse_lines": _deferred(lambda: _raw(fields=F.size(F.col(t.NAMES)) - 1)),
        "parse_first_colon": _extracted(
            loc_url=lambda: t.text_field("LOC_URL"), grb_time=lambda: t.text_field("GRB_TIME")
        ),
        "parse_fold": _extracted(
            grb_ra=lambda: t.text_field("GRB_RA"), notice_type=lambda: t.text_field("NOTICE_TYPE")
        ),
        "parse_malformed": _layer_query(
            lambda s: t.with_entries(s.bronze()).select("offset", (F.size(F.col(t.NAMES)) == 1).alias("has_no_field"))
        ),
        "parse_comments": _extracted(comments=t.joined_entries),
        "parse_last_wins": _extracted(
            e_range=lambda: t.text_field("E_RANGE"), unknown_future=lambda: t.text_field("UNKNOWN_FUTURE")
        ),
        "silver_text": _parsed(
            "title", "notice_type", "e_range", "loc_algorithm", "lc_url", "loc_url", "comments"
        ),
        "silver_rescued": _parsed("rescued_fields"),
        "silver_is_parsed": _parsed("is_parsed"),
        "x_first_degrees": _parsed("ra_deg", "dec_deg"),
        "x_leading_float": _parsed(
            "error_radius_deg", "phi_deg", "theta_deg", "sun_dist_deg", "moon_dist_deg", "moon_illum_pct"
        ),
        "x_coord_pair": _parsed(
            "galactic_lon_deg", "galactic_lat_deg", "ecliptic_lon_deg", "ecliptic_lat_deg"
        ),
        "x_position_pair": _parsed("sun_ra_deg", "sun_dec_deg", "moon_ra_deg", "moon_dec_deg"),
        "x_integer": _parsed("trigger_num", "record_num"),
        "x_burst_date": _parsed("burst_date"),
        "x_burst_time": _parsed("burst_time"),
        "x_notice_time": _parsed("notice_time"),
        "x_notice_key": _parsed("notice_key"),
    }
    return {**{name: _layer_query(build) for name, build in layered.items()}, **parsing}


def flagship(spark: SparkSession, tables: str) -> DataFrame:
    return queries()["q_followup_candidates"](spark, tables)
