"""The dimensional model: grain, keys, flags and the edges of each."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from flarebook.functions.geometry import angular_separation
from flarebook.functions.keys import revision_order
from flarebook.operators import gold, quality
from flarebook.operators.silver import cleaned, parse_notices
from flarebook.plans import reports
from notices import FULL, STRAY, bronze_frame, notice


def silver(spark, *payloads, at=None):
    return cleaned(parse_notices(bronze_frame(spark, payloads, at)))


def revision(trigger, record, *lines):
    head = [] if record is None else [f"RECORD_NUM: {record}"]
    return notice(*head, *lines, trigger=str(trigger))


def test_keys_join_and_are_stable(spark):
    clean = silver(spark, FULL, STRAY, revision(1, 2, "GRB_RA: 5d"))
    tables = [build(clean) for _, _, build in gold.GOLD_TABLES]
    sun_moon, spatial, timing, fact = tables
    assert fact.count() == 2
    assert fact.join(spatial, "spatial_key").join(timing, "timing_key").join(sun_moon, "sun_moon_key").count() == 2
    assert {r.orphan_rows for r in quality.orphan_keys(fact, timing, spatial, sun_moon).collect()} == {0}
    first, second = ({r.notice_key: r.spatial_key for r in gold.fact_notices(clean).collect()} for _ in range(2))
    assert first == second


def test_orphans_are_counted(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    row = quality.orphans(child, parent, "k", "r").collect()[0]
    assert (row.orphan_keys, row.orphan_rows) == (1, 2)


def test_calendar_and_latency(spark):
    row = gold.timing_dimension(silver(spark, FULL)).collect()[0]
    assert (row.burst_year, row.burst_month, row.burst_day_of_year, row.burst_hour_utc) == (2024, 3, 65, 10)
    assert row.notice_latency_seconds == 330


def test_latency_cuts_fractions_first(spark):
    text = notice("GRB_DATE: 20374 TJD", "GRB_TIME: 1.5 SOD", "NOTICE_DATE: Tue 05 Mar 24 00:00:01 UT")
    assert gold.timing_dimension(silver(spark, text)).collect()[0].notice_latency_seconds == 0


def test_one_latest_revision_per_trigger(spark):
    clean = silver(
        spark,
        *[revision(1, n) for n in (1, 10, 9)],
        revision(1, None),
        revision(2, None),
        *[revision(1, 10)] * 5,  # replays of the latest one
    )
    flags = {r.notice_key: r.is_latest_revision for r in gold.fact_notices(clean).collect()}
    assert flags == {"1-1": False, "1-10": True, "1-9": False, "1": False, "2": True}


def test_long_record_numbers_stay_apart_and_in_order(spark):
    numbers = ["3000000001", "3000000002", "12345678901234567890123456789012345678901", "-3", "-20", "-0", "+0007", "9"]
    clean = silver(spark, *[revision(1, n) for n in numbers], revision(1, None))
    fact = {r.notice_key: r for r in gold.fact_notices(clean).collect()}
    assert set(fact) == {
        "1", "1-3000000001", "1-3000000002", "1-12345678901234567890123456789012345678901", "1--3", "1--20", "1-0",
        "1-7", "1-9",
    }
    assert [k for k, r in fact.items() if r.is_latest_revision] == ["1-12345678901234567890123456789012345678901"]
    assert fact["1-3000000001"].record_num is None and fact["1-7"].record_num == 7
    order = revision_order(F.col("notice_key"), F.col("trigger_num"))
    ordered = clean.select("notice_key", F.struct(*order).alias("place")).orderBy("place").collect()
    assert [r.notice_key for r in ordered] == [
        "1", "1--20", "1--3", "1-0", "1-7", "1-9", "1-3000000001", "1-3000000002",
        "1-12345678901234567890123456789012345678901",
    ]


def test_known_sky_context_wins_over_an_unknown_one(spark):
    def at(minute, *lines):
        return revision(1, minute, "GRB_RA: 5d", *lines, f"NOTICE_DATE: Tue 05 Mar 24 10:{minute}:00 UT", "GRB_ERROR: 1")

    clean = silver(spark, at(10), at(20, "MOON_DIST: 90"))
    spatial, sun_moon = gold.spatial_dimension(clean), gold.sun_moon_dimension(clean)
    found = reports.followup_candidates(gold.fact_notices(clean), spatial, sun_moon).collect()
    assert [r.moon_dist_deg for r in found] == [90.0]


def test_newest_copy_of_a_revision_wins(spark):
    texts = [revision(1, 1, f"COMMENTS: {n}") for n in range(3)]
    fact = gold.fact_notices(silver(spark, *texts, at=[5, 9, 7]))
    assert [r.comments for r in fact.collect()] == ["1"]


def test_position_with_two_sky_contexts_keeps_the_earliest(spark):
    def at(minute, sun):
        return revision(1, minute, "GRB_RA: 5d", f"SUN_DIST: {sun}", f"NOTICE_DATE: Tue 05 Mar 24 10:{minute}:00 UT")

    undated = revision(1, 99, "GRB_RA: 5d", "SUN_DIST: 0.5")
    clean = silver(spark, undated, at(30, 1), at(20, 2), at(40, 3))
    spatial, sun_moon = gold.spatial_dimension(clean), gold.sun_moon_dimension(clean)
    assert [r.sun_dist_deg for r in spatial.join(sun_moon, "sun_moon_key").collect()] == [2.0]


def test_minus_zero_has_the_key_of_zero(spark):
    clean = silver(spark, revision(1, 1, "GRB_DEC: -0.000d"), revision(1, 2, "GRB_DEC: 0.0d"))
    fact, spatial = gold.fact_notices(clean), gold.spatial_dimension(clean)
    assert spatial.count() == 1
    assert fact.join(spatial, "spatial_key").count() == 2


def test_day_without_time_keeps_one_timing_row(spark):
    clean = silver(spark, *[revision(1, n, f"GRB_DATE: {20374 + n} TJD") for n in (1, 2)])
    assert [str(r.burst_date) for r in gold.timing_dimension(clean).collect()] == ["2024-03-06"]


def test_fact_grain(spark):
    row = quality.fact_grain(gold.fact_notices(silver(spark, revision(1, 1), revision(1, 2), revision(2, 1))))
    assert row.collect()[0].asDict() == {
        "fact_rows": 3,
        "revisions": 3,
        "triggers": 2,
        "latest_rows": 2,
        "triggers_without_one_latest": 0,
    }


def test_one_hot_trigger_is_combined_before_the_shuffle(spark):
    """No exchange of the fact may move plain rows by trigger or by key."""
    plan = gold.fact_notices(silver(spark, FULL))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert plan.count("partial_max") == 2


def test_drift_takes_first_and_last_revision(spark):
    clean = silver(
        spark,
        revision(1, 5, "GRB_RA: 10d", "GRB_DEC: 0d", "GRB_ERROR: 9"),
        revision(1, 6, "GRB_RA: 50d", "GRB_DEC: 0d", "GRB_ERROR: 5"),
        revision(1, 7, "GRB_RA: 12d", "GRB_DEC: 0d", "GRB_ERROR: 1"),
        revision(2, 1, "GRB_RA: 12d", "GRB_DEC: 0d"),
    )
    drift = reports.localisation_drift(gold.fact_notices(clean), gold.spatial_dimension(clean)).collect()
    assert [(r.trigger_num, r.initial_error, r.final_error) for r in drift] == [(1, 9.0, 1.0), (2, None, None)]
    assert drift[0].moved_deg == pytest.approx(2.0)
    assert drift[1].moved_deg == pytest.approx(0.0, abs=1e-5)


def test_separation_is_defined_for_all_angles(spark):
    frame = spark.range(0, 360).selectExpr("id * 1.0D AS ra", "(id % 181 - 90) * 1.0D AS dec")
    opposite = angular_separation(F.col("ra"), F.col("dec"), F.col("ra") + 180, -F.col("dec"))
    angles = [r[0] for r in frame.select(opposite).collect()]
    assert not any(math.isnan(a) for a in angles)
    assert all(a == pytest.approx(180, abs=1e-4) for a in angles)


@pytest.mark.parametrize("spread", [3, 900, 10**6, 3 * 10**11])
def test_exact_percentiles_against_sorting(spark, spread):
    rng = random.Random(spread)
    values = [rng.randint(-spread, spread) for _ in range(997)] + [17] * 400 + [None] * 5
    frame = spark.createDataFrame([(v,) for v in values], "notice_latency_seconds bigint")
    row = reports.latency_percentiles_exact(frame).collect()[0]
    known = sorted(v for v in values if v is not None)
    wanted = [known[math.ceil(p * len(known) / 100) - 1] for p in (50, 90, 100)]
    assert [row.median_seconds, row.p90_seconds, row.worst_seconds] == wanted


def test_reports_are_sorted(spark):
    texts = [
        revision(n, 1, f"GRB_ERROR: {4 - n}", f"GRB_RA: {n}d", "MOON_DIST: 40", "GRB_DATE: 20374 TJD", f"GRB_TIME: {n} SOD")
        for n in (1, 2, 3)
    ]
    clean = silver(spark, *texts)
    fact, spatial = gold.fact_notices(clean), gold.spatial_dimension(clean)
    candidates = reports.followup_candidates(fact, spatial, gold.sun_moon_dimension(clean)).collect()
    assert [r.error_radius_deg for r in candidates] == [1.0, 2.0, 3.0]
    now = F.lit("2024-03-20").cast("timestamp")
    recent = reports.recent_bursts(fact, gold.timing_dimension(clean), spatial, now).collect()
    assert [r.trigger_num for r in recent] == [3, 2, 1]
    assert reports.recent_bursts(fact, gold.timing_dimension(clean), spatial).count() == 0


def test_quality_counts(spark):
    every = parse_notices(bronze_frame(spark, [FULL, STRAY, notice("NEW: 1", "NEW: 2"), notice("NEW: 3")]))
    row = reports.data_quality(cleaned(every)).collect()[0]
    assert tuple(row) == (3, 0, 2, 2)
    assert [tuple(r) for r in quality.unknown_field_counts(every).collect()] == [("NEW", 2)]
    window = reports.quarantine_window(every.where("NOT is_parsed")).collect()[0]
    assert window.notices == 1 and window.first_at == window.last_at


@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_missing_ranges_across_borders(spark, size):
    offsets = [1, 2, 2, 5, 9, 10, 35, 36]
    rows = [("t", 0, o) for o in offsets] + [("t", 1, 7), ("u", 0, 3), ("u", 0, 4)]
    frame = spark.createDataFrame(rows, "topic string, partition int, offset long")
    found = quality.missing_ranges(frame, size).collect()
    assert sorted(tuple(r) for r in found) == [("t", 0, 3, 4, 2), ("t", 0, 6, 8, 3), ("t", 0, 11, 34, 24)]


def test_sketches_add_up(spark):
    rows = [(f"2024-01-{1 + i % 9:02d}", (i * 7919) % 10_007) for i in range(20_000)] + [("2024-01-10", None)]
    timing = spark.createDataFrame(rows, "day string, notice_latency_seconds long")
    timing = timing.select(F.to_date("day").alias("burst_day"), "notice_latency_seconds")
    sketches = gold.latency_sketches(timing)
    assert sketches.agg(F.sum("notice_times")).first()[0] == 20_000 and sketches.count() == 9
    found = reports.latency_percentiles_of(sketches).first()
    assert tuple(reports.rank_errors(timing, *found, reports.SKETCH_ERROR).first()) == (True, True, 10_006)
    none = reports.latency_percentiles_of(sketches.limit(0)).first()
    assert tuple(none) == (None, None, None)
