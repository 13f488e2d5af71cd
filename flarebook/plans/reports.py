"""The published questions over Gold and Silver.

Sorted results end in a unique column. Equal values of the leading column, which
may be very many, can then be sorted in several ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flarebook.functions.geometry import angular_separation
from flarebook.functions.keys import revision_order
from flarebook.operators.gold import BURST_DAY, SKETCH_SIZE


def recent_bursts(fact: DataFrame, timing: DataFrame, spatial: DataFrame, now: Column | None = None) -> DataFrame:
    """Bursts of the last 30 days at their final position, newest first.

    Fact and timing have folders by the same day, so only those of the last
    days are read from either.
    """
    since = (F.current_timestamp() if now is None else now) - F.expr("INTERVAL 30 DAYS")
    recent = F.col(BURST_DAY) >= F.to_date(since)
    return (
        fact.where(recent & F.col("is_latest_revision"))
        .select("trigger_num", "timing_key", "spatial_key", "error_radius_deg")
        .join(timing.where(recent & (F.col("burst_time") >= since)).select("timing_key", "burst_time"), "timing_key")
        .join(spatial.select("spatial_key", "ra_deg", "dec_deg"), "spatial_key")
        .select("trigger_num", "burst_time", "ra_deg", "dec_deg", "error_radius_deg")
        .orderBy(F.desc("burst_time"), "trigger_num")
    )


def latency_percentiles(timing: DataFrame) -> DataFrame:
    delay = F.col("notice_latency_seconds")
    return timing.agg(
        F.percentile_approx(delay, 0.5).alias("median_seconds"),
        F.percentile_approx(delay, 0.9).alias("p90_seconds"),
        F.max(delay).alias("worst_seconds"),
    )


# The default accuracy of the approximate percentiles: ranks are off by a
# ten-thousandth of the rows at most.
ACCURACY = 10_000


def rank_errors(timing: DataFrame, median: int | None, p90: int | None, worst: int | None, error: float) -> DataFrame:
    """Whether values have the rank of a percentile, but for a share ``error`` of the rows, and the maximum."""
    delay = F.col("notice_latency_seconds")

    def near(value: int | None, share: float, name: str) -> Column:
        known = F.count(delay)
        below, up_to = F.count_if(delay < F.lit(value)), F.count_if(delay <= F.lit(value))
        low, high = share * known - known * error - 1, share * known + known * error + 1
        return ((below <= high) & (up_to >= low)).alias(name)

    return timing.agg(
        near(median, 0.5, "median_is_near"), near(p90, 0.9, "p90_is_near"), F.lit(worst).alias("worst_seconds")
    )


def latency_rank_errors(timing: DataFrame) -> DataFrame:
    """Whether each approximate percentile is as near as promised, and the exact maximum."""
    return rank_errors(timing, *latency_percentiles(timing).first(), 1 / ACCURACY)


# What percentiles of sketches may be off by, as a share of the rows: four times
# the error that sketches of this size keep with 99 % certainty.
SKETCH_ERROR = 0.005


def latency_percentiles_of(sketches: DataFrame) -> DataFrame:
    """The percentiles from stored sketches, within ``SKETCH_ERROR`` of their ranks; the maximum is exact."""
    whole = sketches.agg(
        F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_SIZE)).alias("sketch"), F.max("worst_seconds").alias("worst_seconds")
    )
    ranked = lambda share: F.kll_sketch_get_quantile_bigint("sketch", F.lit(share))
    known = F.col("worst_seconds").isNotNull()
    return whole.select(
        F.when(known, ranked(0.5)).alias("median_seconds"), F.when(known, ranked(0.9)).alias("p90_seconds"), "worst_seconds"
    )


# Two times in the years 1 to 9999 differ by less than 2**39 seconds, so with
# these bit widths no step below looks at more than 2**14 groups.
LATENCY_SHIFTS = (26, 13, 0)
PERCENTS = (50, 90, 100)


def latency_percentiles_exact(timing: DataFrame) -> DataFrame:
    """The same with exact ranks, by narrowing down from coarse to single values.

    Each step counts rows per value prefix within the prefix chosen before and
    picks the one that holds the wanted rank, so no task ever sees all values.
    """
    delay = F.col("notice_latency_seconds")
    counts = timing.where(delay.isNotNull()).groupBy(delay.alias("value")).agg(F.count("*").alias("n"))
    chosen = None
    for shift, coarser in zip(LATENCY_SHIFTS, (None, *LATENCY_SHIFTS)):
        prefixed = counts.withColumn("prefix", F.shiftright("value", shift))
        if chosen is None:
            groups = (
                prefixed.groupBy("prefix")
                .agg(F.sum("n").alias("n"))
                .withColumn("percent", F.explode(F.array(*map(F.lit, PERCENTS))))
                .withColumn("rank", F.ceil(F.col("percent") * F.sum("n").over(Window.partitionBy("percent")) / 100))
            )
        else:
            # One row per percentage, whatever the data.
            within = F.shiftright(F.col("value"), coarser) == F.col("chosen")
            groups = (
                prefixed.join(F.broadcast(chosen), within)
                .groupBy("percent", "rank", "prefix")
                .agg(F.sum("n").alias("n"))
            )
        below = F.sum("n").over(Window.partitionBy("percent").orderBy("prefix")) - F.col("n")
        chosen = (
            groups.withColumn("below", below)
            .where("below < rank AND rank <= below + n")
            .select("percent", (F.col("rank") - F.col("below")).alias("rank"), F.col("prefix").alias("chosen"))
        )
    return chosen.agg(
        *[
            F.max(F.when(F.col("percent") == percent, F.col("chosen"))).alias(name)
            for percent, name in zip(PERCENTS, ("median_seconds", "p90_seconds", "worst_seconds"))
        ]
    )


def followup_candidates(fact: DataFrame, spatial: DataFrame, sun_moon: DataFrame) -> DataFrame:
    """Well-localised bursts far from the Moon, best localised first."""
    return (
        fact.where("is_latest_revision AND error_radius_deg < 5")
        .select("trigger_num", "spatial_key", "error_radius_deg")
        .join(spatial.select("spatial_key", "sun_moon_key", "ra_deg", "dec_deg"), "spatial_key")
        .join(sun_moon.where("moon_dist_deg > 30").select("sun_moon_key", "moon_dist_deg"), "sun_moon_key")
        .select("trigger_num", "ra_deg", "dec_deg", "error_radius_deg", "moon_dist_deg")
        .orderBy("error_radius_deg", "trigger_num")
    )


def localisation_drift(fact: DataFrame, spatial: DataFrame) -> DataFrame:
    """How far the position moved from the first to the last revision.

    A trigger is reduced to its two ends before any position is looked up.
    """
    # Without a record number a revision is the first, unless it is the only one.
    order = revision_order(F.col("notice_key"), F.col("trigger_num"))
    revision = F.struct(*order, "error_radius_deg", "spatial_key")
    ends = fact.groupBy("trigger_num").agg(F.min(revision).alias("first"), F.max(revision).alias("last"))
    at_first = spatial.select(
        F.col("spatial_key").alias("first_key"), F.col("ra_deg").alias("ra_1"), F.col("dec_deg").alias("dec_1")
    )
    at_last = spatial.select(
        F.col("spatial_key").alias("last_key"), F.col("ra_deg").alias("ra_2"), F.col("dec_deg").alias("dec_2")
    )
    moved = angular_separation(F.col("ra_1"), F.col("dec_1"), F.col("ra_2"), F.col("dec_2"))
    return (
        ends.select(
            "trigger_num",
            F.col("first.error_radius_deg").alias("initial_error"),
            F.col("last.error_radius_deg").alias("final_error"),
            F.col("first.spatial_key").alias("first_key"),
            F.col("last.spatial_key").alias("last_key"),
        )
        .join(at_first, "first_key")
        .join(at_last, "last_key")
        .select("trigger_num", "initial_error", "final_error", moved.alias("moved_deg"))
        .orderBy(F.desc("moved_deg"), "trigger_num")
    )


def data_quality(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("notices"),
        F.count_if(F.col("trigger_num").isNull()).alias("missing_trigger"),
        F.count_if(F.col("ra_deg").isNull() | F.col("dec_deg").isNull()).alias("missing_position"),
        F.count_if(F.col("rescued_fields").isNotNull()).alias("with_unmodelled_fields"),
    )


def quarantine_window(quarantined: DataFrame, at: str = "ingested_at") -> DataFrame:
    return quarantined.agg(
        F.count("*").alias("notices"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )
