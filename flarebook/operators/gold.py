"""Silver to Gold: a fact of notice revisions with three dimensions.

Every group is reduced by an aggregate that combines on the map side, so a
trigger, position or replayed notice that holds a large share of all rows never
reaches one task as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flarebook.functions.keys import revision_order, surrogate_key
from flarebook.schemas import FACT_COLUMNS, POSITION, SKY_CONTEXT

TIMING = ("burst_time", "notice_time")

# The folder column of what is asked for by time: the UTC day of the burst.
BURST_DAY = "burst_day"


def burst_day() -> Column:
    return F.to_date("burst_time").alias(BURST_DAY)

# The newest copy of a replayed notice wins. The columns behind these in the
# same struct make the order total, so a rebuild picks the same copy.
RECENCY = ("kafka_timestamp", "partition", "offset", "topic", "ingested_at")


def sun_moon_dimension(silver: DataFrame) -> DataFrame:
    members = silver.select(*SKY_CONTEXT).distinct()
    return members.select(surrogate_key(*SKY_CONTEXT).alias("sun_moon_key"), *SKY_CONTEXT)


def spatial_dimension(silver: DataFrame) -> DataFrame:
    """One row per position. Of several sky contexts the earliest known one is
    kept, and among contexts of one instant the smallest. A context without any
    value counts as unknown: it only stays if there is no other."""
    context = F.struct(
        F.coalesce(*[F.col(c) for c in SKY_CONTEXT]).isNull().alias("unknown"),
        F.col("notice_time").isNull().alias("undated"),
        "notice_time",
        *SKY_CONTEXT,
    )
    members = silver.groupBy(*POSITION).agg(F.min(context).alias("context"))
    flat = members.select(*POSITION, "context.*")
    return flat.select(
        surrogate_key(*POSITION).alias("spatial_key"),
        surrogate_key(*SKY_CONTEXT).alias("sun_moon_key"),
        *POSITION,
    )


def timing_dimension(silver: DataFrame) -> DataFrame:
    """Calendar parts and publication delay of each burst and notice time."""
    members = silver.groupBy(*TIMING).agg(F.min("burst_date").alias("burst_date"))
    return members.select(
        "burst_time",
        "burst_date",
        "notice_time",
        surrogate_key(*TIMING).alias("timing_key"),
        *calendar_parts(),
        notice_latency().alias("notice_latency_seconds"),
        burst_day(),
    )


def calendar_parts() -> list[Column]:
    return [
        F.year("burst_date").alias("burst_year"),
        F.month("burst_date").alias("burst_month"),
        F.dayofyear("burst_date").alias("burst_day_of_year"),
        F.hour("burst_time").alias("burst_hour_utc"),
    ]


def notice_latency() -> Column:
    """Whole seconds; fractions are cut on each side before subtracting."""
    return F.unix_timestamp("notice_time") - F.unix_timestamp("burst_time")


def newest_copies(silver: DataFrame) -> DataFrame:
    """One row per ``notice_key`` with what the fact is built from."""
    carried = [
        "trigger_num",
        "record_num",
        *TIMING,
        *POSITION,
        "phi_deg",
        "theta_deg",
        "e_range",
        "loc_algorithm",
        "lc_url",
        "loc_url",
        "comments",
    ]
    newest = F.max(F.struct(*RECENCY, *carried)).alias("newest")
    copies = silver.groupBy("notice_key").agg(newest)
    return copies.select("notice_key", "newest.ingested_at", *[f"newest.{c}" for c in carried])


def latest_keys(silver: DataFrame) -> DataFrame:
    """The key of the last revision of each trigger.

    A missing record number comes last, hence only counts if there is no other.
    """
    order = revision_order(F.col("notice_key"), F.col("trigger_num"))
    last = silver.groupBy("trigger_num").agg(F.max(F.struct(*order, "notice_key")).alias("last"))
    return last.select("last.notice_key", F.lit(True).alias("latest"))


def fact_notices(silver: DataFrame) -> DataFrame:
    """One row per revision, flagged if it is the last of its trigger, with its day.

    The flag is joined on the key of the revision and not on the trigger: both
    sides are unique there, so no trigger can be hot, and the copies are already
    laid out by that key.
    """
    flagged = newest_copies(silver).join(latest_keys(silver), "notice_key", "left")
    return flagged.select(
        *[
            {
                "timing_key": surrogate_key(*TIMING).alias("timing_key"),
                "spatial_key": surrogate_key(*POSITION).alias("spatial_key"),
                "is_latest_revision": F.coalesce("latest", F.lit(False)).alias("is_latest_revision"),
            }.get(name, F.col(name))
            for name in FACT_COLUMNS
        ],
        burst_day(),
    )


# Size of a day's sketch of delays.
SKETCH_SIZE = 4096


def latency_sketches(timing: DataFrame) -> DataFrame:
    """Of each day the delays as a sketch of bounded size, their number and the longest.

    Sketches of days add up to that of all, so a report reads no delays.
    """
    delay = F.col("notice_latency_seconds")
    known = timing.where(delay.isNotNull()).groupBy(BURST_DAY)
    return known.agg(
        F.kll_sketch_agg_bigint(delay, F.lit(SKETCH_SIZE)).alias("sketch"),
        F.count(F.lit(1)).alias("notice_times"),
        F.max(delay).alias("worst_seconds"),
    )


# Table name, business key and builder; a dimension comes before what refers to it.
GOLD_TABLES = (
    ("dim_sun_moon_coords", "sun_moon_key", sun_moon_dimension),
    ("dim_spatial_coords", "spatial_key", spatial_dimension),
    ("dim_event_timing", "timing_key", timing_dimension),
    ("fact_notices", "notice_key", fact_notices),
)

# What a new notice can change in each table: the groups it belongs to. In the
# fact that is its trigger, since the flag may move from one revision to another.
GOLD_SCOPES = {
    "dim_sun_moon_coords": SKY_CONTEXT,
    "dim_spatial_coords": POSITION,
    "dim_event_timing": TIMING,
    "fact_notices": ("trigger_num",),
}

# Tables with folders by day; the others have folders by a hash of the key. A
# revision can get another day with its next copy. Times cannot: they are the key.
GOLD_DAYS = {"dim_event_timing": False, "fact_notices": True}
