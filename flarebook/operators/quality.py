"""Checks over the stored layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OFFSETS_PER_RANGE = 1_000_000


def reconcile(bronze: DataFrame, clean: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows per broker partition and offset range: none lost, none added.

    ``missing_offsets`` counts those between the first and the last one of a
    range that no Bronze row has: what the broker lost, or never used.
    """
    layers = {"bronze_rows": bronze, "cleaned_rows": clean, "quarantine_rows": quarantined}
    tagged = [f.select("topic", "partition", "offset", F.lit(n).alias("layer")) for n, f in layers.items()]
    counts = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("topic", "partition", F.floor(F.col("offset") / OFFSETS_PER_RANGE).alias("offset_range"))
        .agg(*[F.count_if(F.col("layer") == n).alias(n) for n in layers])
    )
    balanced = F.col("bronze_rows") == F.col("cleaned_rows") + F.col("quarantine_rows")
    # Distinct offsets are groups of their own first, which combine before the shuffle.
    used = bronze.select("topic", "partition", "offset").distinct()
    gaps = used.groupBy("topic", "partition", F.floor(F.col("offset") / OFFSETS_PER_RANGE).alias("offset_range")).agg(
        (F.max("offset") - F.min("offset") + 1 - F.count("*")).alias("missing_offsets")
    )
    keys = ["topic", "partition", "offset_range"]
    return counts.withColumn("is_balanced", balanced).join(gaps, keys, "left")


def missing_ranges(bronze: DataFrame, offsets_per_range: int = OFFSETS_PER_RANGE) -> DataFrame:
    """``topic``, ``partition``, ``first_missing``, ``last_missing``, ``missing_offsets`` of each gap.

    A gap is a run of offsets between the first and the last one of a broker
    partition that no Bronze row has. Offsets are sorted within ranges, so a
    partition of the broker with most of all rows is spread over many tasks;
    only the two ends of each range meet, to find what is missing across them.
    """
    place = ["topic", "partition"]
    used = bronze.select(*place, "offset").distinct()
    used = used.withColumn("offset_range", F.floor(F.col("offset") / offsets_per_range))
    following = F.lead("offset").over(Window.partitionBy(*place, "offset_range").orderBy("offset"))
    inside = used.select(*place, F.col("offset").alias("before"), following.alias("after"))
    ends = used.groupBy(*place, "offset_range").agg(F.min("offset").alias("least"), F.max("offset").alias("before"))
    next_range = F.lead("least").over(Window.partitionBy(*place).orderBy("offset_range"))
    across = ends.select(*place, "before", next_range.alias("after"))
    gaps = inside.unionByName(across).where(F.col("after") > F.col("before") + 1)
    return gaps.select(
        *place,
        (F.col("before") + 1).alias("first_missing"),
        (F.col("after") - 1).alias("last_missing"),
        (F.col("after") - F.col("before") - 1).alias("missing_offsets"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """Count of keys and rows of ``child`` that point nowhere.

    Keys are counted before the join, so one very common key is one row in it.
    """
    used = child.groupBy(key).agg(F.count("*").alias("n"))
    lost = used.join(parent.select(key), key, "left_anti")
    return lost.agg(
        F.lit(relation).alias("relation"),
        F.count("*").alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    )


def orphan_keys(fact: DataFrame, timing: DataFrame, spatial: DataFrame, sun_moon: DataFrame) -> DataFrame:
    checks = [
        orphans(fact, timing, "timing_key", "fact to timing"),
        orphans(fact, spatial, "spatial_key", "fact to spatial"),
        orphans(spatial, sun_moon, "sun_moon_key", "spatial to sun_moon"),
    ]
    return reduce(DataFrame.unionByName, checks)


def fact_grain(fact: DataFrame) -> DataFrame:
    """Rows, revisions and flags of the fact, from one pass per key.

    Distinct counts are sums over groups, which combine before the shuffle.
    """
    keys = fact.groupBy("notice_key").agg(F.count("*").alias("n"))
    flags = fact.groupBy("trigger_num").agg(F.count_if("is_latest_revision").alias("flags"))
    per_key = keys.agg(F.sum("n").alias("fact_rows"), F.count("*").alias("revisions"))
    per_trigger = flags.agg(
        F.count("*").alias("triggers"),
        F.sum("flags").alias("latest_rows"),
        F.count_if(F.col("flags") != 1).alias("triggers_without_one_latest"),
    )
    names = [*per_key.columns, *per_trigger.columns]
    return per_key.unionByName(per_trigger, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])


def row_digest(columns: list[str], maps: tuple[str, ...] = ("rescued_fields",)) -> Column:
    """Hash of all values; maps count as sorted entries."""
    parts = [F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def differences(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Rows on each side per group, and rows that lack a partner with equal values."""
    sides = [
        frame.select(*by, row_digest(left.columns).alias("digest"), F.lit(side).alias("side"))
        for frame, side in ((left, 1), (right, -1))
    ]
    rows = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*by, "digest")
        .agg(F.count_if(F.col("side") > 0).alias("l"), F.count_if(F.col("side") < 0).alias("r"))
    )
    return rows.groupBy(*by).agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.sum(F.abs(F.col("l") - F.col("r"))).alias("unmatched_rows"),
    )


def unknown_field_counts(silver: DataFrame) -> DataFrame:
    """How often each field occurs that the model does not cover."""
    names = silver.where("rescued_fields IS NOT NULL").select(
        F.explode(F.map_keys("rescued_fields")).alias("field_name")
    )
    return names.groupBy("field_name").agg(F.count("*").alias("notices"))
