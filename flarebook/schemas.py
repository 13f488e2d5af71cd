"""Fixed table shapes. Nothing is inferred, so a new upstream field can never
change a table in mid-stream; unknown fields go to the ``rescued_fields`` map."""

from __future__ import annotations

# A Kafka record as the connector delivers it.
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint,"
    " timestamp timestamp, timestampType int"
)

BRONZE = (
    "payload string, message_key string, topic string, partition int,"
    " offset bigint, kafka_timestamp timestamp, ingested_at timestamp"
)

NOTICE_TYPES = {
    "notice_key": "string",
    "trigger_num": "bigint",
    "record_num": "int",
    "notice_time": "timestamp",
    "burst_time": "timestamp",
    "burst_date": "date",
    "ra_deg": "double",
    "dec_deg": "double",
    "error_radius_deg": "double",
    "phi_deg": "double",
    "theta_deg": "double",
    "galactic_lon_deg": "double",
    "galactic_lat_deg": "double",
    "ecliptic_lon_deg": "double",
    "ecliptic_lat_deg": "double",
    "sun_ra_deg": "double",
    "sun_dec_deg": "double",
    "sun_dist_deg": "double",
    "moon_ra_deg": "double",
    "moon_dec_deg": "double",
    "moon_dist_deg": "double",
    "moon_illum_pct": "double",
    "title": "string",
    "notice_type": "string",
    "e_range": "string",
    "loc_algorithm": "string",
    "lc_url": "string",
    "loc_url": "string",
    "comments": "string",
    "rescued_fields": "map<string,string>",
    "is_parsed": "boolean",
}
NOTICE = ", ".join(f"{name} {kind}" for name, kind in NOTICE_TYPES.items())

LINEAGE = ("topic", "partition", "offset", "kafka_timestamp", "ingested_at")

SILVER_COLUMNS = (*NOTICE_TYPES, *LINEAGE, "raw_payload")
SILVER = (
    f"{NOTICE}, topic string, partition int, offset bigint,"
    " kafka_timestamp timestamp, ingested_at timestamp, raw_payload string"
)

POSITION = (
    "ra_deg",
    "dec_deg",
    "error_radius_deg",
    "galactic_lon_deg",
    "galactic_lat_deg",
    "ecliptic_lon_deg",
    "ecliptic_lat_deg",
)

SKY_CONTEXT = (
    "sun_ra_deg",
    "sun_dec_deg",
    "sun_dist_deg",
    "moon_ra_deg",
    "moon_dec_deg",
    "moon_dist_deg",
    "moon_illum_pct",
)

FACT_COLUMNS = (
    "notice_key",
    "trigger_num",
    "record_num",
    "timing_key",
    "spatial_key",
    "error_radius_deg",
    "phi_deg",
    "theta_deg",
    "e_range",
    "loc_algorithm",
    "lc_url",
    "loc_url",
    "comments",
    "is_latest_revision",
    "ingested_at",
)
