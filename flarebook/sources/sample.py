"""Notices derived from the ``events`` table, in the shape of Kafka records.

Each event becomes one record. The text uses every feature of the notice
format: padding with no-break spaces, five kinds of line break, wrapped values,
repeated and unknown fields, missing fields and text that is no notice at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flarebook.session import SHORT_METHODS, settings

TOPIC = "alerts.notices.final_position"
DEAD_END = "error"  # event type without a trigger number


def _fixed(n: Column, digits: int) -> Column:
    """Integer ``n`` as decimal text with ``digits`` fraction digits."""
    scale = 10**digits
    size = F.abs(n)
    return F.concat(
        F.when(n < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(size / scale).cast("string"),
        F.lit("."),
        F.lpad((size % scale).cast("string"), digits, "0"),
    )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.rpad(F.lit(f"{name}:"), 17, " "), value)


def _spread(e: Column, step: int, modulus: int) -> Column:
    # Reducing first keeps the product small whatever the size of the id.
    return (e % modulus) * step % modulus


def notice_text(e: Column, user: Column, kind: Column, t: Column, value: Column, props: Column) -> Column:
    has_position = ~((kind == "view") & (e % 2 == 0))
    has_context = kind != "purchase"
    micros = F.unix_micros(t)
    day_micros = micros % 86_400_000_000
    notice_time = F.timestamp_seconds(F.floor(micros / 1_000_000) + e % 900)
    # Pairs of notices have one position; the first of them knows no Sun or Moon.
    place = F.when(e % 61 == 1, e - 1).otherwise(e)
    has_sky = has_context & (e % 61 != 0)
    error = F.when(e % 61 < 2, F.lit(100)).otherwise(F.round(value * 100).cast("bigint"))
    ra = _spread(place, 7919, 360_000)
    dec = _spread(place, 104_729, 180_001) - 90_000
    # Numbers beyond 32 bits, and some with zeros or a sign in front.
    record = e % 40 + F.when(e % 53 == 0, 3_000_000_000).otherwise(0)
    record_text = F.concat(F.when(e % 59 == 0, "+00").otherwise(""), record.cast("string"))

    line_break = (
        F.when(user % 32 == 0, "\r\n")
        .when(user % 32 == 1, "\r")
        .when(user % 32 == 2, "\x0b")
        .when(user % 32 == 3, "\u2028")
        .when(user % 32 == 4, "  \t\n")
        .otherwise("\n")
    )
    indent = F.lit(" " * 17)

    lines = [
        F.when(
            kind == "click", F.concat(F.lit("TITLE:" + "\u00a0" * 11), F.lit("ALERT NOTICE "), kind)
        ).otherwise(_line("TITLE", F.concat(F.lit("ALERT NOTICE "), kind))),
        _line(
            "NOTICE_DATE",
            F.concat(
                # A date in another notation is not read.
                F.when(e % 43 == 0, F.date_format(notice_time, "yyyy/MMM/dd/HH:mm:ss"))
                .when(e % 11 == 0, F.date_format(notice_time, "E dd MMM yyyy HH:mm:ss"))
                .otherwise(F.date_format(notice_time, "E dd MMM yy HH:mm:ss")),
                F.lit(" UT"),
            ),
        ),
        _line("NOTICE_TYPE", F.when(e % 7 == 0, "Final").otherwise("Final Position")),
        F.when(e % 7 == 0, F.concat(indent, F.lit("Position"))),
        F.when(e % 97 != 0, _line("RECORD_NUM", record_text)),
        F.when(kind != DEAD_END, _line("TRIGGER_NUM", (user + 700_000_000).cast("string"))),
        F.when(
            has_position,
            _line("GRB_RA", F.concat(_fixed(ra, 3), F.lit("d {at the epoch} (J2000),"))),
        ),
        F.when(has_position & (kind == "click"), F.lit("   ")),
        F.when(
            has_position,
            F.concat(indent, _fixed((ra + 339) % 360_000, 3), F.lit("d {at this date} (current),")),
        ),
        F.when(
            has_position,
            F.concat(indent, _fixed((ra + 359_352) % 360_000, 3), F.lit("d {older epoch} (1950)")),
        ),
        F.when(
            has_position,
            _line("GRB_DEC", F.concat(_fixed(dec, 3), F.lit("d {at the epoch} (J2000),"))),
        ),
        F.when(has_position, F.concat(indent, _fixed(-dec, 3), F.lit("d {at this date} (current)"))),
        F.when(
            has_position,
            _line(
                "GRB_ERROR",
                F.concat(
                    _fixed(error, 2),
                    F.lit(" [deg] radius of the error circle"),
                ),
            ),
        ),
        _line(
            "GRB_DATE",
            F.concat(
                F.datediff(t.cast("date"), F.lit("1968-05-24").cast("date")).cast("string"),
                F.lit(" TJD;   "),
                F.dayofyear(t).cast("string"),
                F.lit(" DOY;   "),
                F.date_format(t, "yy/MM/dd"),
            ),
        ),
        F.when(
            ~((kind == "purchase") & (e % 10 == 0)),
            _line(
                "GRB_TIME",
                F.concat(
                    _fixed(F.floor(day_micros / 10_000), 2),
                    F.lit(" SOD {"),
                    F.date_format(t, "HH:mm:ss.SS"),
                    F.lit("} UT"),
                ),
            ),
        ),
        F.when(has_context, _line("GRB_PHI", F.concat(_fixed(_spread(e, 23, 36_000), 2), F.lit(" [deg]")))),
        F.when(has_context, _line("GRB_THETA", F.concat(_fixed(_spread(e, 29, 18_000), 2), F.lit(" [deg]")))),
        F.when(kind == "signup", _line("E_RANGE", F.lit("8-20 [keV]"))),
        _line("E_RANGE", F.concat(F.lit("47-"), (e % 100 + 200).cast("string"), F.lit(" [keV]"))),
        _line("LOC_ALGORITHM", F.lit("3 (the third scheme)")),
        _line(
            "LC_URL",
            F.when(kind == "click", "").otherwise(
                F.concat(F.lit("http://data.example.org/quicklook/lc_"), e.cast("string"), F.lit(".gif"))
            ),
        ),
        _line("LOC_URL", F.concat(F.lit("http://data.example.org:80/loc/a:b/"), e.cast("string"))),
        F.when(
            has_sky,
            _line(
                "SUN_POSTN",
                F.concat(
                    _fixed(_spread(e, 31, 36_000), 2),
                    F.lit("d {of the Sun}  "),
                    _fixed(_spread(e, 17, 4_700) - 2_350, 2),
                    F.lit("d {of the Sun}"),
                ),
            ),
        ),
        F.when(
            has_sky,
            _line(
                "SUN_DIST",
                F.concat(_fixed(_spread(e, 13, 18_000), 2), F.lit(" [deg]   on the sky, 3.5 [hr] behind")),
            ),
        ),
        F.when(
            has_sky,
            _line(
                "MOON_POSTN",
                F.concat(
                    _fixed(_spread(e, 37, 36_000), 2),
                    F.lit("d {of the Moon}  "),
                    _fixed(_spread(e, 19, 5_700) - 2_850, 2),
                    F.lit("d {of the Moon}"),
                ),
            ),
        ),
        F.when(has_sky, _line("MOON_DIST", F.concat(_fixed(_spread(e, 11, 18_000), 2), F.lit(" [deg]")))),
        F.when(has_sky, _line("MOON_ILLUM", F.concat((e % 101).cast("string"), F.lit(" [%]")))),
        F.when(
            has_context & has_position,
            _line(
                "GAL_COORDS",
                F.concat(
                    _fixed(_spread(place, 41, 36_000), 2),
                    F.lit(",  "),
                    _fixed(_spread(place, 43, 18_001) - 9_000, 2),
                    F.lit(" [deg] from the galactic plane"),
                ),
            ),
        ),
        F.when(
            has_context & has_position,
            _line(
                "ECL_COORDS",
                F.concat(
                    _fixed(_spread(place, 47, 36_000), 2),
                    F.lit(",   "),
                    _fixed(_spread(place, 53, 18_001) - 9_000, 2),
                    F.lit(" [deg] from the ecliptic"),
                ),
            ),
        ),
        F.when((kind == "signup") & (e % 3 == 0), _line("UNKNOWN_FUTURE", F.lit("superseded"))),
        F.when(kind == "signup", _line("UNKNOWN_FUTURE", props)),
        F.when(e % 4 == 0, _line("SPACECRAFT", F.concat(F.lit("unit "), (e % 3).cast("string")))),
        F.when(kind == "view", _line("COMMENTS", F.lit("Position from ground analysis."))).otherwise(
            _line("COMMENTS", F.concat(F.lit("Automatic notice "), e.cast("string"), F.lit(".")))
        ),
        F.when(kind == "view", F.lit("COMMENTS:")),
        F.when(kind == "view", _line("COMMENTS", F.concat(F.lit("Review pending for "), e.cast("string")))),
        F.when(kind == "view", F.lit("and continues here.")),
    ]
    notice = F.concat_ws("\n", *lines)
    notice = F.replace(notice, F.lit("\n"), line_break)
    stray = F.concat(F.lit("\t-- link test --\n\toperator on duty says: please stand by, call "), e.cast("string"))
    return F.when((kind == DEAD_END) & (e % 2 == 0), stray).otherwise(notice)


def envelope_from_events(events: DataFrame) -> DataFrame:
    e, t = F.col("event_id"), F.col("ts").cast("timestamp")
    text = notice_text(e, F.col("user_id"), F.col("event_type"), t, F.col("value"), F.col("props"))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(text, "UTF-8").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (e % 4).cast("int").alias("partition"),
        e.alias("offset"),
        t.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_replay(spark: SparkSession, events: DataFrame, path: str) -> None:
    """Store the derived records, spread evenly over as many tasks as a shuffle has."""
    events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Text is far larger than the event it comes from, so long tasks roll files.
    with settings(spark, SHORT_METHODS):
        (
            envelope_from_events(events)
            .write.option("maxRecordsPerFile", 1_000_000)
            .mode("overwrite")
            .parquet(path)
        )
