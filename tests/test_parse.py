"""The notice format and its edges."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from flarebook.functions import extract as x
from flarebook.functions import notice_text as t
from flarebook.operators.arrow_cut import with_arrow_entries
from flarebook.operators.arrow_parse import parse_in_python, register
from flarebook.operators.quality import differences
from flarebook.operators.silver import parse_notices, parsed_notice
from flarebook.schemas import NOTICE_TYPES, SILVER
from notices import FULL, STRAY, bronze_frame, notice


def parse(spark, *payloads, **options):
    """Parsed rows in input order; times as text."""
    frame = parse_notices(bronze_frame(spark, payloads), **options)
    for name, kind in NOTICE_TYPES.items():
        if kind in ("timestamp", "date") and name in frame.columns:
            frame = frame.withColumn(name, F.col(name).cast("string"))
    return frame.orderBy("offset").collect()


def test_full_notice(spark):
    row = parse(spark, FULL)[0].asDict()
    expected = {
        "notice_key": "712345678-17",
        "trigger_num": 712345678,
        "record_num": 17,
        "notice_time": "2024-03-05 10:20:30",
        "burst_time": "2024-03-05 10:15:00.25",
        "burst_date": "2024-03-05",
        "ra_deg": 120.25,
        "dec_deg": -45.125,
        "error_radius_deg": 2.5,
        "phi_deg": 31.0,
        "theta_deg": 62.0,
        "galactic_lon_deg": 262.1,
        "galactic_lat_deg": -7.4,
        "ecliptic_lon_deg": 140.2,
        "ecliptic_lat_deg": -63.9,
        "sun_ra_deg": 346.11,
        "sun_dec_deg": -5.92,
        "sun_dist_deg": 120.5,
        "moon_ra_deg": 270.4,
        "moon_dec_deg": -28.3,
        "moon_dist_deg": 101.75,
        "moon_illum_pct": 33.0,
        "title": "ALERT NOTICE",
        "notice_type": "Final Position",
        "e_range": "50-300 [keV]",
        "loc_algorithm": "3 (the third scheme)",
        "lc_url": "http://data.example.org/lc.gif",
        "loc_url": "http://data.example.org:80/a:b.png",
        "comments": "First remark. Second remark goes on.",
        "rescued_fields": None,
        "is_parsed": True,
        "raw_payload": FULL,
    }
    assert {k: row[k] for k in expected} == expected


def test_shape_is_declared_and_stable(spark):
    frame = parse_notices(bronze_frame(spark, ["", FULL]))
    assert ", ".join(f"{n} {k}" for n, k in frame.dtypes) == SILVER


@pytest.mark.parametrize("payload", [None, "", "   ", STRAY, "TRIGGER_NUM", "trigger_num: 5", " TRIGGER_NUM: 5"])
def test_no_field_is_quarantined_without_error(spark, payload):
    row = parse(spark, payload)[0]
    assert row.is_parsed is False
    assert all(row[n] is None for n in NOTICE_TYPES if n != "is_parsed")


def test_fields_without_trigger_are_quarantined_with_their_values(spark):
    row = parse(spark, notice("GRB_RA: 10.5d", "RECORD_NUM: 4", trigger=None))[0]
    assert (row.is_parsed, row.notice_key, row.ra_deg, row.record_num) == (False, None, 10.5, 4)


TEXT_CASES = [
    (["TITLE: a\nb"], "a b"),  # unindented prose goes on
    (["TITLE: a\n\n  \n  b"], "a b"),  # a blank line does not end a field
    (["TITLE: a\r\n  b"], "a b"),
    (["TITLE: a\x0b  b\x0c c\x1dd"], "a b c d"),
    (["TITLE: a\u2028  b\u2029c\x85d"], "a b c d"),
    (["TITLE: a  \t\n   b \t"], "a b"),  # ends of lines are stripped
    (["TITLE: a\tb"], "a\tb"),  # inner blanks stay
    (["TITLE:\n   only here"], "only here"),
    (["TITLE:"], ""),
    (["TITLE: \u00a0\u00a0a\u00a0b"], "a b"),
    (["TITLE: a", "   TITLE: b"], "a TITLE: b"),  # indented, so no field
    (["TITLE: a", "title: b"], "a title: b"),
    (["TITLE: a", "HTTP://x"], "a"),  # a field named HTTP
    (["TITLE: a", "TITLE: b"], "b"),
    (["TITLE: x:y:z"], "x:y:z"),
    (["\u3000", "TITLE:\u2003a\u3000"], "a"),
    (["1TITLE: a"], None),
]


def test_text_values(spark):
    rows = parse(spark, *[notice(*lines) for lines, _ in TEXT_CASES])
    assert [row.title for row in rows] == [expected for _, expected in TEXT_CASES]


def test_comments(spark):
    cases = {
        notice("COMMENTS: a", "TITLE: x", "COMMENTS: b\n  c"): "a b c",
        notice("COMMENTS:", "COMMENTS:   "): "",
        notice("COMMENTS:", "COMMENTS: a"): "a",
        notice("TITLE: x"): None,
    }
    assert [r.comments for r in parse(spark, *cases)] == list(cases.values())


def test_unknown_fields_are_kept(spark):
    cases = {
        notice("NEW_ONE: a:b", "OTHER2: c\n  d", "NEW_ONE: last"): {"NEW_ONE": "last", "OTHER2": "c d"},
        notice("HTTP://x"): {"HTTP": "//x"},
        notice("EMPTY:"): {"EMPTY": ""},
        notice("COMMENTS: a"): None,
    }
    assert [r.rescued_fields for r in parse(spark, *cases)] == list(cases.values())


def column_values(spark, column, field, values):
    return [r[column] for r in parse(spark, *[notice(f"{field}: {v}") for v in values])]


def test_degrees(spark):
    cases = {
        "10.5d (J2000), 11d": 10.5,
        "+41.200d": 41.2,
        "-0.000d": 0.0,
        "7 d": 7.0,
        "12deg 3d": 3.0,  # d must end a word
        "1.5\n   d": 1.5,
        "none": None,
        "": None,
        "9" * 400 + "d": float("inf"),
    }
    values = column_values(spark, "dec_deg", "GRB_DEC", cases)
    assert values == list(cases.values())
    assert str(values[2]) == "0.0"


def test_leading_number(spark):
    cases = {"1.75 [deg]": 1.75, "-4": -4.0, ".5": None, "1.": 1.0, "1e5": 1.0, "x 1": None, "\t\u2003 8": 8.0}
    assert column_values(spark, "error_radius_deg", "GRB_ERROR", cases) == list(cases.values())


def test_pairs(spark):
    rows = parse(
        spark,
        notice("GAL_COORDS: lon 1.5 ,  -2 [deg]", "SUN_POSTN: 1d {+2h 3m}  +4.5d {+14d 19'}"),
        notice("GAL_COORDS: 1.5", "SUN_POSTN: 1d only"),
    )
    assert (rows[0].galactic_lon_deg, rows[0].galactic_lat_deg) == (1.5, -2.0)
    assert (rows[0].sun_ra_deg, rows[0].sun_dec_deg) == (1.0, 4.5)
    assert (rows[1].galactic_lon_deg, rows[1].galactic_lat_deg) == (None, None)
    assert (rows[1].sun_ra_deg, rows[1].sun_dec_deg) == (None, None)


def test_integers_and_keys(spark):
    cases = {
        "9007199254740993": ("9007199254740993", 9007199254740993),  # beyond exact doubles
        "12.9": ("12", 12),
        "+5 x": ("5", 5),
        "9" * 400: (None, None),
        "abc": (None, None),
    }
    rows = parse(spark, *[notice(trigger=value) for value in cases])
    assert [(r.notice_key, r.trigger_num) for r in rows] == list(cases.values())


def test_burst_date_and_time(spark):
    cases = {
        ("20374 TJD", "0.5 SOD"): ("2024-03-05", "2024-03-05 00:00:00.5"),
        ("20374.9 TJD", "86401.000001 SOD"): ("2024-03-05", "2024-03-06 00:00:01.000001"),
        ("20374 TJD", "-1 SOD"): ("2024-03-05", "2024-03-04 23:59:59"),
        ("99999999 TJD", "1 SOD"): (None, None),
        ("0 TJD", "none"): ("1968-05-24", None),
        ("none", "1 SOD"): (None, None),
        ("20374 TJD", "9" * 30 + " SOD"): ("2024-03-05", None),
        ("2933483 TJD", "0 SOD"): ("9999-12-31", "9999-12-31 00:00:00"),
    }
    rows = parse(spark, *[notice(f"GRB_DATE: {d}", f"GRB_TIME: {s}") for d, s in cases])
    assert [(r.burst_date, r.burst_time) for r in rows] == list(cases.values())


def test_notice_time(spark):
    cases = {
        "Wed 13 Aug 25 04:12:33 UT": "2025-08-13 04:12:33",
        "Mon 13 Aug 25 04:12:33 UT": "2025-08-13 04:12:33",  # the weekday is not compared
        "wed  3 AUG 2025  4:2:3": "2025-08-03 04:02:03",
        "Wed 13 Aug 68 00:00:00 UT": "2068-08-13 00:00:00",
        "Wed 13 Aug 69 00:00:00 UT": "1969-08-13 00:00:00",
        "Wed 13 Aug 75 00:00:00 UT": "1975-08-13 00:00:00",
        "Wed 29 Feb 23 00:00:00 UT": None,
        "13 Aug 25 04:12:33 UT": None,
        "Wed 13 Aug 25 04:12:60 UT": None,
        "Wed 13 Aug 25 04:12:33.5 UT": None,
        "Wed 13 Aug 0000 04:12:33 UT": None,
        "Wed/13/Aug/25": None,
        "": None,
    }
    assert column_values(spark, "notice_time", "NOTICE_DATE", cases) == list(cases.values())


def brute_fields(text):
    """Line by line, for comparison with the cut."""
    found = []
    for line in text.replace("\u00a0", " ").splitlines():
        match = re.fullmatch(r"([A-Z][A-Z0-9_]*):(.*)", line.rstrip(), re.S)
        if match:
            found.append([match[1], [match[2]]])
        elif found:
            found[-1][1].append(line)
    joined = [(k, " ".join(p.strip() for p in parts if p.strip())) for k, parts in found]
    fields = dict(joined)
    if "COMMENTS" in fields:
        fields["COMMENTS"] = " ".join(v for k, v in joined if k == "COMMENTS" and v)
    return fields


def test_random_texts_against_brute_force(spark):
    pieces = ["TITLE:", "COMMENTS:", "E_RANGE:", "X9_:", "a", "B", " ", "  ", "\t", ":", "\n", "\n", "\n", "\r\n",
              "\r", "\x0b", "\x1c", "\x1f", "\x85", "\u00a0", "\u2028", "\u3000", "\u00e9", "TITLE", "9"]
    rng = random.Random(7)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(600)]
    rows = parse(spark, *texts, names=("title", "comments", "e_range", "rescued_fields"))
    for text, row in zip(texts, rows):
        fields = brute_fields(text)
        known = {n: fields.pop(n, None) for n in ("TITLE", "COMMENTS", "E_RANGE")}
        assert (row.title, row.comments, row.e_range) == tuple(known.values()), repr(text)
        assert row.rescued_fields == (fields or None), repr(text)


def test_arrow_cut_gives_the_same(spark):
    bronze = bronze_frame(spark, [FULL, STRAY, None, *[notice(*lines) for lines, _ in TEXT_CASES]])
    result = differences(parse_notices(bronze, cut=with_arrow_entries), parse_notices(bronze), ["topic"])
    assert result.collect()[0].unmatched_rows == 0


def test_python_parse_gives_the_same(spark):
    odd = [notice(*LONG_RUNS[k].format(blanks=" ", digits="7" * 40, numbers="1.5 ", letters="A").split("\n")) for k in LONG_RUNS]
    dates = [notice(f"NOTICE_DATE: {v}") for v in ("Wed 30 Feb 24 01:02:03 UT", "2025/aug/13/04:12:33", "Mon 1 Jan 0000 00:00:00")]
    numbers = [notice(f"RECORD_NUM: {v}") for v in ("3000000001", "+007", "-0", "9" * 60)] + [notice(trigger="9" * 30)]
    bronze = bronze_frame(spark, [FULL, STRAY, None, *odd, *dates, *numbers, *[notice(*lines) for lines, _ in TEXT_CASES]])
    result = differences(parse_in_python(bronze), parse_notices(bronze), ["topic"])
    assert result.collect()[0].unmatched_rows == 0


def test_only_named_columns_are_built(spark):
    frame = parse_notices(bronze_frame(spark, [FULL]), ("is_parsed", "ra_deg"))
    assert frame.columns[:2] == ["is_parsed", "ra_deg"]
    plan = frame.select("ra_deg")._jdf.queryExecution().optimizedPlan().toString()
    assert "MOON_ILLUM" not in plan and "TRIGGER_NUM" not in plan


def test_extractors_are_plain_columns(spark):
    frame = spark.createDataFrame([("3.5 x",), (None,)], "v string")
    assert [r[0] for r in frame.select(x.leading_number(F.col("v"))).collect()] == [3.5, None]
    assert [r[0] for r in frame.select(t.one_line(F.col("v"))).collect()] == ["3.5 x", None]


def _seconds(spark, text):
    frame = bronze_frame(spark, [text])
    best = 1e9
    for _ in range(3):
        start = time.perf_counter()
        parse_notices(frame).collect()
        best = min(best, time.perf_counter() - start)
    return best


LONG_RUNS = {
    "wrapped title": "TITLE: a{blanks}\n  b{blanks}\n{blanks}c",
    "blanks before text": "GRB_ERROR: {blanks}x\nRECORD_NUM: {blanks}x\nSUN_DIST:{blanks}x",
    "digits": "GRB_RA: {digits}\nGAL_COORDS: {digits} {digits}\nGRB_DATE: {digits}\nGRB_TIME: {digits}\nSUN_POSTN: {digits}",
    "blanks after numbers": "GRB_DEC: 1{blanks}x\nECL_COORDS: 1{blanks};\nGRB_DATE: 5{blanks}x\nGRB_TIME: 5{blanks}x",
    "many numbers": "MOON_POSTN: {numbers}\nGRB_RA: {numbers}\nGAL_COORDS: {numbers}",
    "date": "NOTICE_DATE: Wed{blanks}13{blanks}Aug",
    "names": "COMMENTS: {letters}\n{letters}\n{letters}",
}


@pytest.mark.parametrize("kind", sorted(LONG_RUNS))
def test_time_grows_in_line_with_length(spark, kind):
    def text(n):
        parts = {"blanks": " \t" * (n // 2), "digits": "7" * n, "numbers": "1.5 " * (n // 4), "letters": "A" * n}
        return notice(*LONG_RUNS[kind].format(**parts).split("\n"))

    _seconds(spark, text(1000))
    short, long = _seconds(spark, text(32_000)), _seconds(spark, text(128_000))
    assert short < 3 and long < 1 + 8 * short, (short, long)


def test_patterns_find_the_first_number_as_before(spark):
    def found(values, column):
        frame = spark.createDataFrame([(v,) for v in values], "v string")
        return [r[0] for r in frame.select(column(F.col("v"))).collect()]

    assert found(["5-3d", "1.5.7d", "12d", "x+4 d", "1,2d", "12dx 8d", "1.d 2d"], x.first_degrees) == [
        -3.0, 5.7, 12.0, 4.0, 2.0, 8.0, 2.0,
    ]
    assert found(["1.5.6 TJD", "-7 TJD", "12.9TJD"], x.day_number) == [5, -7, 12]
    pair = [found(["a 1 , -2", "3.5,4", "1 2"], lambda v, i=i: x.pair_member(x.coordinate_pair(v), i)) for i in (0, 1)]
    assert pair == [[1.0, 3.5, None], [-2.0, 4.0, None]]
    assert found(["+007", "-0", " \t-12x", "x", "", "99999999999999999999"], x.leading_digits) == [
        "7", "0", "-12", None, None, "99999999999999999999",
    ]


@pytest.mark.parametrize(
    "value", ["2025/aug/13/04:12:33", "25/aug/13/04:12:33 UT", "13/aug/2025/1:2:3", "a/b/c/d", "Wed 13 Aug 25 25:00:00 UT"]
)
def test_dates_of_another_form_are_not_read(spark, value):
    row = parse_notices(bronze_frame(spark, [notice(f"NOTICE_DATE: {value}")])).collect()[0]
    assert row.notice_time is None and row.is_parsed


def test_one_column_is_the_whole_parse(spark, tmp_path):
    payloads = [FULL, STRAY, "", None, notice("RECORD_NUM: 3", "COMMENTS: a", "COMMENTS: b", "X_NEW: y")]
    bronze = bronze_frame(spark, payloads)
    found = bronze.select(parsed_notice("payload").alias("notice"), "offset").select("notice.*", "offset")
    wanted = parse_notices(bronze).select(*found.columns)
    shown = lambda frame: sorted(map(str, frame.collect()))
    assert shown(found) == shown(wanted) and found.dtypes == wanted.dtypes
    # The payload is cut once, whatever is read from the struct.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?=[A-Z]") == 1
    # In a stream, as in SQL.
    bronze.write.parquet(str(tmp_path / "bronze"))
    stream = spark.readStream.schema(bronze.schema).parquet(str(tmp_path / "bronze"))
    seen = []
    query = (
        stream.select(parsed_notice(F.col("payload")).alias("notice"), "offset")
        .select("notice.*", "offset")
        .writeStream.foreachBatch(lambda batch, _: seen.append(shown(batch)))
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert seen == [shown(wanted)]
    register(spark, "notice_of")
    in_sql = spark.sql("SELECT notice_of(payload) AS notice, offset FROM {rows}", rows=bronze).select("notice.*", "offset")
    assert shown(in_sql) == shown(wanted)
