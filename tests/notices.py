"""Hand-written notices and a frame of Bronze rows for them."""

from __future__ import annotations

import datetime as dt

from flarebook.schemas import BRONZE

FULL = """TITLE:           ALERT NOTICE
NOTICE_DATE:     Tue 05 Mar 24 10:20:30 UT
NOTICE_TYPE:     Final Position
RECORD_NUM:      17
TRIGGER_NUM:     712345678
GRB_RA:          120.250d {+08h 01m 00s} (J2000),
                 120.600d {+08h 02m 24s} (current),
                 119.500d {+07h 58m 00s} (1950)
GRB_DEC:         -45.125d {-45d 07' 30"} (J2000),
                 -45.200d {-45d 12' 00"} (current)
GRB_ERROR:       2.50 [deg] radius of the error circle
GRB_DATE:        20374 TJD;    65 DOY;   24/03/05
GRB_TIME:        36900.25 SOD {10:15:00.25} UT
GRB_PHI:         31.00 [deg]
GRB_THETA:       62.00 [deg]
E_RANGE:         50-300 [keV]
LOC_ALGORITHM:   3 (the third scheme)
LC_URL:          http://data.example.org/lc.gif
LOC_URL:         http://data.example.org:80/a:b.png
SUN_POSTN:       346.11d {+23h 04m 26s}   -5.92d {-05d 55' 12"}
SUN_DIST:        120.50 [deg]   on the sky
MOON_POSTN:      270.40d {+18h 01m 36s}  -28.30d {-28d 18' 00"}
MOON_DIST:       101.75 [deg]
MOON_ILLUM:      33 [%]
GAL_COORDS:      262.10,  -7.40 [deg] from the galactic plane
ECL_COORDS:      140.20, -63.90 [deg] from the ecliptic
COMMENTS:        First remark.
COMMENTS:
COMMENTS:        Second remark
    goes on.
"""

STRAY = "\t-- link test --\n\toperator on duty says: please stand by\n"


def notice(*lines: str, trigger: str | None = "1") -> str:
    head = [] if trigger is None else [f"TRIGGER_NUM: {trigger}"]
    return "\n".join([*head, *lines])


def bronze_frame(spark, payloads, at=None):
    start = dt.datetime(2024, 3, 5, 12, 0, 0, tzinfo=dt.timezone.utc)
    rows = [
        (text, None, "topic", 0, i, start + dt.timedelta(seconds=i if at is None else at[i]), start)
        for i, text in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, BRONZE)
