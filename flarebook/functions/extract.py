"""Typed values out of prose. Bad or missing text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flarebook.functions.notice_text import BLANK, BLANK_CHARACTERS

# Fixed values of the notice format. Repeats are possessive, and a search begins
# at a run of digits only once, so that the time grows in line with the text.
NUMBER = r"[-+]?\d++(?:\.\d++)?"
SOMEWHERE = r"(?:[-+]|(?<!\d))"
FOUND_NUMBER = rf"{SOMEWHERE}\d++(?:\.\d++)?"
DEGREES = rf"({FOUND_NUMBER}){BLANK}*+d\b"
LEADING = rf"^{BLANK}*+({NUMBER})"
LEADING_DIGITS = rf"^{BLANK}*+([-+]?\d++)"
PAIR = rf"{FOUND_NUMBER}{BLANK}*+,{BLANK}*+{NUMBER}"
DAY_NUMBER = rf"({SOMEWHERE}\d++)(?:\.\d++)?{BLANK}*+TJD"
DAY_SECONDS = rf"({FOUND_NUMBER}){BLANK}*+SOD"
DAY_ZERO = "1968-05-24"
DAY_NUMBER_RANGE = (-718_575, 2_933_483)  # 0001-01-01 to 9999-12-31
MICROS_RANGE = (-62_135_596_800_000_000, 253_402_300_799_999_999)
ZONE_LABEL = "UT"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
CALENDAR = (
    rf"^(?:mon|tue|wed|thu|fri|sat|sun){BLANK}+(3[01]|[12]\d|0[1-9]|[1-9]){BLANK}+"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    rf"{BLANK}+(\d{{4}}|\d{{2}}){BLANK}+((?:2[0-3]|[01]\d|\d):(?:[0-5]\d|\d):(?:[0-5]\d|\d))$"
)


def to_double(text: Column) -> Column:
    """Number or null; minus zero becomes zero so that it hashes like zero."""
    return F.nullif(text, F.lit("")).try_cast("double") + F.lit(0.0)


def first_degrees(value: Column) -> Column:
    """First number marked as degrees; the first epoch listed is J2000."""
    return to_double(F.regexp_extract(value, DEGREES, 1))


def leading_number(value: Column) -> Column:
    return to_double(F.regexp_extract(value, LEADING, 1))


def leading_digits(value: Column) -> Column:
    """Whole part of the leading number as text, whatever its length: no plus
    sign, no leading zeros, no minus zero; null without a number."""
    found = F.regexp_extract(value, LEADING_DIGITS, 1)
    bare = F.ltrim(F.ltrim(found, F.lit("+-")), F.lit("0"))
    sign = F.when(F.startswith(found, F.lit("-")), "-").otherwise("")
    return F.when(found != "", F.when(bare == "", "0").otherwise(F.concat(sign, bare)))


def leading_integer(digits: Column, kind: str = "bigint") -> Column:
    """Leading digits as a number; null beyond the type."""
    return digits.try_cast(kind)


def coordinate_pair(value: Column) -> Column:
    """The text of the first pair of numbers, found in one search."""
    return F.regexp_extract(value, PAIR, 0)


def pair_member(pair: Column, place: int) -> Column:
    return to_double(F.btrim(F.get(F.split(pair, ","), F.lit(place)), F.lit(BLANK_CHARACTERS)))


def position_pair(value: Column) -> tuple[Column, Column]:
    """First two numbers marked as degrees, null unless there are two."""
    both = rf"(?s){DEGREES}.*?{DEGREES}"
    return to_double(F.regexp_extract(value, both, 1)), to_double(F.regexp_extract(value, both, 2))


def day_number(value: Column) -> Column:
    """Whole days since the day zero of the format."""
    return F.regexp_extract(value, DAY_NUMBER, 1).try_cast("int")


def day_seconds(value: Column) -> Column:
    return F.nullif(F.regexp_extract(value, DAY_SECONDS, 1), F.lit("")).try_cast("double")


def day_date(days: Column) -> Column:
    """Calendar date of a day number; null outside the years 1 to 9999."""
    return F.when(
        days.between(*DAY_NUMBER_RANGE), F.date_add(F.lit(DAY_ZERO).cast("date"), days)
    )


def day_timestamp(days: Column, seconds: Column) -> Column:
    """Day number plus seconds of day, to the microsecond; may pass midnight."""
    whole = F.when(F.abs(seconds) < 1e12, seconds).cast("bigint")
    micros = (
        F.unix_date(day_date(days)).cast("bigint") * 86_400_000_000
        + whole * 1_000_000
        + F.rint((seconds - whole) * 1_000_000).cast("bigint")
    )
    return F.when(micros.between(*MICROS_RANGE), F.timestamp_micros(micros))


def calendar_parts(value: Column) -> Column:
    """Year, month name, day and clock of ``Wed 13 Aug 25 04:12:33 UT``.

    Null for text of another form, even if it has the parts.
    """
    clean = F.lower(F.btrim(F.replace(value, F.lit(ZONE_LABEL), F.lit("")), F.lit(BLANK_CHARACTERS)))
    return F.when(F.rlike(clean, F.lit(CALENDAR)), F.split(F.regexp_replace(clean, CALENDAR, "$3/$2/$1/$4"), "/"))


def calendar_timestamp(parts: Column) -> Column:
    """Two-digit years from 69 on are 19xx. A weekday was required but is not
    compared with the date."""
    year, month, day, clock = (F.get(parts, F.lit(i)) for i in range(4))
    month_number = ((F.instr(F.lit(MONTHS), month) + 2) / 3).cast("int")
    century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
    iso = F.concat(century, year, F.lit("-"), month_number.cast("string"), F.lit("-"), day, F.lit(" "), clock)
    return F.when(year != "0000", iso.try_cast("timestamp"))
