"""Bronze to Silver: one typed row per notice."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flarebook.functions import extract as x
from flarebook.functions import notice_text as t
from flarebook.functions.keys import notice_key
from flarebook.schemas import LINEAGE, NOTICE_TYPES

# Fields kept as text, and fields read into typed columns.
TEXT_FIELDS = (
    "TITLE",
    "NOTICE_TYPE",
    "E_RANGE",
    "LOC_ALGORITHM",
    "LC_URL",
    "LOC_URL",
    "COMMENTS",
)
TYPED_FIELDS = (
    "NOTICE_DATE",
    "RECORD_NUM",
    "TRIGGER_NUM",
    "GRB_RA",
    "GRB_DEC",
    "GRB_ERROR",
    "GRB_DATE",
    "GRB_TIME",
    "GRB_PHI",
    "GRB_THETA",
    "SUN_POSTN",
    "SUN_DIST",
    "MOON_POSTN",
    "MOON_DIST",
    "MOON_ILLUM",
    "GAL_COORDS",
    "ECL_COORDS",
)


def _text(name: str) -> Column:
    return t.joined_entries(name) if name == t.REPEATED_FIELD else t.text_field(name)


# What is read from one field each, over a frame that has its entries. Names
# that are no Silver columns are parts of some.
FOUND: dict[str, Callable[[], Column]] = {
    "trigger_digits": lambda: x.leading_digits(t.entry_value("TRIGGER_NUM")),
    "record_digits": lambda: x.leading_digits(t.entry_value("RECORD_NUM")),
    "ra_deg": lambda: x.first_degrees(t.entry_value("GRB_RA")),
    "dec_deg": lambda: x.first_degrees(t.entry_value("GRB_DEC")),
    "error_radius_deg": lambda: x.leading_number(t.entry_value("GRB_ERROR")),
    "phi_deg": lambda: x.leading_number(t.entry_value("GRB_PHI")),
    "theta_deg": lambda: x.leading_number(t.entry_value("GRB_THETA")),
    "galactic_pair": lambda: x.coordinate_pair(t.entry_value("GAL_COORDS")),
    "ecliptic_pair": lambda: x.coordinate_pair(t.entry_value("ECL_COORDS")),
    "sun_ra_deg": lambda: x.position_pair(t.entry_value("SUN_POSTN"))[0],
    "sun_dec_deg": lambda: x.position_pair(t.entry_value("SUN_POSTN"))[1],
    "sun_dist_deg": lambda: x.leading_number(t.entry_value("SUN_DIST")),
    "moon_ra_deg": lambda: x.position_pair(t.entry_value("MOON_POSTN"))[0],
    "moon_dec_deg": lambda: x.position_pair(t.entry_value("MOON_POSTN"))[1],
    "moon_dist_deg": lambda: x.leading_number(t.entry_value("MOON_DIST")),
    "moon_illum_pct": lambda: x.leading_number(t.entry_value("MOON_ILLUM")),
    **{name.lower(): lambda name=name: _text(name) for name in TEXT_FIELDS},
    "rescued_fields": lambda: t.other_fields((*TYPED_FIELDS, *TEXT_FIELDS)),
    "notice_date_parts": lambda: x.calendar_parts(t.entry_value("NOTICE_DATE")),
    "burst_days": lambda: x.day_number(t.entry_value("GRB_DATE")),
    "burst_seconds": lambda: x.day_seconds(t.entry_value("GRB_TIME")),
}

# What is put together from found values. Found values in several places are a
# projection of their own, so none of them is searched for twice.
COMBINED: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "trigger_num": (("trigger_digits",), x.leading_integer),
    "record_num": (("record_digits",), lambda digits: x.leading_integer(digits, "int")),
    "notice_key": (
        ("trigger_digits", "record_digits"),
        lambda trigger, record: notice_key(x.leading_integer(trigger), record),
    ),
    **{
        f"{system}_{name}_deg": ((f"{system}_pair",), lambda pair, place=place: x.pair_member(pair, place))
        for system in ("galactic", "ecliptic")
        for place, name in enumerate(("lon", "lat"))
    },
    "notice_time": (("notice_date_parts",), x.calendar_timestamp),
    "burst_time": (("burst_days", "burst_seconds"), x.day_timestamp),
    "burst_date": (("burst_days",), x.day_date),
    "is_parsed": (("trigger_digits",), lambda digits: x.leading_integer(digits).isNotNull()),
}


def parse_notices(
    bronze: DataFrame,
    names: Iterable[str] = tuple(NOTICE_TYPES),
    cut: Callable[[DataFrame], DataFrame] = t.with_entries,
) -> DataFrame:
    """The named notice columns, the way back to the broker, the payload as sent."""
    names = tuple(names)
    needed = dict.fromkeys(part for name in names for part in COMBINED.get(name, ((name,),))[0])
    carried = [*LINEAGE, F.col("payload").alias("raw_payload")]
    found = cut(bronze).select(*[FOUND[part]().alias(part) for part in needed], *carried)

    def column(name: str) -> Column:
        if name not in COMBINED:
            return F.col(name)
        parts, combine = COMBINED[name]
        return combine(*map(F.col, parts)).alias(name)

    return found.select(*map(column, names), *LINEAGE, "raw_payload")


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` over a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def parsed_notice(payload: Column | str) -> Column:
    """All notice columns of a payload as one struct, for any ``select`` of a batch or a stream.

    The payload is cut once. ``parse_notices`` builds only the columns that a
    query asks for and is the faster way to a table.
    """

    def cut(entries: Column) -> Column:
        return F.struct(entries.alias(t.ENTRIES), t.names(entries).alias(t.NAMES))

    def found(notice: Column) -> Column:
        with t.read_from(lambda name: notice[name]):
            return F.struct(*[make().alias(part) for part, make in FOUND.items()])

    def combined(parts: Column) -> Column:
        columns = {}
        for name in NOTICE_TYPES:
            needed, combine = COMBINED.get(name, ((name,), lambda value: value))
            columns[name] = combine(*[parts[part] for part in needed])
        return F.struct(*[column.alias(name) for name, column in columns.items()])

    text = F.col(payload) if isinstance(payload, str) else payload
    return _bound(
        t.entries(text), lambda entries: _bound(cut(entries), lambda notice: _bound(found(notice), combined))
    )


# How a field that was kept as text becomes a typed column.
READ_AS: dict[str, Callable[[Column], Column]] = {
    "string": lambda text: text,
    "double": x.leading_number,
    "bigint": lambda text: x.leading_integer(x.leading_digits(text)),
}


@dataclass(frozen=True)
class LaterField:
    """A column that a later version of the schema has, and the field of the notice it comes from."""

    name: str
    source: str
    kind: str = "string"


def with_later_fields(silver: DataFrame, fields: Iterable[LaterField]) -> DataFrame:
    """Notices of any earlier version as those of a later one.

    A field that an earlier version did not know lies among the rescued ones,
    as text; it moves from there to its column. Rows that have the column
    already keep its value, so old and new files read together are alike, and
    doing it again changes nothing.
    """
    fields = tuple(fields)
    rescued = F.col("rescued_fields")

    def value(field: LaterField) -> Column:
        found = READ_AS[field.kind](rescued[field.source])
        return F.coalesce(F.col(field.name), found) if field.name in silver.columns else found

    rest = F.map_filter(rescued, lambda name, _: ~name.isin([field.source for field in fields]))
    moved = {field.name: value(field) for field in fields}
    return silver.withColumns({**moved, "rescued_fields": F.when(F.size(rest) > 0, rest)}) if fields else silver


def cleaned(silver: DataFrame) -> DataFrame:
    return silver.where("is_parsed")


def quarantine(silver: DataFrame) -> DataFrame:
    return silver.where("not is_parsed")
