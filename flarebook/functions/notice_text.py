"""From notice text to raw fields.

A notice is cut once, in front of every line that starts with a field name, into
an array of entries such as ``"GRB_RA: 10.5d ...\\n    10.6d ..."``. A value is
found by the position of its name in the array of names, so a query that needs
two fields builds two fields. Wrapped lines stay inside their entry and are only
joined for values stored as text: no number or time pattern depends on it.

The two arrays are projections of their own on purpose. Spark does not merge
projections when that would repeat costly work, so each is built once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the notice format: what ends a line, what counts as blank
# (every line end does), and what a field name looks like.
LINE_END = r"[\n\r\x0b\f\x1c\x1d\x1e\x85]"
WIDE_LINE_ENDS = ("\u2028", "\u2029")
BLANK = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANK_CHARACTERS = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
FIELD_NAME = "[A-Z][A-Z0-9_]*+"
NO_BREAK_SPACE = "\xa0"

REPEATED_FIELD = "COMMENTS"
REST_OF_ENTRY = 2_147_483_647

ENTRIES = "notice_entries"
NAMES = "notice_names"

_SOURCE: ContextVar[Callable[[str], Column]] = ContextVar("_SOURCE", default=lambda name: F.col(name))


@contextmanager
def read_from(source: Callable[[str], Column]) -> Iterator[None]:
    """Field expressions made meanwhile read the two arrays from ``source`` and not from columns of a frame."""
    token = _SOURCE.set(source)
    try:
        yield
    finally:
        _SOURCE.reset(token)


def _of_notice(name: str) -> Column:
    return _SOURCE.get()(name)


def entries(payload: Column) -> Column:
    """Entries in reverse order, so that the first hit is the last occurrence.

    The text before the first field is the last element. It is either empty or
    starts with a line end, hence never equals a name.
    """
    text = F.coalesce(payload, F.lit(""))
    plain = F.replace(text, F.lit(NO_BREAK_SPACE), F.lit(" "))
    for wide in WIDE_LINE_ENDS:
        plain = F.replace(plain, F.lit(wide), F.lit("\n"))
    # Nothing to replace where every character is one byte, as in most notices.
    text = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain)
    return F.reverse(F.split(F.concat(F.lit("\n"), text), f"{LINE_END}(?={FIELD_NAME}:)"))


def names(entry_array: Column) -> Column:
    return F.transform(entry_array, lambda e: F.substring_index(e, ":", 1))


def with_entries(frame: DataFrame, payload: str = "payload") -> DataFrame:
    """Add the two arrays that all field expressions read."""
    return frame.withColumn(ENTRIES, entries(F.col(payload))).withColumn(NAMES, names(F.col(ENTRIES)))


def entry_value(name: Column | str) -> Column:
    """Text behind the first colon of the last entry called ``name``."""
    position = F.array_position(_of_notice(NAMES), name).cast("int")
    length = F.lit(len(name)) if isinstance(name, str) else F.length(name)
    return F.substr(F.get(_of_notice(ENTRIES), position - 1), length + 2)


def one_line(value: Column) -> Column:
    """Wrapped lines joined by one space each, the ends stripped.

    Each line is stripped by itself, so that long runs of blanks are read once.
    """
    lines = F.transform(F.split(value, LINE_END), lambda line: F.btrim(line, F.lit(BLANK_CHARACTERS)))
    joined = F.array_join(F.filter(lines, lambda line: line != ""), " ")
    return F.when(F.rlike(value, F.lit(LINE_END)), joined).otherwise(F.btrim(value, F.lit(BLANK_CHARACTERS)))


def text_field(name: str) -> Column:
    return one_line(entry_value(name))


def joined_entries(name: str = REPEATED_FIELD) -> Column:
    """All occurrences in order, joined by one space; empty ones are skipped."""
    found = F.filter(_of_notice(ENTRIES), lambda e: F.startswith(e, F.lit(f"{name}:")))
    values = F.transform(found, lambda e: one_line(F.substring(e, len(name) + 2, REST_OF_ENTRY)))
    kept = F.filter(F.reverse(values), lambda v: v != "")
    return F.when(F.array_contains(_of_notice(NAMES), name), F.array_join(kept, " "))


def other_fields(known: tuple[str, ...]) -> Column:
    """Map of all fields outside ``known``, null if there are none."""
    found = F.slice(_of_notice(NAMES), F.lit(1), F.size(_of_notice(NAMES)) - 1)
    unknown = F.array_except(found, F.array(*[F.lit(k) for k in known]))
    values = F.transform(unknown, lambda name: one_line(entry_value(name)))
    return F.when(F.size(unknown) > 0, F.map_from_arrays(unknown, values))
