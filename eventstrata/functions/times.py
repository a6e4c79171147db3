"""Timestamps: tolerant typing to naive UTC, whole-second differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full date, then optionally a time of at least minutes with 'Z', an offset or a zone
# name. Spark's cast alone would also take 'now', 'today' and bare times, whose value
# depends on the clock.
FULL_TIMESTAMP = (
    r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}"
    r"([T ] *\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?| [A-Za-z][\w/+-]+)?\s*)?$"
)


def _plain_spelling(text: Column) -> Column:
    """Slashes, runs of blanks and missing seconds in the form the cast understands."""
    dashed = F.regexp_replace(text, r"^\s*(\d{4})/(\d{1,2})/", "$1-$2-")
    joined = F.regexp_replace(dashed, r"^(\s*[\d-]+)[T ] *(?=\d)", "$1T")
    return F.regexp_replace(joined, r"(T\d{1,2}:\d{1,2})(?![:\d])", "$1:00")


def _end_of_day(text: Column) -> Column:
    """24:00:00, the same moment as 00:00:00 on the next day."""
    start = F.regexp_replace(_plain_spelling(text), r"T24:00:00(\.0*)?", "T00:00:00")
    next_day = start.try_cast("timestamp") + F.make_dt_interval(days=F.lit(1))
    return F.when(text.rlike(r"[T ]24:00(:00(\.0*)?)?([^.:\d]|$)"), next_day)


def parse_utc(text: Column) -> Column:
    """Typed naive UTC time, NULL when the text is no timestamp. Needs a UTC session.

    Common spellings take the plain cast; the rewrites only run where it fails.
    """
    moment = F.coalesce(
        text.try_cast("timestamp"),
        _plain_spelling(text).try_cast("timestamp"),
        _end_of_day(text),
    )
    return F.when(text.rlike(FULL_TIMESTAMP), moment).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Signed count of whole-second boundaries from ``start`` to ``end``."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
