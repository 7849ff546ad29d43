"""Time stamps: edge-local wall clock, instant, and layout buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ISO-8601 shape log lines carry (date, optional time, optional fraction and offset).
ISO_STAMP = (
    r"\A(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"
)


# Fixed value: the basic and mixed shapes of the same standard that are taken as well.
BASIC_STAMP = (
    r"\A(?!0000)\d{4}(?:-\d{2}-\d{2}|\d{4})"
    r"(?:[T ]\d{2}(?:(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)|(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?))?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?\z"
)
_TO_EXTENDED = (
    (r"\A(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
    (r"\A(.{13})(\d{2})(\d{2})", "$1:$2:$3"),
    (r"\A(.{13})(\d{2})(?=\z|[Z+-])", "$1:$2"),
    (r"\A(.{19}),", "$1."),
    (r"\A(.{11}[^+-]*[+-]\d{2})\z", "$1:00"),
)


def _iso(stamp: Column) -> Column:
    # The guard matters: a bare cast also takes '2025', 'now' or 'epoch'.
    extended = stamp
    for pattern, replacement in _TO_EXTENDED:
        extended = F.regexp_replace(extended, pattern, replacement)
    return F.when(stamp.rlike(ISO_STAMP), stamp).when(stamp.rlike(BASIC_STAMP), extended)


def wall_clock(stamp: Column) -> Column:
    """Edge-local wall clock of an ISO stamp (the offset is dropped); null when malformed."""
    return _iso(stamp).try_cast("timestamp_ntz")


def instant(stamp: Column) -> Column:
    """The same stamp as a zone-safe instant; null when malformed."""
    return _iso(stamp).try_cast("timestamp")


def iso_text(ts: Column) -> Column:
    """ISO text of a wall-clock time; a fraction appears only when there is one."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def wall_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock, free of any session time zone."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def days(n: int) -> Column:
    """An interval of n days for wall-clock arithmetic."""
    return F.make_dt_interval(F.lit(n))
