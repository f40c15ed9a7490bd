"""Datetime parsing and arithmetic. The session time zone must be UTC (see
``taxiframe.session``): trip times are wall-clock text read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxiframe.schemas import DATETIME_TEXT_FORMAT

# Accepts one-digit month/day/hour/minute/second like ``%Y-%m-%d %H:%M:%S``;
# impossible dates (Feb 30) and fractions of a second give null.
PARSE_FORMAT = "yyyy-M-d H:m:s"

# A text in the form of DATETIME_TEXT_FORMAT. The cast takes the same times of this
# form as the format does, at a third of the time.
CANONICAL_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_datetime(col: Column | str) -> Column:
    """Text -> TIMESTAMP, null when the text does not match the format."""
    c = _c(col)
    return (F.when(c.rlike(CANONICAL_TEXT), c.try_cast("timestamp"))
            .otherwise(F.try_to_timestamp(c, F.lit(PARSE_FORMAT))))


def datetime_text(col: Column | str) -> Column:
    """TIMESTAMP -> canonical ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_c(col), DATETIME_TEXT_FORMAT)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (trip times have no fraction)."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed whole minutes, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def day_of(col: Column | str) -> Column:
    """Partition day of a timestamp."""
    return F.to_date(_c(col))


def midnight_of(ts: str | Column) -> Column:
    """Midnight (UTC) of the day of ``ts``; a literal text or a column."""
    c = F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts
    return F.date_trunc("DAY", c)


def to_ntz(col: Column | str) -> Column:
    """Instant -> wall-clock TIMESTAMP_NTZ (UTC session), for engine-neutral output."""
    return _c(col).cast("timestamp_ntz")
