"""Timestamps, durations and time of day.

All arithmetic is on whole microseconds, so results do not depend on how a double
happens to round. Keep the session time zone at UTC when columns are ``timestamp_ntz``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp'1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 as a long, for zoned and zoneless timestamps."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _col(ts))


def minutes_between(start: str | Column, end: str | Column, scale: int = 2) -> Column:
    return F.round(F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(6e7), scale)


def trunc_ts(unit: str, ts: str | Column, as_type: str = "timestamp_ntz") -> Column:
    """``date_trunc`` that gives back the asked-for timestamp type."""
    return F.date_trunc(unit, _col(ts)).cast(as_type)


def is_weekend(ts: str | Column) -> Column:
    """Saturday or Sunday (Spark counts Sunday as 1, Saturday as 7)."""
    return F.dayofweek(_col(ts)).isin(1, 7)


def bucket(value: str | Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper edge that ``value`` lies below; NULL takes ``otherwise``."""
    out = F.lit(otherwise)
    for edge, label in reversed(list(edges)):
        out = F.when(_col(value) < F.lit(edge), F.lit(label)).otherwise(out)
    return out


def clock_minutes(text: str | Column) -> Column:
    """Minutes after midnight of a clock text such as ``7:30``, ``07:30:00`` or an ISO
    date-time; NULL when no clock time can be read."""
    hour = F.regexp_extract(_col(text), r"(\d{1,2}):\d{2}", 1).try_cast("int")
    minute = F.regexp_extract(_col(text), r"\d{1,2}:(\d{2})", 1).try_cast("int")
    return hour * 60 + minute


def minute_of_day(ts: str | Column) -> Column:
    return F.hour(_col(ts)) * 60 + F.minute(_col(ts))
