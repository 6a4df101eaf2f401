"""Column-to-column expressions."""

from eventmart.functions.flags import code, flag
from eventmart.functions.keys import surrogate_key
from eventmart.functions.numbers import exact_sum
from eventmart.functions.time import (
    bucket,
    clock_minutes,
    epoch_micros,
    is_weekend,
    minute_of_day,
    minutes_between,
    trunc_ts,
)

__all__ = [
    "bucket",
    "clock_minutes",
    "code",
    "epoch_micros",
    "exact_sum",
    "flag",
    "is_weekend",
    "minute_of_day",
    "minutes_between",
    "surrogate_key",
    "trunc_ts",
]
