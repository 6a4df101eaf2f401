"""Exact-row distinct and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop exact repeats, judged on ``cols`` or on the whole row.

    Stamp afterwards: a load time in the row would make every repeat look new.
    """
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by ``tie_break``, NULLs last.

    Planned as a group limit on both sides of the exchange, so each map task sends at most
    one row per key and a key holding most of the table costs no more than any other.
    NULL keys form one group.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("__place", place).filter(F.col("__place") == 1).drop("__place")
