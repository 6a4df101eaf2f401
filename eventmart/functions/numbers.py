"""Sums that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(value: str | Column, scale: int = 2) -> Column:
    """Sum of values with ``scale`` decimals, added as decimals and given back as a double.

    A double sum changes in its last digits with the order in which partitions arrive.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(column.cast(f"decimal(18,{scale})")).cast("double")
