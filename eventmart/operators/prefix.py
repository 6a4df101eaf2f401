"""Running totals over a whole table without a task that sees all of it.

A window without keys moves every row into one task. Here rows are numbered coarsely (days),
windows run inside a number only, and what lies before a number is put together from blocks
whose length is a power of two: each number adds to one block of every length, and the
numbers before n are one block for each bit of n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers from -LOWEST on; days from far before the common era to the year 9999.
LOWEST, LEVELS = 1 << 22, 23


def day_number(df: DataFrame, column: str) -> Column | None:
    """Coarse number of a time (its day) or whole number; None for other types. NULL comes
    first."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        number = F.shiftright(F.col(column).cast("long"), 42)
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        number = F.datediff(F.col(column).cast("date"), F.lit("1970-01-01").cast("date"))
    else:
        return None
    return F.coalesce(number.cast("long"), F.lit(-LOWEST))


def before_each(
    groups: DataFrame, number: str, value: str, combine: Callable[[str], Column]
) -> DataFrame:
    """(``number``, ``before``): ``combine`` of ``value`` over all rows with smaller numbers.

    ``groups`` has one row for each number; a number without smaller ones is left out.
    ``combine`` is an aggregate whose results combine again, like a sum or a maximum.
    """
    place = F.col(number) + LOWEST
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("__level")
    leveled = groups.select(number, value, place.alias("__place"), level)
    block = F.expr("shiftright(__place, __level)")
    blocks = (
        leveled.groupBy("__level", block.alias("__block")).agg(combine(value).alias("__value"))
    )
    wanted = leveled.filter(block.bitwiseAND(F.lit(1)) == 1).select(
        number, "__level", (block - 1).alias("__block")
    )
    return (
        wanted.join(blocks, ["__level", "__block"])
        .groupBy(number)
        .agg(combine("__value").alias("before"))
    )
