"""Text to boolean and text to number."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c: str | Column, truthy: str = "Yes") -> Column:
    """True only for the exact ``truthy`` text; NULL and everything else is false."""
    return F.coalesce(_col(c) == F.lit(truthy), F.lit(False))


def code(c: str | Column, codes: Mapping[str, int], otherwise: int | None = None) -> Column:
    """Number of a status text, e.g. ``{"Present": 1, "Unoccupied": 0}``."""
    out = F.lit(otherwise).cast("int")
    for text, number in codes.items():
        out = F.when(_col(c) == F.lit(text), F.lit(number)).otherwise(out)
    return out
