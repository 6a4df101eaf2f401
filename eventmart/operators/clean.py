"""Typing, required keys and load stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, mapping: Mapping[str, str | tuple[str, str] | Column]) -> DataFrame:
    """Select, rename and leniently cast.

    ``mapping`` maps an output name to a source name, to ``(source name, type)`` or to a
    ready expression. Text that does not fit the type becomes NULL instead of an error.
    """
    cols = []
    for out, spec in mapping.items():
        if isinstance(spec, tuple):
            source, kind = spec
            cols.append(F.col(source).try_cast(kind).alias(out))
        else:
            cols.append((F.col(spec) if isinstance(spec, str) else spec).alias(out))
    return df.select(*cols)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows with a value in every one of ``cols``. Use it after the cast."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def stamp(df: DataFrame, name: str = "ingested_at", ts: datetime | None = None) -> DataFrame:
    """Add a load time: one value per query, or the given one."""
    return df.withColumn(name, F.current_timestamp() if ts is None else F.lit(ts))
