"""Append and keyed replacement as whole-frame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, matched by column name; a column one side lacks is NULL there."""
    return target.unionByName(batch, allowMissingColumns=True)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop target rows whose keys the batch has, then append the whole batch.

    Repeats inside the batch all stay, and a NULL key replaces nothing.
    """
    # no distinct: an aggregate between shuffle and join would keep a hot key in one task
    return append(target.join(batch.select(*keys), list(keys), "left_anti"), batch)
