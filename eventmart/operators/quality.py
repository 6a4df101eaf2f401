"""Data checks: failing rows of one check, or all checks as one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of every duplicated key (empty when there is none).

    A semi-join against the counted keys, not a window count: the count is pre-aggregated
    and the join can be split, so no task holds all rows of a key.
    """
    repeated = duplicate_keys(df, keys).select(
        *(F.col(k).alias(f"__d{i}") for i, k in enumerate(keys))
    )
    match = [F.col(k).eqNullSafe(F.col(f"__d{i}")) for i, k in enumerate(keys)]
    return df.join(repeated, match, "left_semi")


def profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows and distinct keys."""
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_ids")
    )


def unique(df: DataFrame, col: str) -> DataFrame:
    """Repeated values of ``col``; NULLs do not count."""
    return duplicate_keys(df.filter(F.col(col).isNotNull()), [col])


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def expression(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows for which the predicate is false; unknown passes."""
    return df.filter(~(F.expr(predicate) if isinstance(predicate, str) else predicate))


def max_value(df: DataFrame, col: str, limit: float) -> DataFrame:
    return df.filter(F.col(col) > F.lit(limit))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference has no parent; NULL references pass."""
    # no distinct: an aggregate between shuffle and join would keep a hot key in one task
    known = parent.select(F.col(pk).alias("__pk")).filter(F.col("__pk").isNotNull())
    present = child.filter(F.col(fk).isNotNull())
    return present.join(known, F.col(fk) == F.col("__pk"), "left_anti")


def report(
    df: DataFrame,
    unique_cols: Sequence[str] = (),
    not_null_cols: Sequence[str] = (),
    expressions: Mapping[str, str | Column] | None = None,
    max_values: Mapping[str, float] | None = None,
    references: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """One row per check: check, failing_rows, status.

    Checks that look at one row at a time share a single pass; uniqueness and references
    need a shuffle each.
    """
    failing: dict[str, Column] = {}
    for c in not_null_cols:
        failing[f"not_null_{c}"] = F.col(c).isNull()
    for name, predicate in (expressions or {}).items():
        failing[name] = ~(F.expr(predicate) if isinstance(predicate, str) else predicate)
    for c, limit in (max_values or {}).items():
        failing[f"max_value_{c}"] = F.col(c) > F.lit(limit)

    parts = []
    if failing:
        names = list(failing)
        counts = df.agg(*(F.count_if(failing[n]).alias(f"c{i}") for i, n in enumerate(names)))
        cells = [
            F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("failing_rows"))
            for i, n in enumerate(names)
        ]
        parts.append(counts.select(F.inline(F.array(*cells))))
    found = [(f"unique_{c}", unique(df, c)) for c in unique_cols]
    found += [(f"relationships_{fk}", relationships(df, fk, p, pk)) for fk, p, pk in references]
    for name, rows in found:
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("failing_rows")).select(
                F.lit(name).alias("check"), "failing_rows"
            )
        )
    if not parts:
        raise ValueError("no checks given")
    status = F.when(F.col("failing_rows") == 0, "pass").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)
