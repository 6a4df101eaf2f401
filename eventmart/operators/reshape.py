"""Wide slots to rows, and JSON text to columns and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot_slots(
    df: DataFrame,
    ids: Sequence[str],
    fields: Mapping[str, tuple[str | Sequence[str], str]],
    n: int,
    index_name: str = "slot",
    keep_if: str | None = None,
) -> DataFrame:
    """One row per filled slot of a repeated group stored side by side.

    ``fields`` maps an output name to ``(source, type)``: a prefix, read as ``<prefix>1`` to
    ``<prefix>n``, or the ``n`` column names themselves. A column the table lacks counts as
    NULL. Rows whose ``keep_if`` field is NULL are dropped, whatever the other fields hold.
    No shuffle: every input row yields at most ``n`` rows in place.
    """
    have = set(df.columns)

    def cell(source, kind, i):
        name = f"{source}{i}" if isinstance(source, str) else source[i - 1]
        return F.col(name).try_cast(kind) if name in have else F.lit(None).cast(kind)

    slots = [
        F.struct(
            F.lit(i).alias(index_name),
            *(cell(source, kind, i).alias(out) for out, (source, kind) in fields.items()),
        )
        for i in range(1, n + 1)
    ]
    rows = df.select(*ids, F.inline(F.array(*slots)))
    return rows.filter(F.col(keep_if).isNotNull()) if keep_if else rows


def expand_json(df: DataFrame, col: str, ddl: str, keep: bool = False) -> DataFrame:
    """Parse a JSON text column by ``ddl`` and put its fields behind the other columns.

    Malformed text, NULL and values of another type give NULL fields.
    """
    others = df.columns if keep else [c for c in df.columns if c != col]
    return df.withColumn("__parsed", F.from_json(F.col(col), ddl)).select(*others, "__parsed.*")


def stringify_nested(df: DataFrame) -> DataFrame:
    """Turn every struct, array and map column into JSON text; leave scalars as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *(
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        )
    )
