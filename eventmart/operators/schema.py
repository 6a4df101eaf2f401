"""Column alignment for additive schema changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, target: T.StructType, extra: str = "keep") -> DataFrame:
    """Give ``df`` the columns of ``target`` in its order, NULL where ``df`` has none.

    Columns unknown to ``target`` follow behind (``extra="keep"``), are left out
    (``"drop"``) or raise (``"error"``).
    """
    known = {f.name for f in target.fields}
    new = [c for c in df.columns if c not in known]
    if new and extra == "error":
        raise ValueError(f"columns not in the target schema: {new}")
    have = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    return df.select(*cols, *(new if extra == "keep" else []))


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` followed by the fields only ``new`` has."""
    known = {f.name for f in old.fields}
    return T.StructType([*old.fields, *(f for f in new.fields if f.name not in known)])
