"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL mark of the widely used dbt surrogate key.
SEPARATOR = "-"
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the text forms of ``cols``; NULL has its own mark, so it never meets ''.

    The digest depends on the text form: cast keys to one type on both sides first.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))
        for c in cols
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
