"""Change-data-capture envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope_schema(image: T.StructType) -> T.StructType:
    """Schema of one change event around a row image."""
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def decode(df: DataFrame, image: T.StructType, value: str | Column = "value") -> DataFrame:
    """Envelopes from a text or binary message column, as a message bus delivers them."""
    payload = (F.col(value) if isinstance(value, str) else value).cast("string")
    return df.select(F.from_json(payload, envelope_schema(image)).alias("__e")).select("__e.*")


def flatten(
    df: DataFrame,
    mapping: Mapping[str, str | tuple[str, str]],
    image: str = "after",
    keep_ops: Sequence[str] | None = None,
    keep_null_images: bool = False,
) -> DataFrame:
    """Columns of the new row image, renamed and leniently typed.

    ``mapping`` maps an output name to an image field or to ``(field, type)``. A delete has
    no new image and is dropped unless ``keep_null_images``. Works on batches and streams.
    """
    if keep_ops is not None:
        df = df.filter(F.col("op").isin(*keep_ops))
    if not keep_null_images:
        df = df.filter(F.col(image).isNotNull())
    cols = []
    for out, spec in mapping.items():
        field, kind = spec if isinstance(spec, tuple) else (spec, None)
        value = F.col(image).getField(field)
        cols.append((value.try_cast(kind) if kind else value).alias(out))
    return df.select(*cols)
