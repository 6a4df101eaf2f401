"""Landing files to bronze, and bronze to silver, as two chained streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.cdc import flatten
from eventmart.operators.clean import stamp
from eventmart.operators.reshape import expand_json
from eventmart.streaming.io import append_to_table, read_envelopes

#: Bronze column with the text of an unreadable line; NULL for all others.
RESCUE = "_corrupt_record"


def bronze_stream(
    spark: SparkSession,
    source: str,
    image: T.StructType,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    sink: Callable[..., StreamingQuery] = append_to_table,
    **options,
) -> StreamingQuery:
    """Change events as landed, plus ``ingested_at`` and, in ``RESCUE``, the text of lines
    that cannot be read. ``target`` is a table name, or a path
    with ``sink=append_to_path``."""
    events = stamp(read_envelopes(spark, source, image, rescue=RESCUE, **options))
    return sink(events, target, checkpoint, available_now)


def silver_rows(
    bronze: DataFrame,
    mapping: Mapping[str, str | tuple[str, str]],
    json_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Flat typed rows of the new images, JSON columns parsed into fields."""
    rows = flatten(bronze, mapping)
    for column, ddl in (json_columns or {}).items():
        rows = expand_json(rows, column, ddl)
    return rows


def silver_stream(
    bronze: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    available_now: bool = True,
    sink: Callable[..., StreamingQuery] = append_to_table,
) -> StreamingQuery:
    """A bronze stream (``io.read_table_stream`` or ``read_parquet_stream``), transformed
    and appended."""
    return sink(transform(bronze), target, checkpoint, available_now)
