"""Streaming sources and sinks.

Every query has its own checkpoint, appends, and by default drains what is there and stops
(``availableNow``); a rerun with the same checkpoint reads only what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.cdc import envelope_schema
from eventmart.operators.schema import align
from eventmart.sources import sinks
from eventmart.sources.files import JSON_TIMES, rescued


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    archive_dir: str | None = None,
    multi_line: bool = False,
    glob: str | None = None,
    rescue: str | None = None,
    separator: str | None = None,
) -> DataFrame:
    """JSON files as they land. ``archive_dir`` moves consumed files away, one batch late;
    ``rescue`` names a column for the text of records that cannot be read. ``separator`` is
    what ends a record if it is no line, as from ``files.file_separator``."""
    reader = spark.readStream.schema(rescued(schema, rescue))
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", rescue)
    reader = reader.option("multiLine", multi_line).options(**JSON_TIMES)
    if separator:
        reader = reader.option("lineSep", separator)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


def read_envelopes(
    spark: SparkSession, path: str, image: T.StructType, streaming: bool = True, **options
) -> DataFrame:
    """Change events landed as JSON, one envelope per line."""
    schema = envelope_schema(image)
    if streaming:
        return read_json_stream(spark, path, schema, **options)
    return spark.read.schema(schema).options(**JSON_TIMES).json(path)


def read_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files as they land. ``path`` is a folder, a single file or a glob."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A plain path would become the base path, which must be a folder; a glob does not.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]" if path.endswith(".parquet") else path)


def read_table_stream(spark: SparkSession, table: str) -> DataFrame:
    return spark.readStream.table(table)


def _writer(df: DataFrame, checkpoint: str, available_now: bool, fmt: str, name: str | None):
    writer = df.writeStream.outputMode("append").format(fmt)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True) if available_now else writer


def append_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = True,
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table. An existing table's schema is followed: columns
    it lacks are added to it first.

    A parquet table takes one streaming query, whose batch numbers its log remembers; a
    second query under another checkpoint would have its first batches skipped. Use
    ``append_batches`` for tables of several queries.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        sinks.add_columns(df, table)
        df = align(df, spark.table(table).schema)
    return _writer(df, checkpoint, available_now, fmt, name).toTable(table)


def append_batches(
    df: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = True,
    fmt: str = "parquet",
    batch_column: str = "_batch",
) -> StreamingQuery:
    """Start appending a stream to a table that other streams append to as well.

    Each micro-batch is a partition of its own, named by the query and its number, so that a
    batch that is repeated replaces itself and queries with other checkpoints, or the same
    one begun anew, never meet. Columns that the table lacks are added to it.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], df.schema).withColumn(batch_column, F.lit(""))
        empty.write.format(fmt).partitionBy(batch_column).mode("ignore").saveAsTable(table)

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # the id of the query lives in its checkpoint
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch.withColumn(batch_column, F.lit(f"{query}-{number}"))
        sinks.replace_partitions(rows, table)

    writer = df.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_to_path(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    return _writer(df, checkpoint, available_now, fmt, name).start(path)


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to finish and raise what it failed with."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
