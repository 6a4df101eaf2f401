"""File and table scans. Schemas are explicit; inference is a separate one-off step."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.schema import merged

# Text forms that keep microseconds in JSON, for zoned and zoneless times.
# Without them the JSON writer cuts timestamps to milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Bytes of a file that still fit into one record; a JVM array ends at 2^31.
ONE_RECORD = 2_000_000_000


def snapshot_glob(prefix: str) -> str:
    """Files named ``<prefix>_<yyyymmdd_HHMMSS>.json``, but not those of longer prefixes."""
    return f"{prefix}_[0-9]*.json"


def exports(spark: SparkSession, directory: str, prefix: str) -> DataFrame:
    """(path) of every export. Lists the folder; no file content is read.

    An export is a file, or a folder of part files as Spark writes it.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    export = F.regexp_extract("path", f"^(.*/{re.escape(prefix)}_[0-9][^/]*[.]json)(/[^/]+)?$", 1)
    return listing.select(export.alias("path")).filter("path != ''").distinct()


def latest_snapshot(spark: SparkSession, directory: str, prefix: str) -> str | None:
    """Path of the last export by name; None if there is none."""
    return exports(spark, directory, prefix).agg(F.max("path").alias("path")).first()["path"]


def with_unknown(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True
) -> T.StructType:
    """``schema`` and, as text, the columns of the JSON files it does not declare.

    Costs one more read of the files. Text is the one type that fits whatever a later file
    holds; a nested value arrives as its JSON text.
    """
    readable = spark.read.option("multiLine", multi_line).option("mode", "DROPMALFORMED")
    found = readable.json(path).columns
    return merged(schema, T.StructType([T.StructField(n, T.StringType()) for n in found]))


def file_separator(spark: SparkSession, path: str | list[str]) -> str | None:
    """A ``lineSep`` that no file of ``path`` holds, so that each file is one record.

    Multi-line mode cuts the text of a value that is no string, in a column declared as text,
    from the file anew: one more read for each value, of some 8 KB at least. A record in
    memory gives the same text without that. JSON cannot hold the separator: a plain NUL
    would have to be escaped. None if files are compressed, too large for a record, or not
    UTF-8; these need multi-line mode. Costs one more read of the files, without parsing.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    large = F.col("length") > ONE_RECORD
    packed = F.col("path").rlike(r"[.](gz|deflate|bz2|snappy|lz4|zst|passthrough)$")
    # first bytes by which the parser takes a file for UTF-16 or UTF-32
    wide = F.hex(F.substring("content", 1, 4)).rlike("^(FEFF|FFFE|(..){0,3}00)")
    for odd in (large | packed, wide):  # the first needs no content
        if listing.agg(F.bool_or(odd)).first()[0]:
            return None
    return f"\0{uuid.uuid4().hex}\0"


def read_json_snapshots(
    spark: SparkSession,
    directory: str,
    prefix: str,
    schema: T.StructType,
    mode: str = "history",
    multi_line: bool = True,
    unknown: bool = False,
    rescue: str | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """JSON files of one export.

    ``mode="history"`` reads every file of the prefix (event exports, to be appended);
    ``"snapshot"`` reads the last one only (reference exports, to replace the table);
    ``paths`` names the exports to read instead.
    ``multi_line`` files hold one array each and are read by one task each; prefer JSON
    lines (``multi_line=False``), which are split, for large exports. ``unknown`` keeps columns
    that ``schema`` lacks, as text. ``rescue`` names a column for the text of records that
    cannot be read, which would otherwise become rows of NULLs.
    """
    if mode not in ("history", "snapshot"):
        raise ValueError("mode must be 'history' or 'snapshot'")
    path = paths
    if path is None:
        last = latest_snapshot(spark, directory, prefix)
        if last is None:
            return spark.createDataFrame([], rescued(schema, rescue))
        path = last if mode == "snapshot" else f"{directory}/{snapshot_glob(prefix)}"
    if unknown:
        schema = with_unknown(spark, path, schema, multi_line)
    reader = spark.read.schema(rescued(schema, rescue)).options(**JSON_TIMES)
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", rescue)
    separator = file_separator(spark, path) if multi_line else None
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.option("multiLine", multi_line and separator is None).json(path)


def rescued(schema: T.StructType, rescue: str | None) -> T.StructType:
    """``schema`` with a text column for unreadable records, if it is named."""
    return T.StructType([*schema.fields, T.StructField(rescue, T.StringType())]) if rescue else schema


def infer_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """Schema of existing JSON files, to be written down and passed to the readers."""
    return spark.read.option("multiLine", multi_line).json(path).schema


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("mergeSchema", merge_schema).parquet(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)
