"""Batch sinks. The table format is a parameter; parquet needs no extra jar."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.operators.merge import replace_by_key
from eventmart.operators.schema import align


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def overwrite_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    replace_schema: bool = True,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a table's rows and, unless told otherwise, its schema."""
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(table):
        df = align(df, spark.table(table).schema, extra="error")
    writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(table)


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append rows; columns the table lacks are added to it, old rows reading NULL there."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        add_columns(df, table)
        df = align(df, spark.table(table).schema)
        # by position, which holds for partitioned tables too
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.format(fmt).saveAsTable(table)


def _folder(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}")
    return described.filter("col_name = 'Location'").select("data_type").first()[0]


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def recover_table(spark: SparkSession, table: str) -> None:
    """Finish a replacement that ended between dropping the old table and naming the new."""
    aside = f"{table}__next"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(aside):
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")


def swap_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace a table by a frame that may read it; its partitioning stays.

    The old rows stay readable until all new ones are written. A table without partitions gets
    a new folder, to which the table then points; the old folder is deleted last. In a
    partitioned one the new files replace those of the same partitions when the write is
    committed, and partitions without new rows are dropped after. New columns are added to
    the table first. Where columns vanish or change type, the rows are written to a table
    aside that takes the name; ``recover_table`` finishes that if the job ends in between.
    """
    spark = df.sparkSession
    recover_table(spark, table)
    have = {f.name: f.dataType for f in spark.table(table).schema}
    if any(n not in df.columns or df.schema[n].dataType != t for n, t in have.items()):
        _rename_over(df, table, fmt)
        return
    add_columns(df, table)
    parts = _partitions(spark, table)
    if parts:
        rows = df.select(*spark.table(table).columns)
        _replace_partitions(rows, table, parts, _values(spark.table(table), parts))
        return
    old = _folder(spark, table)
    new = f"{old.rstrip('/').split('__v')[0]}__v{uuid.uuid4().hex}"
    try:
        df.select(*spark.table(table).columns).write.format(fmt).save(new)
    except BaseException:
        runtime.delete(spark, new)
        raise
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    runtime.delete(spark, old)


def add_columns(df: DataFrame, table: str) -> None:
    """Add the columns of ``df`` that the table lacks; old rows read NULL there."""
    spark = df.sparkSession
    have = spark.table(table).columns
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def _rename_over(df: DataFrame, table: str, fmt: str) -> None:
    spark = df.sparkSession
    aside = f"{table}__next"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    df.write.format(fmt).partitionBy(*_partitions(spark, table)).saveAsTable(aside)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    if spark.catalog.listColumns(table) and _partitions(spark, table):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _values(df: DataFrame, parts: Sequence[str]) -> set[tuple]:
    """The partitions that hold rows of ``df``."""
    return {tuple(r) for r in df.select(*parts).distinct().collect()}


def _replace_partitions(
    rows: DataFrame, table: str, parts: Sequence[str], touched: set[tuple]
) -> None:
    """Write ``rows`` over their partitions; those of ``touched`` without rows are dropped."""
    spark = rows.sparkSession
    filled = _values(rows, parts)
    with runtime.settings(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.write.insertInto(table, overwrite=True)
    for gone in touched - filled:
        spec = ", ".join(
            f"`{p}` = {'null' if v is None else repr(str(v))}"
            for p, v in zip(parts, gone, strict=True)
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def upsert_table(batch: DataFrame, table: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Keyed replacement into a table; the first run creates it.

    All rows are written once. Of a partitioned table only the partitions that hold a key of
    the batch, or receive one, are read and written.
    """
    spark = batch.sparkSession
    recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        batch.write.format(fmt).saveAsTable(table)
        return
    target, parts = spark.table(table), _partitions(spark, table)
    types = {f.name: f.dataType for f in batch.schema}
    if not parts or any(types.get(f.name, f.dataType) != f.dataType for f in target.schema):
        swap_table(replace_by_key(target, batch, keys), table, fmt)
        return
    held = target.join(batch.select(*keys), list(keys), "left_semi")
    touched = _values(held, parts) | _values(batch, parts)
    add_columns(batch, table)
    target = spark.table(table)
    rows = replace_by_key(target.filter(_in_partitions(parts, touched)), batch, keys)
    _replace_partitions(rows.select(*target.columns), table, parts, touched)


def replace_partitions(rows: DataFrame, table: str) -> None:
    """Write ``rows`` over the partitions they belong to; all others stay."""
    spark = rows.sparkSession
    add_columns(rows, table)
    rows = align(rows, spark.table(table).schema).select(*spark.table(table).columns)
    with runtime.settings(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.write.insertInto(table, overwrite=True)


def _in_partitions(parts: Sequence[str], values: set[tuple]) -> Column:
    """Rows of these partitions, as a filter that prunes the others from the scan."""
    out = F.lit(False)
    for spec in values:
        one = F.lit(True)
        for p, v in zip(parts, spec, strict=True):
            one = one & F.col(p).eqNullSafe(F.lit(v))
        out = out | one
    return out


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    max_connections: int = 1,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write to a database through at most ``max_connections`` connections.

    ``coalesce`` would also shrink the stages before the write to that many tasks, so the
    rows are repartitioned: the work upstream keeps its parallelism.
    """
    df.repartition(max_connections).write.jdbc(
        url=url, table=table, mode=mode, properties=dict(properties or {})
    )


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def dual_write(df: DataFrame, first, second) -> None:
    """Hand one frame to two sink functions without computing it twice.

    Kept on disk, not in memory; lost blocks are recomputed from the sources.
    """
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        first(kept)
        second(kept)
    finally:
        kept.unpersist()
