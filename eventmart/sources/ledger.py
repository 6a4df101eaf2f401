"""Which exports have been loaded: a table of (load, path), one folder for each load.

A load is planned before it starts and is done once its rows are written, which their
folder's ``_SUCCESS`` file says. A load that ended in between is done again with the same
id and the same files, so its rows replace themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import runtime

_SCHEMA = "path string, load string"


def planned(spark: SparkSession, ledger: str) -> DataFrame:
    """(path, load) of all loads, done or not."""
    if not runtime.exists(spark, ledger):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(ledger)


def plan(exports: DataFrame, ledger: str) -> None:
    """Plan one load of the ``exports`` (path) that no load has yet."""
    spark = exports.sparkSession
    new = exports.select("path").distinct().join(planned(spark, ledger), "path", "left_anti")
    load = uuid.uuid4().hex
    rows = new.persist()  # listed once: a file that arrives now waits for the next load
    try:
        if not rows.isEmpty():
            rows.write.parquet(f"{ledger}/load={load}")
    finally:
        rows.unpersist()


def waiting(spark: SparkSession, ledger: str, landed: str) -> dict[str, list[str]]:
    """Paths of each planned load whose rows are not all written under ``landed``.

    Names of files pass through the driver, as in any listing; their rows do not.
    """
    loads = planned(spark, ledger)
    names = [r["load"] for r in loads.select("load").distinct().collect()]
    todo = [n for n in names if not runtime.exists(spark, f"{landed}/load={n}/_SUCCESS")]
    rows = loads.filter(F.col("load").isin(todo)).orderBy("load", "path").collect() if todo else []
    out: dict[str, list[str]] = {}
    for row in rows:
        out.setdefault(row["load"], []).append(row["path"])
    return out
