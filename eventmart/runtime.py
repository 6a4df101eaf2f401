"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned for. AQE re-plans joins from measured sizes,
# splits skewed join partitions and coalesces small ones, so the shuffle partition
# count may be set generously on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "eventmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder path for intermediate tables and streaming checkpoints.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a local
    session may do without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/eventmart/{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
    return f"{tempfile.mkdtemp(prefix='eventmart-')}/{label}"


_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh workspace folder and read back, which cuts its lineage."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[back] = path
    return back


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens if it is not there."""
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file or folder into ``folder``, over one of the same name."""
    fs, place = _file_system(spark, path)
    _, into = _file_system(spark, folder)
    fs.mkdirs(into)
    target = spark._jvm.org.apache.hadoop.fs.Path(into, place.getName())
    fs.delete(target, True)
    if not fs.rename(place, target):
        raise OSError(f"{path} was not moved to {folder}")


def released(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``written`` returned and nothing reads any more.

    Call it when all that was derived from them has itself been written.
    """
    for df in frames:
        path = _FOLDERS.pop(df, None)
        if path is not None:
            delete(df.sparkSession, path)


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set SQL options, given by their full names, for a block; then put the old values back."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
