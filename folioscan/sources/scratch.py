"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of written tables.
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir; only a local session may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = f"file://{tempfile.gettempdir()}/folioscan"
    path = f"{base.rstrip('/')}/folioscan-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before
        pass


def written(df: DataFrame) -> DataFrame:
    """df, written once and read from there: what follows doesn't compute it again, nor does the loss of an executor.

    The shuffle files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    path = folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that written returned; nothing may read them any more."""
    for df in tables:
        path = _written.pop(df, None)
        if path:
            _delete(df.sparkSession, path)
