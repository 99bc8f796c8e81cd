"""Sinks: ledgers, packet exports and snapshot copies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ledger(rows: DataFrame, dropped: DataFrame, path: str, order: str) -> None:
    """Write a ledger as JSON lines in order, unless rows were dropped or none are left."""
    if not dropped.isEmpty():
        raise ValueError("claims without a note or an id")
    if rows.isEmpty():
        raise ValueError("no claims survive")
    rows.repartitionByRange(max(1, rows.rdd.getNumPartitions()), order).sortWithinPartitions(order).write.mode("errorifexists").json(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Put a table in the place of another: written whole beside it, then renamed; the old one steps aside and comes back if that fails.

    Where renaming a folder isn't one step (object stores), a table format with
    its own commits is the way; readers may find no table between the renames.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(staged)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at, new = hadoop.Path(path), hadoop.Path(staged)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = hadoop.Path(f"{staged}.old")
    held = fs.exists(at)
    if held and not fs.rename(at, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, at):
        if held:
            fs.rename(aside, at)
        raise OSError(f"could not rename {staged}")
    if held:
        fs.delete(aside, True)


def new_snapshots(found: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to add, conflicts): stored bytes never change, equal ones aren't written again."""
    held = stored.select("bundle_key", "name", F.col("sha256").alias("_fs_sha"))
    j = found.join(held, ["bundle_key", "name"], "left")
    return j.where("_fs_sha IS NULL").drop("_fs_sha"), j.where("_fs_sha <> sha256").select("bundle_key", "name")


def claim_history(packets: DataFrame) -> DataFrame:
    """One row for each event of the packets' histories, with its position."""
    return packets.select("worker", F.posexplode("claim_history").alias("seq", "e")).select("worker", "seq", "e.*")
