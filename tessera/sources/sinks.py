"""Sinks.  Writers are plain DataFrameWriter calls; they
are atomic per job on a committer-backed store and safe to re-run: tables and
reports are overwritten, a history run replaces the partition of its own stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned_table(df: DataFrame, path: str, key: str = "month") -> None:
    """K1 ``materialized='table', dist/sort=month``: co-locate and sort by the key,
    one folder per key value.  Rebalancing splits a key that holds most rows
    into several tasks and files."""
    (df.hint("rebalance", key).sortWithinPartitions(key)
     .write.mode("overwrite").partitionBy(key).parquet(path))


def stamp_run(df: DataFrame, run_ts: str, col: str = "run_ts_utc") -> DataFrame:
    """K5: the job's start time as a column (an argument, so re-runs are stable)."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp_ntz"))


def append_history(df: DataFrame, path: str, columns, stamp: str = "run_ts_utc") -> None:
    """K2 append comparison results to a history table in a fixed column order.

    The history is partitioned by the run stamp and only the partitions of this
    run are overwritten, so a retried or repeated append leaves the same rows.
    """
    columns = list(columns)
    (df.select(*[c for c in columns if c != stamp], F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_stamp"), F.col(stamp))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_stamp").parquet(path))


def read_history(spark: SparkSession, path: str, columns) -> DataFrame:
    """The history in its fixed column order."""
    return spark.read.parquet(path).select(*columns)


def export_csv(df: DataFrame, path: str, columns=None, mode: str = "overwrite") -> None:
    """K3/K4 report export of the chosen columns as CSV with a header per part
    file (append mode adds new part files, like appending rows to a report)."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).option("header", True).csv(path)
