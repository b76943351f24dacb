"""Readers for the driver's Parquet tables (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return path if os.path.exists(path) or "://" in sf_dir else os.path.join(sf_dir, name)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._readers: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            # one reader per table and query build: the files are listed once
            if name not in self._readers:
                self._readers[name] = load(self.spark, self.sf_dir, name)
            return self._readers[name]
        raise AttributeError(name)
