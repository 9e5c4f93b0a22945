"""Lazy access to the star-schema test tables (one Parquet file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The test tables, in the order the data description lists them.
STAR_TABLES: tuple[str, ...] = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


class StarTables:
    """``tables.orders`` reads ``<sf_dir>/orders.parquet``. Nothing is scanned
    until an action runs, so column pruning and filters reach the Parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise KeyError(name)
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in STAR_TABLES:
            return self.table(name)
        raise AttributeError(name)
