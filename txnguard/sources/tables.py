"""Reading the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazily read one table; column pruning and filters reach the scan through Catalyst."""
    return spark.read.parquet(table_path(sf_dir, name))
