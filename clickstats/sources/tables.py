"""The driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` as a DataFrame, with one plan whatever its size.

    Column pruning and filter pushdown reach the scan; its splits follow the
    files' row groups and ``spark.sql.files.maxPartitionBytes``.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
