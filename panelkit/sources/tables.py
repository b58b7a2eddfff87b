"""Parquet table scans (S3).

Callers select the columns they need and filter on raw columns right after
the scan, so parquet gets a pruned ``ReadSchema`` and ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
