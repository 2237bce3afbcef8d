"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``<base_dir>/<name>.parquet`` (a file or a folder of parts).

    Projections and filters applied later are pushed into the scan by
    Catalyst, so callers select columns instead of reading them all.
    """
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
