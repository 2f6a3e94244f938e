"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``base/name.parquet``, through Spark's reader only, so any Hadoop path works."""
    return spark.read.parquet(f"{base}/{name}.parquet")
