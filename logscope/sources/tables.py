"""Readers for parquet tables (read-only inputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming the columns up front keeps the scan's ReadSchema minimal."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
