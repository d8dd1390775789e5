"""Plain-text log files: write a line column as text, scan a directory/glob back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_lines(df: DataFrame, path: str, line: str = "line") -> str:
    """One text file per partition (no repartition: the writer follows the data's splits)."""
    df.select(line).write.mode("overwrite").text(path)
    return path


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """A directory or a glob such as ``/logs/*.txt`` -> ``value STRING`` per line."""
    return spark.read.text(path)
