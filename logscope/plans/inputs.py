"""Shared query inputs: lazy DataFrames over the given tables, defined anew for each query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.operators import parsing
from logscope.sources import fixture


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.read_access_log(spark, sf_dir)


def fields(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The lines that have all the named fields; only these are parsed."""
    return parsing.report_rows(lines(spark, sf_dir), *names)


def hourly(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """As ``fields``, with the hour, of lines with enough tokens."""
    return parsing.hourly_rows(lines(spark, sf_dir), *names)


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the log table."""
    return parsing.access_table(lines(spark, sf_dir))


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.strict_parse(lines(spark, sf_dir))


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.read_geo_ranges(spark, sf_dir)
