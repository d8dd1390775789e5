"""Per-group statistics: modes and top-k values.

Both start from (group, value) counts — a partial aggregate, so hot groups
and hot values are combined map-side before any shuffle.

* Mode = ``min(struct(-count, value))`` per group: a plain aggregate with
  partial merge, ties resolved to the smallest value. No window, no collect.
* Top-k = ``row_number() <= k``; Spark plans a ``WindowGroupLimit`` that keeps
  only k rows per group on the map side before the shuffle, so a group with
  millions of distinct values still ships at most k rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def modes(df: DataFrame, group: str, columns: list[str], prefix: str = "mode_") -> DataFrame:
    """Most frequent value of each column per group (as STRING; NULL is no value), ties -> smallest."""
    stacked = df.select(group, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("kv")).select(group, "kv.column", "kv.value") \
        .where("value IS NOT NULL")
    counts = stacked.groupBy(group, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(group, "column").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("best"))
    return best.groupBy(group).agg(*[
        F.max(F.when(F.col("column") == c, F.col("best.value"))).alias(prefix + c)
        for c in columns])


def top_k_per_group(df: DataFrame, group: str, value: str, k: int,
                    count_name: str = "hits") -> DataFrame:
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias(count_name))
    w = Window.partitionBy(group).orderBy(F.col(count_name).desc(), F.col(value).asc_nulls_first())
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))
