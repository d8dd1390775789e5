"""Traffic reports: keyed hit counts, rankings, distinct visitors.

Every count is a ``groupBy().agg(count)``: Spark plans a partial (map-side)
aggregate before the shuffle, so a hot key (one IP with a third of all rows,
the ``-`` referer) only ever ships one partial count per map task.
Rankings are ``count DESC, key ASC`` so ties are deterministic; a ranking with
a limit plans as ``TakeOrderedAndProject`` (no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HITS = "hits"


def hits_by(df: DataFrame, *keys: str, name: str = HITS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rank_order(keys, name: str = HITS):
    return [F.col(name).desc()] + [F.col(k).asc_nulls_first() for k in keys]


def ranked(df: DataFrame, *keys: str, name: str = HITS) -> DataFrame:
    """Full ranking (the report itself): a range-partitioned sort of the aggregate."""
    return hits_by(df, *keys, name=name).orderBy(*rank_order(keys, name))


def top_n(df: DataFrame, n: int, *keys: str, name: str = HITS) -> DataFrame:
    return hits_by(df, *keys, name=name).orderBy(*rank_order(keys, name)).limit(n)


def method_grouping_sets(access: DataFrame) -> DataFrame:
    """Hits per method and per (ip, method) in ONE scan + one shuffle (GROUPING SETS)."""
    return (access.groupingSets([["request_method"], ["remote_addr", "request_method"]],
                                "remote_addr", "request_method")
            .agg(F.count(F.lit(1)).alias(HITS), F.grouping_id().alias("grouping_level")))


def unique_ips_by_hour(access: DataFrame) -> DataFrame:
    """Distinct visitors per hour of day. Catalyst plans a two-level aggregate:
    (hour, ip) partial/merge, then hour — only distinct pairs are shuffled."""
    return access.groupBy("hour").agg(F.countDistinct("remote_addr").alias("unique_ips"))


def unique_ips_by_hour_approx(access: DataFrame, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ sketch per hour: constant memory per group, mergeable partials."""
    return access.groupBy("hour").agg(
        F.approx_count_distinct("remote_addr", rsd).alias("unique_ips"))


def hits_by_hour(access: DataFrame) -> DataFrame:
    return hits_by(access, "hour")


def ip_last_seen(access: DataFrame) -> DataFrame:
    """Per IP: latest request time and hit count — one aggregate, no join."""
    return access.groupBy("remote_addr").agg(
        F.max("epoch_ms").alias("last_seen_ms"), F.count(F.lit(1)).alias(HITS))
