"""Per-IP activity: trailing 1-day / 3-day hit counts, hourly activity snapshots.

Trailing counts are anchored at each IP's latest request (``last_seen``), as
the reference's report is: hits with ``ts >= last_seen - span``. One IP may
hold a third of all rows, so nothing here is keyed by the IP alone over raw
rows (no ``Window.partitionBy(ip)``, no row-level join on ip):

1. rows are compacted to (ip, bucket, ts) counts, combined in each task before
   the shuffle, and written once to the shared folder; the hourly table
   (ip, bucket) comes from it;
2. ``last_seen`` per IP is a partial aggregate; per (ip, span) it gives the
   boundary ``lo = last_seen - span`` and its bucket ``b``;
3. whole buckets after ``b`` come from the hourly table joined on ip — its rows
   per IP are bounded by the hours spanned, not by the traffic;
4. the boundary bucket itself is counted exactly (to the millisecond) with an
   equi-join on ``(ip, bucket)``, which keeps the hot IP spread over buckets.

The hourly snapshot works on the same (ip, hour) table, so a range window
over it is safe as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.functions.plan import written

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
TRAILING_SPANS = {"hits_1d": DAY_MS, "hits_3d": 3 * DAY_MS}


def trailing_activity(access: DataFrame, spans: dict[str, int] | None = None,
                      ip: str = "remote_addr", ts: str = "epoch_ms",
                      bucket_ms: int = HOUR_MS) -> DataFrame:
    """Per IP: last_seen_ms and, per span, hits with ``ts >= last_seen_ms - span``."""
    spans = spans or TRAILING_SPANS
    rows = access.select(ip, ts, F.floor(F.col(ts) / bucket_ms).cast("bigint").alias("_b"))
    # Written once: the four branches below would otherwise each re-derive it
    # from the raw input (the optimizer rewrites each branch differently, so
    # Spark cannot reuse one exchange for all of them).
    compact = written(rows.groupBy(ip, "_b", ts).agg(F.count(F.lit(1)).alias("_n")), "activity")
    hourly = compact.groupBy(ip, "_b").agg(F.sum("_n").alias("_nb"))
    last = compact.groupBy(ip).agg(F.max(ts).alias("last_seen_ms"))
    per_span = F.explode(F.array(*[
        F.struct(F.lit(name).alias("span"), F.lit(ms).cast("bigint").alias("ms"))
        for name, ms in spans.items()]))
    bounds = (last.select(ip, "last_seen_ms", per_span.alias("_s"))
              .select(ip, "last_seen_ms", F.col("_s.span").alias("_span"),
                      (F.col("last_seen_ms") - F.col("_s.ms")).alias("_lo"))
              .withColumn("_bb", F.floor(F.col("_lo") / bucket_ms).cast("bigint")))
    whole = (hourly.join(bounds.select(ip, "last_seen_ms", "_span", "_bb"), ip)
             .filter(F.col("_b") > F.col("_bb"))
             .groupBy(ip, "last_seen_ms", "_span").agg(F.sum("_nb").alias("_c")))
    edge = (compact.join(bounds.select(ip, "last_seen_ms", "_span", "_lo",
                                       F.col("_bb").alias("_b")), [ip, "_b"])
            .filter(F.col(ts) >= F.col("_lo"))
            .groupBy(ip, "last_seen_ms", "_span").agg(F.sum("_n").alias("_c")))
    both = whole.unionByName(edge)
    return both.groupBy(ip, "last_seen_ms").agg(*[
        F.coalesce(F.sum(F.when(F.col("_span") == name, F.col("_c"))), F.lit(0)).cast("bigint")
        .alias(name) for name in spans])


def hourly_activity(access: DataFrame, ip: str = "remote_addr", ts: str = "epoch_ms") -> DataFrame:
    """Per (ip, hour bucket): hits in the hour and in the trailing 24 / 72 hourly buckets."""
    bucket = (F.floor(F.col(ts) / HOUR_MS) * HOUR_MS).cast("bigint")
    hourly = access.groupBy(F.col(ip), bucket.alias("bucket_ms")).agg(
        F.count(F.lit(1)).alias("hits"))
    return trailing_over_hours(hourly, ip)


def trailing_over_hours(hourly: DataFrame, ip: str = "remote_addr") -> DataFrame:
    """(ip, bucket_ms, hits) -> + trailing 24 h / 72 h sums (range window over hourly rows)."""
    w = Window.partitionBy(ip).orderBy("bucket_ms")
    return hourly.select(
        ip, "bucket_ms", "hits",
        F.sum("hits").over(w.rangeBetween(-(DAY_MS - HOUR_MS), 0)).alias("hits_1d"),
        F.sum("hits").over(w.rangeBetween(-(3 * DAY_MS - HOUR_MS), 0)).alias("hits_3d"))
