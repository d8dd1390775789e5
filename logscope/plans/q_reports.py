"""Batch traffic reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from logscope.operators import distinct, reports, sinks
from logscope.plans.inputs import fields, hourly
from logscope.plans.oracle_sql import having
from logscope.plans.oracle_sql import hourly as hourly_sql
from logscope.plans.registry import register
from logscope.session import scratch_dir


def _ranked_sql(key: str) -> str:
    return f"SELECT {key}, count(*) AS hits FROM {having(key)} GROUP BY {key} ORDER BY hits DESC, {key}"


@register("top_urls", _ranked_sql("request_url"))
def top_urls(spark, sf):
    """Page views per URL, ranked (the reference's "PageRank" report)."""
    return reports.ranked(fields(spark, sf, "request_url"), "request_url")


@register("hits_by_ip", _ranked_sql("remote_addr"))
def hits_by_ip(spark, sf):
    """Hits per client IP, ranked."""
    return reports.ranked(fields(spark, sf, "remote_addr"), "remote_addr")


@register("top_user_agents", _ranked_sql("http_user_agent"))
def top_user_agents(spark, sf):
    """Hits per user agent, ranked."""
    return reports.ranked(fields(spark, sf, "http_user_agent"), "http_user_agent")


@register("top_referers", _ranked_sql("http_referer"))
def top_referers(spark, sf):
    """Hits per referer, ranked."""
    return reports.ranked(fields(spark, sf, "http_referer"), "http_referer")


@register("hits_by_http_version", _ranked_sql("http_version"))
def hits_by_http_version(spark, sf):
    """Hits per HTTP version, ranked."""
    return reports.ranked(fields(spark, sf, "http_version"), "http_version")


@register("hits_by_method", _ranked_sql("request_method"))
def hits_by_method(spark, sf):
    """Hits per request method, ranked."""
    return reports.ranked(fields(spark, sf, "request_method"), "request_method")


@register("hits_by_status", _ranked_sql("status"))
def hits_by_status(spark, sf):
    """Hits per status code, ranked."""
    return reports.ranked(fields(spark, sf, "status"), "status")


@register("hits_by_ip_method", f"""
SELECT remote_addr, request_method, count(*) AS hits FROM {having("remote_addr", "request_method")}
GROUP BY remote_addr, request_method ORDER BY hits DESC, remote_addr, request_method""")
def hits_by_ip_method(spark, sf):
    """Hits per (IP, method), ranked."""
    return reports.ranked(fields(spark, sf, "remote_addr", "request_method"), "remote_addr", "request_method")


@register("method_grouping_sets", f"""
SELECT remote_addr, request_method, count(*) AS hits,
       CAST(grouping(remote_addr, request_method) AS INTEGER) AS grouping_level
FROM {having("remote_addr", "request_method")} GROUP BY GROUPING SETS ((request_method), (remote_addr, request_method))""")
def method_grouping_sets(spark, sf):
    """Per-method and per-(IP, method) hits in one pass."""
    return reports.method_grouping_sets(fields(spark, sf, "remote_addr", "request_method")).withColumn(
        "grouping_level", F.col("grouping_level").cast("int"))


@register("unique_ips_by_hour", f"""
SELECT hour, count(DISTINCT remote_addr) AS unique_ips FROM {having("remote_addr", "hour")} GROUP BY hour""")
def unique_ips_by_hour(spark, sf):
    """Distinct client IPs per hour of day."""
    return reports.unique_ips_by_hour(fields(spark, sf, "remote_addr", "hour"))


@register("unique_ips_by_hour_approx", f"""
SELECT hour, count(DISTINCT remote_addr) AS estimate, count(DISTINCT remote_addr) AS unique_ips
FROM {having("day", "remote_addr", "hour")} GROUP BY hour""")
def unique_ips_by_hour_approx(spark, sf):
    """Distinct client IPs per hour of day: the estimate of stored sketches, two deliveries united, next to the exact count.

    With a few hundred clients an hour, as the oracle has them, a sketch still holds them all and its estimate is exact.
    """
    return _sketched(spark, sf, "hour").join(
        reports.unique_ips_by_hour(fields(spark, sf, "day", "remote_addr", "hour")), "hour").select("hour", "estimate", "unique_ips")


@register("unique_ips_by_day_sketch", f"""
SELECT day, count(DISTINCT remote_addr) AS estimate FROM {having("day", "remote_addr", "hour")} GROUP BY day""")
def unique_ips_by_day_sketch(spark, sf):
    """Distinct client IPs per day, rolled up from the stored sketches of its hours."""
    return _sketched(spark, sf, "day")


def _sketched(spark, sf, *by: str):
    """Sketches per (day, hour), appended by two deliveries, one of them twice, then united by ``by``."""
    root = scratch_dir(spark, "sketches")
    rows = fields(spark, sf, "day", "remote_addr", "hour")
    for bid, part in ((1, "day <= 20"), (2, "day > 10"), (2, "day > 10")):          # some days are in both
        sinks.append_batch(distinct.sketches(rows.where(part), "day", "hour"), root, bid)
    return distinct.estimate_sketches(sinks.read_appended(spark, root), *by)


@register("unique_ips_by_hour_bitmap", f"""
SELECT hour, count(DISTINCT remote_addr) AS unique_ips FROM {having("day", "remote_addr", "hour")} GROUP BY hour""")
def unique_ips_by_hour_bitmap(spark, sf):
    """Distinct client IPs per hour of day, exact, from stored bitmaps that two overlapping deliveries share."""
    root = scratch_dir(spark, "bitmaps")
    rows = fields(spark, sf, "day", "remote_addr", "hour")
    for bid, part in ((1, "day <= 20"), (2, "day > 10")):
        sinks.append_batch(distinct.bitmaps(rows.where(part), "hour"), root, bid)
    return distinct.count_bitmaps(sinks.read_appended(spark, root), "hour")


@register("hits_by_hour", f"SELECT hour, count(*) AS hits FROM {hourly_sql()} GROUP BY hour")
def hits_by_hour(spark, sf):
    """Hits per hour of day."""
    return reports.hits_by_hour(hourly(spark, sf))


@register("ip_last_seen", f"""
SELECT remote_addr, max(epoch_ms) AS last_seen_ms, count(*) AS hits FROM {having("remote_addr", "epoch_ms")} GROUP BY remote_addr""")
def ip_last_seen(spark, sf):
    """Latest request time and hits per IP."""
    return reports.ip_last_seen(fields(spark, sf, "remote_addr", "epoch_ms"))


@register("top10_ips", f"""
SELECT remote_addr, count(*) AS hits FROM {having("remote_addr")} GROUP BY remote_addr
ORDER BY hits DESC, remote_addr LIMIT 10""")
def top10_ips(spark, sf):
    """Top-10 preview of the per-IP ranking."""
    return reports.top_n(fields(spark, sf, "remote_addr"), 10, "remote_addr")
