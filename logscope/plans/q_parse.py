"""Parsing, projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import parsing
from logscope.plans.inputs import access, geo_ranges, lines
from logscope.plans.registry import register
from logscope.session import scratch_dir
from logscope.sources import text


@register("scan_lines", "SELECT line AS value FROM access_log")
def scan_lines(spark, sf):
    """Raw log files -> one row per line (text scan of a directory)."""
    path = scratch_dir(spark, "log-text")
    text.write_lines(lines(spark, sf), path)
    return text.scan_lines(spark, path)


@register("filter_min_length", "SELECT event_id, line FROM access_log WHERE length(line) > 10")
def filter_min_length(spark, sf):
    """Lines longer than 10 characters."""
    return parsing.filter_min_length(lines(spark, sf)).select("event_id", "line")


@register("filter_min_tokens",
          "SELECT event_id, line FROM access_log WHERE len(string_split(line, ' ')) > 10")
def filter_min_tokens(spark, sf):
    """Lines with more than 10 space-separated tokens."""
    return parsing.filter_min_tokens(lines(spark, sf)).select("event_id", "line")


_ACCESS_COLS = ", ".join(parsing.ACCESS_COLUMNS)


@register("parse_quote_split", f"SELECT event_id, {_ACCESS_COLS}, tz_offset FROM access")
def parse_quote_split(spark, sf):
    """Quote-split parse of every valid line into the ten access fields."""
    return access(spark, sf).select("event_id", *parsing.ACCESS_COLUMNS, "tz_offset")


@register("parse_request_fields", """
SELECT event_id, request_method, request_url, http_version, http_referer, http_user_agent FROM access""")
def parse_request_fields(spark, sf):
    """Request, referer and agent fields (column-pruned split parse)."""
    return access(spark, sf).select("event_id", "request_method", "request_url", "http_version",
                                    "http_referer", "http_user_agent")


@register("parse_space_split", """
SELECT event_id, string_split(line, ' ')[1] AS remote_addr, string_split(line, ' ')[4] AS time_token,
       string_split(line, ' ')[10] AS bytes_token
FROM access_log WHERE length(line) > 10""")
def parse_space_split(spark, sf):
    """Whole-line space split of length-filtered lines: tokens 0, 3 and 9."""
    df = parsing.space_split(parsing.filter_min_length(lines(spark, sf)))
    return df.select("event_id", "remote_addr", "time_token", "bytes_token")


_STRICT = "ip, time, request_method, url, protocol, status, bytes_sent, referer, user_agent"


@register("parse_regex", f"SELECT event_id, {_STRICT} FROM strict")
def parse_regex(spark, sf):
    """Strict combined-log regex parse (anchored both ends), matching lines only."""
    return parsing.strict_parse(lines(spark, sf)).select("event_id", *P.STRICT_LOG_GROUPS)


@register("parse_regex_norm_agent", """
SELECT event_id, ip, user_agent, regexp_extract(user_agent, '^([^"]*)', 1) AS user_agent_norm FROM strict""")
def parse_regex_norm_agent(spark, sf):
    """Strict parse with the agent cut at its closing quote."""
    return parsing.strict_parse_normalised(lines(spark, sf)).select(
        "event_id", "ip", "user_agent", "user_agent_norm")


@register("parse_time_ms", "SELECT event_id, time_local, tz_offset, epoch_ms FROM access")
def parse_time_ms(spark, sf):
    """Log time text + offset -> epoch milliseconds."""
    return access(spark, sf).select("event_id", "time_local", "tz_offset", "epoch_ms")


@register("extract_hour", "SELECT event_id, time_local, hour FROM access")
def extract_hour(spark, sf):
    """Hour of day (two characters after the first ':')."""
    return access(spark, sf).select("event_id", "time_local", "hour")


@register("row_key", """
SELECT event_id, concat_ws('_', remote_addr, time_local,
       sha256(concat('events:', CAST(event_id AS VARCHAR), ':', line))) AS row_key FROM access""")
def row_key(spark, sf):
    """Deterministic row key ip_time_sha256(source:position:line)."""
    df = access(spark, sf)
    return df.select("event_id", P.row_key("remote_addr", "time_local", "line", F.lit("events"), "event_id")
                     .alias("row_key"))


@register("quarantine_counts", """
SELECT reject AS reason, count(*) AS lines FROM access_all WHERE reject IS NOT NULL GROUP BY reject""")
def quarantine_counts(spark, sf):
    """Rejected lines per reason (nothing is silently dropped)."""
    q = parsing.quarantine(lines(spark, sf))
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@register("ip_findall", r"""
SELECT event_id, unnest(range(len(arr))) AS pos, unnest(arr) AS ip
FROM (SELECT event_id, regexp_extract_all(line, '(\d+\.\d+\.\d+\.\d+)', 1) AS arr FROM access_log)""")
def ip_findall(spark, sf):
    """Every dotted-quad substring of every line, with its position."""
    df = lines(spark, sf).select("event_id", F.posexplode(P.find_ips("line")).alias("pos", "ip"))
    return df.select("event_id", F.col("pos").cast("bigint").alias("pos"), "ip")


@register("ip_valid", r"""
SELECT ip, count(*) AS occurrences,
  len(string_split(ip, '.')) = 4 AND list_bool_and(list_transform(string_split(ip, '.'),
      lambda x: length(x) <= 3 AND TRY_CAST(x AS INTEGER) <= 255)) AS is_valid
FROM (SELECT unnest(regexp_extract_all(line, '(\d+\.\d+\.\d+\.\d+)', 1)) AS ip FROM access_log)
GROUP BY ip""")
def ip_valid(spark, sf):
    """Distinct found IPs, occurrences, and whether all four octets are 0..255."""
    df = lines(spark, sf).select(F.explode(P.find_ips("line")).alias("ip"))
    return (df.groupBy("ip").agg(F.count(F.lit(1)).alias("occurrences"))
            .withColumn("is_valid", P.ip_is_valid("ip")))


_CANON_SQL = "CASE " + " ".join(
    f"WHEN pro = '{k}' THEN '{v}'" for k, v in P.REGION_CANONICAL.items()) + " ELSE pro END"


@register("canonical_region", f"SELECT lo, pro, {_CANON_SQL} AS region FROM geo_ranges")
def canonical_region(spark, sf):
    """Short province names -> official names (others unchanged)."""
    g = geo_ranges(spark, sf)
    return g.select("lo", "pro", P.canonical_region("pro").alias("region"))
