"""Sinks and keyed-table scans.

The batch-merge queries split the log into two deliveries by day of month (days 1-15, then
16-30) and deliver the second one twice; the results cover every row exactly once. The log is
parsed once and written by delivery, so that a delivery reads only its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import parsing, reports, sinks
from logscope.plans.inputs import access, fields
from logscope.plans.oracle_sql import having
from logscope.plans.registry import register
from logscope.session import scratch_dir


def _deliveries(spark, sf, *names: str) -> list[tuple[int, DataFrame]]:
    """[(batch_id, rows)] for the two deliveries plus a replay of the second."""
    path = f"{scratch_dir(spark, 'deliveries')}/rows"
    rows = fields(spark, sf, "day", *names)
    rows.withColumn("delivery", F.when(F.col("day") <= 15, 1).otherwise(2)).write.partitionBy("delivery").parquet(path)
    table = spark.read.parquet(path)
    first, second = table.where("delivery = 1"), table.where("delivery = 2")
    return [(1, first), (2, second), (2, second)]


_NUMBERS = ("status", "body_bytes_send")
CLIENT = ["remote_addr", "remote_user", "time_local", "status", "body_bytes_send"]
REQUEST = ["request_method", "request_url", "http_version", "http_referer", "http_user_agent"]


def _trimmed(columns):
    return [F.col(c) if c in _NUMBERS else F.trim(c).alias(c) for c in columns]


def _etl(spark, sf, columns):
    return sinks.read_appended(spark, _stored(spark, sf, columns))


def _stored(spark, sf, columns) -> str:
    """Append ``columns`` of the log table (trimmed strings), partitioned by log date, sorted by key.

    The key is stored: address, time and a digest of the record's identity.
    """
    root = scratch_dir(spark, "access-etl")
    key = P.row_key("remote_addr", "time_local", "line", F.lit("events"), "event_id")
    rows = access(spark, sf).select(
        "event_id", key.alias("row_key"), *_trimmed(columns),
        P.log_date().alias("log_date"))
    # Rows of one date and address prefix come together, so that a file has a narrow range of keys;
    # a rebalance, unlike a repartition, lets Spark split a prefix that is too large and join small ones.
    near = rows.withColumn("_prefix", F.substring_index("row_key", ".", 1)).hint("rebalance", "log_date", "_prefix")
    sinks.append_batch(near.drop("_prefix"), root, 0, **sinks.LOG_LAYOUT)
    return root


def _trimmed_sql(columns):
    return ", ".join(c if c in _NUMBERS else f"trim({c}) AS {c}" for c in columns)


@register("etl_access_rows", f"SELECT event_id, {_trimmed_sql(parsing.ACCESS_COLUMNS)} FROM access")
def etl_access_rows(spark, sf):
    """Parsed log appended to the ten-column access table, read back."""
    return _etl(spark, sf, parsing.ACCESS_COLUMNS).select("event_id", *parsing.ACCESS_COLUMNS)


@register("project_client", f"SELECT event_id, {_trimmed_sql(CLIENT)} FROM access")
def project_client(spark, sf):
    """Client columns (ip, user, time, status, bytes) appended to a table of their own."""
    return _etl(spark, sf, CLIENT).select("event_id", *CLIENT)


@register("project_request", f"SELECT event_id, {_trimmed_sql(REQUEST)} FROM access")
def project_request(spark, sf):
    """Request columns (method, url, version, referer, agent) appended to a table of their own."""
    return _etl(spark, sf, REQUEST).select("event_id", *REQUEST)


_KEY_COLUMNS = ["row_key", "event_id", "remote_addr", "time_local", "request_url"]
_KEYED_SQL = """
WITH keyed AS (SELECT concat_ws('_', remote_addr, time_local,
        sha256(concat('events:', CAST(event_id AS VARCHAR), ':', line))) AS row_key,
        event_id, remote_addr, time_local, request_url FROM access)"""

RANGE_START, RANGE_STOP = "10.", "2"          # IPs whose first octet is 10..19
KEY_REGEX = r"^\d+\.\d+\.\d+\.\d+_0[1-9]/Jan/2024:"   # requests of Jan 1st-9th


def keyed_table(spark, sf) -> DataFrame:
    """The stored table of the key scans."""
    return _etl(spark, sf, ["remote_addr", "time_local", "request_url"]).select(*_KEY_COLUMNS, "log_date")


@register("key_range_scan", _KEYED_SQL + f"""
SELECT * FROM keyed WHERE row_key >= '{RANGE_START}' AND row_key < '{RANGE_STOP}'""")
def key_range_scan(spark, sf):
    """Keyed-table scan between a start key (inclusive) and a stop key (exclusive)."""
    return sinks.key_scan(keyed_table(spark, sf), "row_key", RANGE_START, RANGE_STOP).select(*_KEY_COLUMNS)


@register("key_regex_scan", _KEYED_SQL + f"""
SELECT * FROM keyed WHERE regexp_matches(row_key, '{KEY_REGEX}')""")
def key_regex_scan(spark, sf):
    """Keyed-table scan with a regular-expression find on the key; the dates it names prune partitions."""
    days = keyed_table(spark, sf).where("log_date BETWEEN DATE'2024-01-01' AND DATE'2024-01-09'")
    return sinks.key_scan(days, "row_key", regex=KEY_REGEX).select(*_KEY_COLUMNS)


@register("key_point_get", _KEYED_SQL + """
SELECT * FROM keyed WHERE row_key IN (SELECT min(row_key) FROM keyed UNION ALL SELECT max(row_key) FROM keyed)""")
def key_point_get(spark, sf):
    """Two rows of the stored table by their whole keys, after its batches were folded."""
    root = _stored(spark, sf, ["remote_addr", "time_local", "request_url"])
    sinks.fold(spark, root)
    table = sinks.read_appended(spark, root)
    ends = table.agg(F.min("row_key"), F.max("row_key")).first()
    return sinks.key_get(table, list(ends)).select(*_KEY_COLUMNS)


_URLS = having("day", "request_url")


@register("upsert_latest", f"""
WITH a AS (SELECT request_url, count(*) AS hits FROM {_URLS} WHERE day <= 15 GROUP BY 1),
b AS (SELECT request_url, count(*) AS hits FROM {_URLS} WHERE day > 15 GROUP BY 1)
SELECT coalesce(b.request_url, a.request_url) AS request_url, coalesce(b.hits, a.hits) AS hits,
       CAST(CASE WHEN b.request_url IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS batch_id
FROM a FULL OUTER JOIN b ON a.request_url = b.request_url""")
def upsert_latest(spark, sf):
    """Keyed put, last write wins, replay-safe: per-URL batch counts."""
    root = scratch_dir(spark, "upsert-latest")
    for bid, rows in _deliveries(spark, sf, "request_url"):
        sinks.upsert_latest(reports.hits_by(rows, "request_url"), root, ["request_url"], bid)
    return sinks.read_latest(spark, root, ["request_url"]).select("request_url", "hits", "batch_id")


@register("upsert_accumulate_hour", f"""
WITH b AS (SELECT hour, CASE WHEN day <= 15 THEN 1 ELSE 2 END AS batch,
                  count(DISTINCT remote_addr) AS n FROM {having("day", "hour", "remote_addr")} GROUP BY 1, 2)
SELECT hour, CAST(sum(n) AS BIGINT) AS unique_ips FROM b GROUP BY hour""")
def upsert_accumulate_hour(spark, sf):
    """hour -> count += per-delivery distinct IPs (replayed delivery not double-counted)."""
    root = scratch_dir(spark, "hour-count")
    for bid, rows in _deliveries(spark, sf, "hour", "remote_addr"):
        sinks.upsert_accumulate(reports.unique_ips_by_hour(rows), root, ["hour"], "unique_ips", bid)
    return sinks.read_totals(spark, root, ["hour"], "unique_ips").select("hour", "unique_ips")


@register("upsert_accumulate_ip", f"""
SELECT remote_addr, count(*) AS hits FROM {having("day", "remote_addr")} GROUP BY remote_addr""")
def upsert_accumulate_ip(spark, sf):
    """ip -> count += per-delivery hits (replayed delivery not double-counted)."""
    root = scratch_dir(spark, "ip-count")
    for bid, rows in _deliveries(spark, sf, "remote_addr"):
        sinks.upsert_accumulate(reports.hits_by(rows, "remote_addr"), root, ["remote_addr"], "hits", bid)
    return sinks.read_totals(spark, root, ["remote_addr"], "hits").select("remote_addr", "hits")


_SNAPSHOT_METRICS = [("status", "CAST(status AS VARCHAR)"), ("method", "request_method"),
                     ("ip_method", "(remote_addr || '_' || request_method)"),
                     ("http_version", "http_version")]


def _snapshot_rows(df):
    """Counts of four metrics; a row counts in those whose fields it has."""
    keyed = {
        "status": F.col("status").cast("string"),
        "method": F.col("request_method"),
        "ip_method": F.concat("remote_addr", F.lit("_"), "request_method"),
        "http_version": F.col("http_version"),
    }
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), k.alias("key")) for m, k in keyed.items()])).alias("s")).where("s.key IS NOT NULL")
    return stacked.groupBy("s.metric", "s.key").agg(F.count(F.lit(1)).alias("value"))


@register("report_snapshot", f"WITH d AS (SELECT *, CASE WHEN day <= 15 THEN 1 ELSE 2 END AS batch_id FROM {having('day')})\n"
          + "\nUNION ALL\n".join(
              f"SELECT '{m}' AS metric, {k} AS key, count(*) AS value, CAST(batch_id AS INTEGER) AS batch_id "
              f"FROM d WHERE {k} IS NOT NULL GROUP BY {k}, batch_id" for m, k in _SNAPSHOT_METRICS))
def report_snapshot(spark, sf):
    """Per-delivery report counts appended with (metric, batch_id); a replay changes nothing."""
    from logscope.plans.inputs import lines

    root = scratch_dir(spark, "report-snapshot")
    path = f"{scratch_dir(spark, 'deliveries')}/rows"
    rows = parsing.report_fields(lines(spark, sf), ["day"], ["status", "request_method", "remote_addr", "http_version"])
    rows.withColumn("delivery", F.when(F.col("day") <= 15, 1).otherwise(2)).write.partitionBy("delivery").parquet(path)
    table = spark.read.parquet(path)
    for bid in (1, 2, 2):
        sinks.append_batch(_snapshot_rows(table.where(F.col("delivery") == bid)), root, bid)
    out = sinks.read_appended(spark, root)
    return out.select("metric", "key", "value", F.col("batch_id").cast("int").alias("batch_id"))


@register("running_total_merge", f"""
WITH a AS (SELECT request_url, count(*) AS n FROM {_URLS} WHERE day <= 15 GROUP BY 1),
b AS (SELECT request_url, count(*) AS n FROM {_URLS} WHERE day > 15 GROUP BY 1)
SELECT coalesce(a.request_url, b.request_url) AS request_url,
       coalesce(a.n, 0) + coalesce(b.n, 0) AS hits
FROM a FULL OUTER JOIN b ON a.request_url = b.request_url""")
def running_total_merge(spark, sf):
    """Stored totals + new batch counts per key (equi full-outer join)."""
    root = scratch_dir(spark, "stored-totals")
    (_, first), (_, second), _ = _deliveries(spark, sf, "request_url")
    sinks.append_batch(reports.hits_by(first, "request_url", name="a"), root, 1)
    stored = sinks.read_appended(spark, root).drop("batch_id")
    batch = reports.hits_by(second, "request_url", name="b")
    merged = stored.join(batch, "request_url", "full_outer")
    return merged.select("request_url", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("hits"))
