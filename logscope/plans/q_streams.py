"""Structured Streaming queries (T2-T14): replay the log as files, drain with
``availableNow``, return the sink table. Each must equal its batch twin.

The replay delivers every fiftieth record with the last file only, far too late.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logscope.operators import activity, distinct, heavy, parsing, sinks
from logscope.plans.inputs import fields, lines
from logscope.plans.oracle_sql import having, hourly
from logscope.plans.registry import register
from logscope.session import scratch_dir
from logscope.sources import fixture
from logscope.sources.tables import read_table
from logscope.streaming import checkpoint, dedup, jobs, trailing, windows


def _records(spark, sf, redeliver: bool = False, disorder: bool = True):
    path = f"{scratch_dir(spark, 'replay')}/files"
    recs = lines(spark, sf).select(F.lit("events").alias("source"), F.col("event_id").alias("offset"), F.col("line").alias("value"))
    # From the table itself: of the log, the lines would be built for it.
    span = fixture.replay_span(read_table(spark, sf, "events", F.col("event_id").alias("offset")))
    fixture.write_replay(recs, path, redeliver=redeliver, disorder=disorder, span=span)
    return fixture.replay_records(spark, path, fixture.replay_slices(span))


def _dirs(spark, name):
    return scratch_dir(spark, name + "-sink"), scratch_dir(spark, name + "-ckpt")


def _state_partitions(spark) -> int:
    """One state-store partition per core for these replay queries."""
    return spark.sparkContext.defaultParallelism


def _register_totals(qname: str, keys: list[str], doc: str):
    cols = ", ".join(keys)
    rows = hourly() if keys == ["hour"] else having(*keys)

    def build(spark, sf):
        sink, ckpt = _dirs(spark, qname)
        jobs.running_totals(_records(spark, sf), keys, sink, ckpt, state_partitions=_state_partitions(spark))
        return jobs.read_latest(spark, sink, keys).select(*keys, "hits")
    build.__doc__ = doc
    register(qname, f"SELECT {cols}, count(*) AS hits FROM {rows} GROUP BY {cols}")(build)


_register_totals("stream_hits_by_hour", ["hour"], "Running hits per hour of day (state store).")
_register_totals("stream_http_version_totals", ["http_version"], "Running total per HTTP version.")
_register_totals("stream_method_totals", ["request_method"], "Running total per method.")
_register_totals("stream_ip_method_totals", ["remote_addr", "request_method"],
                 "Running total per (IP, method).")
_register_totals("stream_status_totals", ["status"], "Running total per status code.")
_register_totals("stream_agent_totals", ["http_user_agent"], "Running total per user agent.")
_register_totals("stream_url_totals", ["request_url"], "Running total per URL.")
_register_totals("stream_referer_totals", ["http_referer"], "Running total per referer.")


@register("stream_unique_ips_by_hour",
          f"SELECT hour, count(DISTINCT remote_addr) AS unique_ips FROM {having('remote_addr', 'hour')} GROUP BY hour")
def stream_unique_ips_by_hour(spark, sf):
    """True distinct IPs per hour on a stream (dedup state + count)."""
    sink, ckpt = _dirs(spark, "stream-uniq")
    jobs.unique_ips_by_hour(_records(spark, sf), sink, ckpt, state_partitions=_state_partitions(spark))
    return jobs.read_latest(spark, sink, ["hour"]).select("hour", "unique_ips")


# The replay has equal ranges of event_id; the files of each are one micro-batch.
_BATCHED = f"""
span AS (SELECT min(event_id) AS lo, greatest(1, -((-(max(event_id) - min(event_id) + 1)) // {fixture.REPLAY_FILES})) AS width
         FROM events),
batched AS (SELECT f.*, CAST((event_id - lo) // width AS BIGINT) AS batch_id FROM fields f, span WHERE length(line) > 10)"""


@register("stream_unique_ips_batch_sum", f"""
WITH {_BATCHED.strip()},
b AS (SELECT hour, batch_id, count(DISTINCT remote_addr) AS n FROM batched
      WHERE hour IS NOT NULL AND remote_addr IS NOT NULL GROUP BY ALL)
SELECT hour, CAST(sum(n) AS BIGINT) AS unique_ips FROM b GROUP BY hour""")
def stream_unique_ips_batch_sum(spark, sf):
    """Per-batch distinct IPs per hour, accumulated across micro-batches (literal reference form)."""
    sink, ckpt = _dirs(spark, "stream-uniq-sum")
    jobs.unique_ips_batch_sum(_records(spark, sf, disorder=False), sink, ckpt)
    return jobs.read_totals(spark, sink, ["hour"], "unique_ips").select("hour", "unique_ips")


@register("stream_batch_topn", f"""
WITH {_BATCHED.strip()},
c AS (SELECT batch_id, request_url, count(*) AS hits FROM batched WHERE request_url IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY hits DESC, request_url) AS rn FROM c)
SELECT batch_id, request_url, hits FROM r WHERE rn <= 10""")
def stream_batch_topn(spark, sf):
    """Top-10 URLs of every micro-batch, appended with the batch id."""
    sink, ckpt = _dirs(spark, "stream-topn")
    jobs.batch_top_n(_records(spark, sf, disorder=False), "request_url", 10, sink, ckpt)
    return sinks.read_appended(spark, sink).select("batch_id", "request_url", "hits")


@register("stream_access_etl", """
SELECT event_id, remote_addr, remote_user, time_local, status, body_bytes_send, request_method,
       request_url, http_version, http_referer, http_user_agent FROM access""")
def stream_access_etl(spark, sf):
    """Streaming ETL: parse once per micro-batch, write access rows and the quarantine."""
    sink, ckpt = _dirs(spark, "stream-etl")
    jobs.access_etl(_records(spark, sf), sink, ckpt)
    out = sinks.read_appended(spark, f"{sink}/access")
    return out.select(F.col("offset").alias("event_id"), *parsing.ACCESS_COLUMNS)


@register("stream_hourly_windows", f"""
SELECT CAST(floor(epoch_ms / 3600000) * 3600000 AS BIGINT) AS window_start_ms, count(*) AS hits
FROM {having("epoch_ms")} GROUP BY 1""")
def stream_hourly_windows(spark, sf):
    """Hits per event-time hour; records that come far too late still count."""
    sink, ckpt = _dirs(spark, "stream-windows")
    jobs.hourly_windows(_records(spark, sf), sink, ckpt)
    return jobs.read_totals(spark, sink, ["bucket_ms"], "hits").select(F.col("bucket_ms").alias("window_start_ms"), "hits")


@register("stream_ip_hourly_activity", f"""
WITH h AS (SELECT remote_addr, CAST(floor(epoch_ms / 3600000) * 3600000 AS BIGINT) AS bucket_ms,
                  count(*) AS hits FROM {having("remote_addr", "epoch_ms")} GROUP BY ALL)
SELECT remote_addr, bucket_ms, hits,
  CAST(sum(hits) OVER (PARTITION BY remote_addr ORDER BY bucket_ms
       RANGE BETWEEN {23 * 3600000} PRECEDING AND CURRENT ROW) AS BIGINT) AS hits_1d,
  CAST(sum(hits) OVER (PARTITION BY remote_addr ORDER BY bucket_ms
       RANGE BETWEEN {71 * 3600000} PRECEDING AND CURRENT ROW) AS BIGINT) AS hits_3d
FROM h""")
def stream_ip_hourly_activity(spark, sf):
    """Streaming per-IP activity: hourly counts, trailing 1-day / 3-day sums on them."""
    sink, ckpt = _dirs(spark, "stream-ip-hourly")
    jobs.ip_hourly_counts(_records(spark, sf), sink, ckpt)
    return activity.trailing_over_hours(jobs.read_totals(spark, sink, ["remote_addr", "bucket_ms"], "hits")
                                        .select("remote_addr", "bucket_ms", "hits"))


@register("stream_dedup", f"""
SELECT event_id, concat_ws('_', remote_addr, time_local,
       sha256(concat('events:', CAST(event_id AS VARCHAR), ':', line))) AS row_key
FROM {having("remote_addr", "time_local", "epoch_ms")}""")
def stream_dedup(spark, sf):
    """Every record sent twice, some far too late, each stored once."""
    sink, ckpt = _dirs(spark, "stream-dedup")
    dedup.distinct_records(_records(spark, sf, redeliver=True), sink, ckpt, state_partitions=_state_partitions(spark))
    return sinks.read_appended(spark, sink).select(F.col("offset").alias("event_id"), "row_key")


@register("stream_unique_ips_bitmap",
          f"SELECT hour, count(DISTINCT remote_addr) AS unique_ips FROM {having('remote_addr', 'hour')} GROUP BY hour")
def stream_unique_ips_bitmap(spark, sf):
    """True distinct IPs per hour on a stream without state: bitmaps that micro-batches append and a fold unites."""
    sink, ckpt = _dirs(spark, "stream-bitmap")
    jobs.unique_ips_bitmaps(_records(spark, sf), sink, ckpt)
    sinks.fold(spark, sink, merge=lambda rows: distinct.unite_bitmaps(rows, "hour"))
    return distinct.count_bitmaps(sinks.read_appended(spark, sink), "hour")


# A batch judges lateness by the watermark of the batch before: the latest time of the batches before that, less the delay.
_EVENT_WINDOWS_SQL = f"""
WITH {_BATCHED.strip()},
arrived AS (SELECT epoch_ms, CAST(floor(epoch_ms / 3600000) * 3600000 AS BIGINT) AS w,
                   CASE WHEN event_id % {fixture.LATE_EVERY} = {fixture.LATE_REST} THEN {fixture.REPLAY_FILES - 1} ELSE batch_id END AS batch
            FROM batched WHERE epoch_ms IS NOT NULL),
marks AS (SELECT b.batch, (SELECT max(epoch_ms) FROM arrived WHERE arrived.batch < b.batch - 1) - 3600000 AS mark
          FROM (SELECT DISTINCT batch FROM arrived) b),
judged AS (SELECT w, coalesce(w + 3600000 <= mark, false) AS late, w + 3600000 > (SELECT max(epoch_ms) FROM arrived) - 3600000 AS open
           FROM arrived JOIN marks ON arrived.batch = marks.batch)
SELECT w AS window_start_ms, count(*) FILTER (NOT late AND NOT open) AS closed_hits, count(*) FILTER (late) AS late_hits,
       count(*) FILTER (NOT late AND open) AS open_hits, count(*) AS hits
FROM judged GROUP BY w"""


@register("stream_event_windows", _EVENT_WINDOWS_SQL)
def stream_event_windows(spark, sf):
    """Event-time windows under a watermark: closed ones, corrections by late records, and what is still in the state."""
    sink, ckpt = _dirs(spark, "stream-event-windows")
    windows.event_windows(_records(spark, sf), sink, ckpt, state_partitions=_state_partitions(spark))
    return windows.read_event_windows(spark, sink, ckpt)


def _spans_sql() -> str:
    counts = ",\n  ".join(f"count(*) FILTER (a.epoch_ms >= l.last_seen_ms - {span}) AS {name}" for name, span in activity.TRAILING_SPANS.items())
    return f"""
WITH timed AS {having("remote_addr", "epoch_ms")},
last AS (SELECT remote_addr, max(epoch_ms) AS last_seen_ms FROM timed GROUP BY remote_addr)
SELECT a.remote_addr, l.last_seen_ms,
  {counts}
FROM timed a JOIN last l ON a.remote_addr = l.remote_addr GROUP BY a.remote_addr, l.last_seen_ms"""


@register("stream_ip_trailing", _spans_sql())
def stream_ip_trailing(spark, sf):
    """Trailing 1-day / 3-day hits per IP, kept up to date by keyed state as records come."""
    sink, ckpt = _dirs(spark, "stream-trailing")
    trailing.trailing_activity(_records(spark, sf), sink, ckpt, state_partitions=_state_partitions(spark))
    return jobs.read_latest(spark, sink, ["remote_addr"]).select("remote_addr", "last_seen_ms", *activity.TRAILING_SPANS)


@register("stream_state_audit", f"""
SELECT remote_addr, request_method, count(*) AS state_hits, count(*) AS sink_hits
FROM {having("remote_addr", "request_method")} GROUP BY remote_addr, request_method""")
def stream_state_audit(spark, sf):
    """Running totals per (IP, method): what the checkpoint's state holds next to what the sink holds."""
    sink, ckpt = _dirs(spark, "stream-audit")
    keys = ["remote_addr", "request_method"]
    jobs.running_totals(_records(spark, sf), keys, sink, ckpt, state_partitions=_state_partitions(spark))
    return checkpoint.audit_totals(spark, ckpt, sink, keys)


@register("stream_top_urls", f"""
SELECT request_url, count(*) AS hits FROM {having("request_url")} GROUP BY request_url ORDER BY hits DESC, request_url LIMIT 10""")
def stream_top_urls(spark, sf):
    """The ten most frequent URLs over all micro-batches: candidates from bounded summaries, then an exact recount of these."""
    sink, ckpt = _dirs(spark, "stream-heavy")
    jobs.heavy_hitters(_records(spark, sf), "request_url", sink, ckpt, slots=100)
    sinks.fold(spark, sink, merge=lambda rows: heavy.merge(rows, "request_url"))
    return heavy.top_n(sinks.read_appended(spark, sink), fields(spark, sf, "request_url"), "request_url", 10)
