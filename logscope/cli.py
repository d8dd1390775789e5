"""Command-line jobs over real log files or a Kafka topic (``spark-submit`` friendly).

    python -m logscope.cli etl      --input '/logs/*.txt' --output /tables/access
    python -m logscope.cli report   --input '/logs/*.txt' --report url --output /tables/top_urls [--top 10]
    python -m logscope.cli activity --input '/logs/*.txt' --output /tables/ip_activity
    python -m logscope.cli geo      --input '/logs/*.txt' --ranges /tables/geo_ranges --output /tables/by_region
    python -m logscope.cli cluster  --input '/logs/*.txt' --what requests|ips --output /tables/clusters
    python -m logscope.cli geo-replies --input '/replies/*.json' --output /tables/by_region
    python -m logscope.cli stream   --report url --files /incoming | --kafka host:9092 --topic test
                                    --sink /tables/url_totals --checkpoint /ckpt/url_totals [--once]
                                    (also unique_ips_by_hour, unique_ips_bitmaps, hourly_windows, event_windows, ip_hourly,
                                    ip_trailing, etl, dedup, topn)
    python -m logscope.cli fold     --sink /tables/url_totals --keys request_url [--sum hits]

Every job reads with Spark, writes parquet with Spark and prints nothing but a
one-line summary; the session (cluster, memory, shuffle width) comes from
``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import activity, cluster, geo, parsing, reports, sinks
from logscope.session import scratch_scope
from logscope.streaming import dedup, jobs, sources, trailing, windows

# report name -> grouping columns of the access table
REPORTS = {
    "ip": ["remote_addr"], "agent": ["http_user_agent"], "url": ["request_url"],
    "referer": ["http_referer"], "http_version": ["http_version"], "method": ["request_method"],
    "ip_method": ["remote_addr", "request_method"], "status": ["status"], "hour": ["hour"],
}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def _write(df: DataFrame, out: str, layout: dict | None = None) -> int:
    """Write and count in one pass."""
    seen = Observation("written")
    sinks.write_rows(df.observe(seen, F.count(F.lit(1)).alias("n")), out, layout or {}, "overwrite")
    return seen.get["n"]


STREAMS = ["unique_ips_by_hour", "unique_ips_batch_sum", "unique_ips_bitmaps", "hourly_windows", "event_windows", "ip_hourly",
           "ip_trailing", "etl", "dedup", "topn"]


def run(argv: list[str], spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="logscope")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("etl", "report", "activity", "geo", "geo-replies", "cluster"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
        if name == "report":
            s.add_argument("--report", choices=sorted(REPORTS) + ["unique_ips_by_hour"], required=True)
            s.add_argument("--top", type=int, default=0)
        if name == "geo":
            s.add_argument("--ranges", required=True, help="parquet table (lo, hi, pro, city)")
        if name == "cluster":
            s.add_argument("--what", choices=["requests", "ips"], default="ips")
    s = sub.add_parser("stream")
    s.add_argument("--report", choices=sorted(REPORTS) + STREAMS, required=True)
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--files")
    src.add_argument("--kafka")
    s.add_argument("--topic", default="test")
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--top", type=int, default=10, help="rows per micro-batch of topn")
    s.add_argument("--once", action="store_true", help="drain what is there, then stop")
    s = sub.add_parser("fold", help="maintenance of a stream's sink")
    s.add_argument("--sink", required=True)
    s.add_argument("--keys", default="", help="comma-separated key columns; none keeps all rows")
    s.add_argument("--sum", default="", help="column that is summed per key")
    a = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"logscope-{a.job}").getOrCreate()
    if a.job == "stream":
        return _stream(spark, a)
    if a.job == "fold":
        return f"fold: up to batch {sinks.fold(spark, a.sink, [k for k in a.keys.split(',') if k], a.sum or None)}"
    with scratch_scope(spark):
        return _batch(spark, a)


def _batch(spark: SparkSession, a) -> str:
    lines = _lines(spark, a.input)
    if a.job == "etl":
        named = spark.read.text(a.input).select(F.col("_metadata.file_path").alias("source"), F.lit(None).cast("bigint").alias("offset"),
                                                F.col("value").alias("line"))
        split = parsing.split_parse(sources.with_positions(named), keep=("source", "offset")).persist()
        try:
            key = P.row_key("remote_addr", "time_local", "line", "source", "offset")
            n = _write(split.where("reject IS NULL").select(
                key.alias("row_key"), *parsing.ACCESS_COLUMNS, "tz_offset", F.unix_millis("_event_time").alias("epoch_ms"), "hour",
                P.log_date().alias("log_date")).repartitionByRange("log_date", "row_key"), a.output, sinks.LOG_LAYOUT)
            q = _write(split.where("reject IS NOT NULL").select("line", F.col("reject").alias("reason")),
                       a.output.rstrip("/") + "_quarantine")
        finally:
            split.unpersist()
        return f"etl: {n} rows, {q} quarantined"
    if a.job == "report":
        if a.report == "unique_ips_by_hour":
            out = reports.unique_ips_by_hour(parsing.report_rows(lines, "remote_addr", "hour"))
        else:
            keys = REPORTS[a.report]
            rows = parsing.hourly_rows(lines) if keys == ["hour"] else parsing.report_rows(lines, *keys)
            out = reports.top_n(rows, a.top, *keys) if a.top else reports.ranked(rows, *keys)
        return f"report {a.report}: {_write(out, a.output)} rows"
    if a.job == "activity":
        out = activity.trailing_activity(parsing.report_rows(lines, "remote_addr", "epoch_ms"))
        return f"activity: {_write(out, a.output)} rows"
    if a.job == "geo":
        out = geo.ips_by_region(lines, spark.read.parquet(a.ranges))
        return f"geo: {_write(out, a.output)} rows"
    if a.job == "geo-replies":
        return f"geo-replies: {_write(geo.replies_by_region(geo.parse_replies(lines)), a.output)} rows"
    requests = parsing.strict_parse(lines.withColumn("event_id", F.monotonically_increasing_id()))
    if a.what == "ips":
        out = cluster.projection(cluster.ip_clusters(requests)).select("ip", *cluster.IP_FEATURES, "prediction", "x", "y")
    else:
        out = cluster.projection(cluster.request_clusters(requests)).select(
            "event_id", *cluster.REQUEST_COLUMNS, "prediction", "x", "y")
    return f"cluster {a.what}: {_write(out, a.output)} rows"


def _stream(spark: SparkSession, a) -> str:
    if a.files:
        records = sources.text_records(spark, a.files)
    else:
        records = sources.kafka_records(spark, a.kafka, a.topic)
    trigger = {"availableNow": True} if a.once else {"processingTime": "1 second"}
    named = {"unique_ips_by_hour": jobs.unique_ips_by_hour, "unique_ips_batch_sum": jobs.unique_ips_batch_sum,
             "unique_ips_bitmaps": jobs.unique_ips_bitmaps, "hourly_windows": jobs.hourly_windows,
             "event_windows": windows.event_windows, "ip_hourly": jobs.ip_hourly_counts, "ip_trailing": trailing.trailing_activity,
             "etl": jobs.access_etl, "dedup": partial(dedup.distinct_records, numbered=bool(a.kafka))}
    if a.report in named:
        done = named[a.report](records, a.sink, a.checkpoint, trigger=trigger)
    elif a.report == "topn":
        done = jobs.batch_top_n(records, "request_url", a.top, a.sink, a.checkpoint, trigger=trigger)
    else:
        done = jobs.running_totals(records, REPORTS[a.report], a.sink, a.checkpoint, trigger=trigger)
    return f"stream {a.report}: {done.batches} micro-batches, {done.unusable} of {done.records} records without its fields"


def main() -> None:
    print(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
