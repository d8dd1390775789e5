"""The command-line jobs on plain log files equal the library operators."""

from __future__ import annotations

from conftest import SF_SMALL
from logscope import cli
from logscope.operators import activity, geo, parsing, reports, sinks
from logscope.plans.inputs import access, geo_ranges, lines
from logscope.session import scratch_dir
from logscope.sources import text


def _logs(spark):
    path = scratch_dir(spark, "cli-logs")
    text.write_lines(lines(spark, SF_SMALL).repartition(3), path)
    return path


def _scratch(spark):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return {s.getPath().getName() for s in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)}


def test_cli_batch_jobs(spark):
    logs = _logs(spark)
    out = scratch_dir(spark, "cli-out")
    acc = access(spark, SF_SMALL)

    msg = cli.run(["etl", "--input", logs, "--output", f"{out}/access"], spark)
    assert msg == f"etl: {acc.count()} rows, {1000 - acc.count()} quarantined"

    stored = spark.read.parquet(f"{out}/access")
    assert stored.count() == stored.select("row_key").distinct().count() == acc.count()
    some = sinks.key_scan(stored.where("log_date = '2024-01-05'"), "row_key", "10.", "2")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan and "GreaterThanOrEqual(row_key,10.)" in plan
    assert some.count() == acc.where("time_local LIKE '05/Jan/2024%' AND remote_addr >= '10.' AND remote_addr < '2'").count() > 0

    cli.run(["report", "--input", logs, "--report", "url", "--top", "5", "--output", f"{out}/top"], spark)
    got = sorted(spark.read.parquet(f"{out}/top").collect())
    ln = lines(spark, SF_SMALL)
    assert got == sorted(reports.top_n(parsing.report_rows(ln, "request_url"), 5, "request_url").collect())

    cli.run(["activity", "--input", logs, "--output", f"{out}/act"], spark)
    got = sorted(spark.read.parquet(f"{out}/act").collect())
    assert got == sorted(activity.trailing_activity(parsing.report_rows(ln, "remote_addr", "epoch_ms")).collect())

    geo_ranges(spark, SF_SMALL).write.parquet(f"{out}/ranges")
    cli.run(["geo", "--input", logs, "--ranges", f"{out}/ranges", "--output", f"{out}/geo"], spark)
    got = sorted(spark.read.parquet(f"{out}/geo").collect())
    assert got == sorted(geo.ips_by_region(lines(spark, SF_SMALL), geo_ranges(spark, SF_SMALL)).collect())

    left = _scratch(spark)
    msg = cli.run(["cluster", "--input", logs, "--what", "ips", "--output", f"{out}/ipc"], spark)
    assert msg.startswith("cluster ips: ")
    assert {"prediction", "x", "y"} <= set(spark.read.parquet(f"{out}/ipc").columns)
    assert _scratch(spark) == left                                     # what a job wrote on its way is gone


def test_cli_stream_once(spark):
    logs = _logs(spark)
    sink, ckpt = scratch_dir(spark, "cli-sink"), scratch_dir(spark, "cli-ckpt")
    msg = cli.run(["stream", "--report", "status", "--files", logs, "--sink", sink,
                   "--checkpoint", ckpt, "--once"], spark)
    assert msg.startswith("stream status:")
    got = {r["status"]: r["hits"] for r in sinks.read_latest(spark, sink, ["status"]).collect()}
    rows = parsing.report_rows(lines(spark, SF_SMALL), "status")
    want = {r["status"]: r["hits"] for r in reports.hits_by(rows, "status").collect()}
    assert got == want and f"{1000 - rows.count()} of 1000 records" in msg


def test_cli_other_streams(spark):
    logs, n = _logs(spark), access(spark, SF_SMALL).count()
    out = scratch_dir(spark, "cli-streams")

    def stream(report, *more):
        return cli.run(["stream", "--report", report, "--files", logs, "--sink", f"{out}/{report}",
                        "--checkpoint", f"{out}/ckpt-{report}", "--once", *more], spark)

    stream("etl")
    assert sinks.read_appended(spark, f"{out}/etl/access").count() == n
    assert sinks.read_appended(spark, f"{out}/etl/quarantine").count() == 1000 - n
    stream("dedup")
    timed = parsing.report_rows(lines(spark, SF_SMALL), "remote_addr", "time_local", "epoch_ms").count()
    assert sinks.read_appended(spark, f"{out}/dedup").count() == timed
    stream("ip_hourly")
    assert sinks.read_totals(spark, f"{out}/ip_hourly", ["remote_addr", "bucket_ms"], "hits").agg({"hits": "sum"}).first()[0] == timed
    assert cli.run(["fold", "--sink", f"{out}/ip_hourly", "--keys", "remote_addr,bucket_ms", "--sum", "hits"], spark).startswith("fold:")
    assert sinks.read_totals(spark, f"{out}/ip_hourly", ["remote_addr", "bucket_ms"], "hits").agg({"hits": "sum"}).first()[0] == timed
    stream("topn", "--top", "3")
    assert sinks.read_appended(spark, f"{out}/topn").count() == 9          # three files, three micro-batches
