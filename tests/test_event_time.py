"""Streams with bounded state: closing windows, dedup, trailing activity; sets that add up; folding beside a stream."""

from __future__ import annotations

import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscope import cli
from logscope.operators import activity, distinct, parsing, sinks
from logscope.plans.inputs import fields, lines
from logscope.session import scratch_dir
from logscope.sources import fixture
from logscope.streaming import checkpoint, dedup, jobs, trailing, windows

HOUR = windows.HOUR_MS


def _records(spark):
    return lines(spark, SF_SMALL).select(F.lit("t/0").alias("source"), F.col("event_id").alias("offset"),
                                         F.col("line").alias("value"))


def _dirs(spark, *names):
    return [scratch_dir(spark, f"t-{n}") for n in names]


def _files(spark, path, batches):
    """One file, and so one micro-batch, per DataFrame of records, in this order."""
    for i, b in enumerate(batches):
        b.select("source", "offset", "value").coalesce(1).write.parquet(f"{path}/file={i}")
    fixture._stamp_in_order(spark, path)
    return fixture.replay_records(spark, path)


def _line(ip, day, clock, url="/a"):
    return f'{ip} - - [{day:02d}/Jan/2024:{clock} +0000] "GET {url} HTTP/1.1" 200 1 "-" "x"'


def _of(spark, rows):
    return spark.createDataFrame([("t/0", i, v) for i, v in rows], "source STRING, offset BIGINT, value STRING")


# ---------------------------------------------------------------- windows

def test_windows_close_once_and_late_records_are_corrections(spark):
    path, sink, ckpt = _dirs(spark, "w", "w-sink", "w-ckpt")
    fixture.write_replay(_records(spark), path, disorder=True)
    run = windows.event_windows(fixture.replay_records(spark, path), sink, ckpt, state_partitions=2)
    rows = sinks.read_appended(spark, sink).collect()
    closed = Counter(r["window_start_ms"] for r in rows if r["kind"] == "closed")
    assert set(closed.values()) == {1} and sum(r["hits"] for r in rows if r["kind"] == "late") > 0
    want = {r[0]: r[1] for r in fields(spark, SF_SMALL, "epoch_ms").groupBy((F.floor(F.col("epoch_ms") / HOUR) * HOUR).alias("w")).count().collect()}
    got = {r["window_start_ms"]: r for r in windows.read_event_windows(spark, sink, ckpt).collect()}
    assert {w: r["hits"] for w, r in got.items()} == want
    assert all(r["closed_hits"] + r["late_hits"] + r["open_hits"] == r["hits"] for r in got.values())
    # The state holds what is open, at no time all windows.
    assert checkpoint.state(spark, ckpt).count() == sum(r["open_hits"] > 0 for r in got.values()) <= 3
    assert run.state_rows < len(want) / 2
    assert sinks.fold(spark, sink, merge=windows.merge_windows) >= 0
    assert {r["window_start_ms"]: r for r in windows.read_event_windows(spark, sink, ckpt).collect()} == got


def test_a_record_that_is_late_to_its_window_goes_to_a_correction_of_its_batch(spark):
    path, sink, ckpt = _dirs(spark, "late", "late-sink", "late-ckpt")
    one, two = "1.1.1.1", "host7"
    batches = [[(0, _line(one, 1, "10:10:00")), (1, _line(two, 1, "10:20:00"))], [(2, _line(one, 1, "20:00:00"))], [(3, _line(one, 1, "21:00:00"))],
               [(4, _line(one, 1, "10:59:59")), (5, _line(two, 1, "10:00:00")), (6, _line(one, 1, "21:30:00")), (7, "no log line at all")]]
    stream = _files(spark, path, [_of(spark, b) for b in batches])
    run = windows.event_windows(stream, sink, ckpt, keys=("remote_addr",), delay="30 minutes")
    got = {(r["remote_addr"], (r["window_start_ms"] // HOUR) % 24): (r["closed_hits"], r["late_hits"], r["open_hits"])
           for r in windows.read_event_windows(spark, sink, ckpt, ("remote_addr",)).collect()}
    assert got == {(one, 10): (1, 1, 0), (two, 10): (1, 1, 0), (one, 20): (1, 0, 0), (one, 21): (0, 0, 2)}
    late = [r for r in sinks.read_appended(spark, sink).collect() if r["kind"] == "late"]
    assert {r["batch_id"] for r in late} == {3} and run.batches >= 4


def test_windows_go_on_after_a_restart(spark):
    src, sink, ckpt = _dirs(spark, "wr", "wr-sink", "wr-ckpt")
    recs = _records(spark)
    for name, part in (("a", "offset < 400"), ("b", "offset >= 400 AND offset < 700"), ("c", "offset >= 700")):
        fixture.write_replay(recs.where(part), f"{src}/{name}", disorder=True)
        windows.event_windows(fixture.replay_records(spark, src), sink, ckpt)
        table = windows.read_event_windows(spark, sink, ckpt)
        top = {"a": 400, "b": 700, "c": 10_000}[name]
        want = parsing.report_rows(lines(spark, SF_SMALL).where(F.col("event_id") < top), "epoch_ms").count()
        assert table.agg(F.sum("hits")).first()[0] == want
    assert max(Counter(r["window_start_ms"] for r in sinks.read_appended(spark, sink).where("kind = 'closed'").collect()).values()) == 1


# ---------------------------------------------------------------- dedup

def test_redelivery_after_the_state_is_gone_stays_out(spark):
    path, sink, ckpt = _dirs(spark, "d", "d-sink", "d-ckpt")
    parts = [_records(spark).where(f"offset >= {200 * i} AND offset < {200 * (i + 1)}") for i in range(5)]
    # The first two parts come again long after; the third at once.
    stream = _files(spark, path, [*parts[:3], parts[2], parts[3], parts[0], parts[4], parts[1].unionByName(parts[0])])
    run = dedup.distinct_records(stream, sink, ckpt, near_ms=0)
    want = parsing.report_rows(lines(spark, SF_SMALL), "remote_addr", "time_local", "epoch_ms").count()
    table = sinks.read_appended(spark, sink)
    assert table.count() == want == table.select("row_key").distinct().count()
    assert run.state_rows < want                      # the state never held all keys
    assert checkpoint.state(spark, ckpt).count() < want / 2


def test_recent_records_are_not_looked_for(spark, monkeypatch):
    """Records of the last half hour go by the state alone; older ones are looked for by date."""
    path, sink, ckpt = _dirs(spark, "now", "now-sink", "now-ckpt")
    clock = spark.sql("SELECT date_format(current_timestamp(), 'dd/MMM/yyyy:HH:mm:ss')").first()[0]
    now = [(i, f'1.2.3.{i} - - [{clock} +0000] "GET / HTTP/1.1" 200 1 "-" "x"') for i in range(20)]
    old = [(100 + i, _line(f"9.9.9.{i}", 3, "10:00:00")) for i in range(5)]
    looked = []
    real = dedup.unseen
    monkeypatch.setattr(dedup, "unseen", lambda batch, root: looked.append(batch.count()) or real(batch, root))
    stream = _files(spark, path, [_of(spark, now[:10] + old), _of(spark, now), _of(spark, old + now[5:])])
    dedup.distinct_records(stream, sink, ckpt)
    assert sinks.read_appended(spark, sink).count() == 25 and looked[:3] == [5, 0, 0]


def test_dedup_reads_the_dates_of_the_batch_only(spark):
    sink = scratch_dir(spark, "d-dates")
    rows = spark.createDataFrame([(f"k{d}-{i}", "t", i, f"2024-01-{d:02d}") for d in range(1, 11) for i in range(20)],
                                 "row_key STRING, source STRING, offset BIGINT, log_date STRING").withColumn("log_date", F.col("log_date").cast("date"))
    assert dedup.unseen(rows, sink) is rows
    sinks.append_batch(rows, sink, 0, partition_by=["log_date"], order_by=["row_key"], bloom=["row_key"])
    batch = rows.where("log_date = '2024-01-03'").withColumn("row_key", F.concat("row_key", F.when(F.col("offset") < 5, "new").otherwise("")))
    fresh = dedup.unseen(batch, sink)
    assert {r["offset"] for r in fresh.collect()} == set(range(5)) and fresh.columns == rows.columns
    scans = [ln for ln in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln]
    assert any("PartitionFilters" in ln and "2024-01-03" in ln for ln in scans), scans


def test_dedup_with_more_dates_than_are_named(spark, monkeypatch):
    monkeypatch.setattr(dedup, "DAYS", 3)
    sink = scratch_dir(spark, "d-many")
    rows = spark.range(200).selectExpr("concat('k', id) AS row_key", "'t' AS source", "id AS offset", "date_add(DATE'2024-01-01', CAST(id % 9 AS INT)) AS log_date")
    sinks.append_batch(rows.where("offset < 150"), sink, 0, partition_by=["log_date"])
    assert {r["offset"] for r in dedup.unseen(rows, sink).collect()} == set(range(150, 200))


# ---------------------------------------------------------------- trailing activity

def test_trailing_activity_equals_the_batch_operator_after_every_batch(spark):
    path, sink, ckpt = _dirs(spark, "a", "a-sink", "a-ckpt")
    recs = _records(spark)
    # Disorder of hours and of days, one client with half of the records.
    shaped = recs.withColumn("value", F.expr("if(offset % 2 = 0, regexp_replace(value, '^[^ ]+', '9.9.9.9'), value)"))
    order = F.when(F.col("offset") % 11 == 3, F.col("offset") + 300).otherwise(F.col("offset"))
    parts = [shaped.where((order >= 260 * i) & (order < 260 * (i + 1))) for i in range(5)]
    trailing.trailing_activity(_files(spark, path, parts), sink, ckpt, state_partitions=2)
    rows = sinks.read_appended(spark, sink).collect()
    so_far = None
    for i, part in enumerate(parts):
        so_far = part if so_far is None else so_far.unionByName(part)
        batch = activity.trailing_activity(parsing.report_rows(so_far, "remote_addr", "epoch_ms", line="value"))
        want = {r["remote_addr"]: (r["last_seen_ms"], r["hits_1d"], r["hits_3d"]) for r in batch.collect()}
        got = {r["remote_addr"]: (r["last_seen_ms"], r["hits_1d"], r["hits_3d"]) for r in rows if r["batch_id"] == i}
        touched = {r[0] for r in parsing.report_rows(part, "remote_addr", "epoch_ms", line="value").select("remote_addr").distinct().collect()}
        assert got == {ip: want[ip] for ip in touched}


def test_trailing_activity_runs_whatever_state_store_the_session_has(spark):
    src, sink, ckpt = _dirs(spark, "c", "c-sink", "c-ckpt")
    _files(spark, f"{src}/x", [_of(spark, [(d, _line("5.5.5.5", d, "01:00:00"))]) for d in (1, 2)])
    old = spark.conf.get(jobs.STATE_STORE_CONF)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(jobs.STATE_STORE_CONF, plain)
    try:
        trailing.trailing_activity(fixture.replay_records(spark, src), sink, ckpt, state_partitions=1)
        assert spark.conf.get(jobs.STATE_STORE_CONF) == plain
    finally:
        spark.conf.set(jobs.STATE_STORE_CONF, old)
    got = [tuple(r) for r in jobs.read_latest(spark, sink, ["remote_addr"]).select("remote_addr", "hits_1d", "hits_3d").collect()]
    assert got == [("5.5.5.5", 2, 2)]


def test_trailing_state_is_bounded_by_the_span_and_idle_clients_leave_it(spark):
    src, sink, ckpt = _dirs(spark, "b", "b-sink", "b-ckpt")
    days = [[(100 * d + i, _line("5.5.5.5", d, f"{i:02d}:00:00")) for i in range(24)] + [(100 * d + 50, _line("gone", d, "01:00:00"))] * (d == 1)
            for d in range(1, 11)]
    _files(spark, f"{src}/x", [_of(spark, b) for b in days])
    run = trailing.trailing_activity(fixture.replay_records(spark, src), sink, ckpt, idle_ms=1, state_partitions=1)
    got = {r["remote_addr"]: (r["hits_1d"], r["hits_3d"]) for r in jobs.read_latest(spark, sink, ["remote_addr"]).collect()}
    assert got["gone"] == (1, 1) and got["5.5.5.5"][0] <= 25
    assert run.state_rows <= 2 * (3 * 24 + 2) + 8                    # of ten days; values, hours, timers
    longer = trailing.trailing_activity(fixture.replay_records(spark, src), f"{sink}-2", f"{ckpt}-2", state_partitions=1)
    got = {r["remote_addr"]: (r["hits_1d"], r["hits_3d"]) for r in jobs.read_latest(spark, f"{sink}-2", ["remote_addr"]).collect()}
    assert got == {"gone": (1, 1), "5.5.5.5": (25, 73)} and longer.state_rows <= 3 * 24 + 1 + 12


# ---------------------------------------------------------------- sets that add up

def test_bitmaps_tell_all_clients_apart(spark):
    rows = [("00", c) for c in ["1.2.3.4", "01.2.3.4", "1.2.3.04", "1.2.3.256", "255.255.255.255", "0.0.0.0", "host", "::1", "1.2.3", "1.2.3.4.5"]]
    rows += [("01", f"10.{i % 7}.{i % 251}.{i % 256}") for i in range(9000)] + [("01", "1.2.3.4"), ("02", None)]
    df = spark.createDataFrame(rows, "hour STRING, remote_addr STRING")
    sets = distinct.bitmaps(df.repartition(5), "hour")
    want = {h: len({c for g, c in rows if g == h}) for h in ("00", "01")}
    assert {r["hour"]: r["unique_ips"] for r in distinct.count_bitmaps(sets, "hour").collect()} == want
    twice = sets.unionByName(distinct.bitmaps(df.where("hour = '01'"), "hour")).withColumn("batch_id", F.lit(3))
    one = distinct.unite_bitmaps(twice, "hour")
    assert {r["hour"]: r["unique_ips"] for r in distinct.count_bitmaps(one, "hour").collect()} == want
    assert one.count() == sets.count() and {r["batch_id"] for r in one.collect()} == {3}


def test_bitmap_sink_is_bounded_by_buckets_not_by_clients_and_batches(spark):
    root = scratch_dir(spark, "t-bits")
    many = spark.range(60_000).selectExpr("'07' AS hour", "concat('10.0.', CAST(id DIV 256 % 256 AS INT), '.', id % 256) AS remote_addr")
    for bid in range(3):
        sinks.append_batch(distinct.bitmaps(many, "hour"), root, bid)
    sinks.fold(spark, root, merge=lambda rows: distinct.unite_bitmaps(rows, "hour"))
    table = sinks.read_appended(spark, root)
    assert table.count() == 2 or table.count() == 3                   # 60,000 neighbours lie in two or three bitmaps
    assert distinct.count_bitmaps(table, "hour").first()["unique_ips"] == 60_000


def test_sketches_unite_and_stay_within_their_error(spark):
    clients = spark.range(200_000).selectExpr("CAST(id % 4 AS STRING) AS hour", "id % 3 AS day", "concat('c', id % 50000) AS remote_addr")
    stored = distinct.sketches(clients, "day", "hour")
    error = 3 * 1.04 / 2 ** (distinct.LG_K / 2)
    for by in ((), ("day",), ("hour",), ("day", "hour")):
        exact = {tuple(r[b] for b in by): r["n"] for r in clients.groupBy(*by).agg(F.countDistinct("remote_addr").alias("n")).collect()}
        got = {tuple(r[b] for b in by): r["estimate"] for r in distinct.estimate_sketches(stored, *by).collect()}
        assert got.keys() == exact.keys() and all(abs(got[k] - n) <= error * n for k, n in exact.items())


# ---------------------------------------------------------------- audit

def test_state_and_sink_agree_before_and_after_a_restart(spark):
    src, sink, ckpt = _dirs(spark, "au", "au-sink", "au-ckpt")
    recs, keys = _records(spark), ["remote_addr", "status"]
    for name, part in (("a", "offset < 500"), ("b", "offset >= 500")):
        fixture.write_replay(recs.where(part), f"{src}/{name}")
        jobs.running_totals(fixture.replay_records(spark, src), keys, sink, ckpt)
        rows = checkpoint.audit_totals(spark, ckpt, sink, keys).collect()
        assert rows and all(r["state_hits"] == r["sink_hits"] for r in rows)
    # A sink that lost a batch is found out.
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{sink}/log/batch_id={checkpoint.last_batch(spark, ckpt)}")
    assert p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    assert any(r["state_hits"] != r["sink_hits"] for r in checkpoint.audit_totals(spark, ckpt, sink, keys).collect())


# ---------------------------------------------------------------- folding

def test_a_batch_committed_during_a_fold_counts_once(spark, monkeypatch):
    root = scratch_dir(spark, "t-race")
    delta = spark.createDataFrame([("a", 1)], "k STRING, v BIGINT")
    for bid in range(3):
        sinks.upsert_accumulate(delta, root, ["k"], "v", bid)
    real = sinks._rows

    def beside(*a):
        rows = real(*a)
        sinks.upsert_accumulate(spark.createDataFrame([("a", 10)], "k STRING, v BIGINT"), root, ["k"], "v", 3)
        return rows
    monkeypatch.setattr(sinks, "_rows", beside)
    assert sinks.fold(spark, root, ["k"], "v") == 2
    monkeypatch.undo()
    assert sinks.read_totals(spark, root, ["k"], "v").first()["v"] == 13 and sinks.committed(spark, root) == [3]
    assert sinks.fold(spark, root, ["k"], "v") == 3 and sinks.read_totals(spark, root, ["k"], "v").first()["v"] == 13


def test_a_fold_that_ends_while_a_reader_lists_loses_nothing(spark, monkeypatch):
    root = scratch_dir(spark, "t-reader")
    delta = spark.createDataFrame([("a", 1)], "k STRING, v BIGINT")
    for bid in range(3):
        sinks.upsert_accumulate(delta, root, ["k"], "v", bid)
    real, done = sinks._snapshot, []

    def folded_first(*a):
        if not done:
            done.append(1)
            sinks.fold(spark, root, ["k"], "v")
        return real(*a)
    monkeypatch.setattr(sinks, "_snapshot", folded_first)
    assert sinks.read_totals(spark, root, ["k"], "v").first()["v"] == 3


def test_folding_keeps_partitions_order_and_bloom_filters(spark):
    root = scratch_dir(spark, "t-layout")
    rows = spark.range(4000).selectExpr("concat('k', lpad(id * 7 % 4000, 6, '0')) AS row_key", "id AS v",
                                        "date_add(DATE'2024-01-01', CAST(id % 4 AS INT)) AS log_date")
    how = {"partition_by": ["log_date"], "order_by": ["row_key"], "bloom": ["row_key"]}
    for bid in range(2):
        sinks.append_batch(rows.where(f"v % 2 = {bid}"), root, bid, **how)
    assert sinks.layout(spark, root) == how and sinks.layout(spark, scratch_dir(spark, "t-none")) == {}
    assert sinks.fold(spark, root) == 1
    one_day = sinks.key_scan(sinks.read_appended(spark, root).where("log_date = '2024-01-02'"), "row_key", "k000100", "k000200")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan and "GreaterThanOrEqual(row_key,k000100)" in plan
    assert one_day.count() == rows.where("log_date = '2024-01-02' AND row_key >= 'k000100' AND row_key < 'k000200'").count() > 0
    files = glob.glob(root.replace("file:", "") + "/base/v=*/log_date=*/*.parquet")
    spans = {}
    for f in files:
        data = pq.ParquetFile(f)
        keys = data.read(["row_key"]).column(0).to_pylist()
        assert keys == sorted(keys)
        spans.setdefault(f.split("log_date=")[1][:10], []).append((keys[0], keys[-1]))
    for parts in spans.values():                                    # files of a date do not overlap: a key is in one file
        parts.sort()
        assert all(a[1] < b[0] for a, b in zip(parts, parts[1:]))
    assert len(spans) == 4
    point = sinks.read_appended(spark, root).where("row_key = 'k000105'")
    assert point.count() == 1 and "EqualTo(row_key,k000105)" in point._jdf.queryExecution().executedPlan().toString()


def test_point_gets_read_one_day_and_push_the_key(spark):
    root = scratch_dir(spark, "t-get")
    rows = spark.range(900).selectExpr(
        "concat('10.0.0.', id % 7, '_', date_format(date_add(DATE'2024-01-01', CAST(id % 9 AS INT)), 'dd/MMM/yyyy'), ':00:00:00_', sha2(CAST(id AS STRING), 256)) AS row_key",
        "id AS v", "date_add(DATE'2024-01-01', CAST(id % 9 AS INT)) AS log_date")
    for bid in range(2):
        sinks.append_batch(rows.where(f"v % 2 = {bid}"), root, bid, **sinks.LOG_LAYOUT)
    keys = [r["row_key"] for r in rows.where("v IN (12, 500)").collect()]
    for _ in range(2):
        table = sinks.read_appended(spark, root)
        one = sinks.key_get(table, keys[:1])
        assert [r["v"] for r in one.collect()] == [12] and {r["v"] for r in sinks.key_get(table, keys).collect()} == {12, 500}
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "2024-01-04" in plan.split("PartitionFilters: ")[1].split("]")[0] and "PushedFilters: [" in plan and "EqualTo(row_key," in plan
        assert sinks.key_get(table, ["no key"]).count() == sinks.key_get(table, []).count() == 0
        sinks.fold(spark, root)
    files = glob.glob(root.replace("file:", "") + "/base/v=*/log_date=2024-01-04/*.parquet")
    group = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert len(files) == 1 and group.path_in_schema == "row_key"


def test_rows_of_one_key_in_one_batch_have_a_defined_winner(spark):
    for rows in ([("a", 1), ("a", 2)], [("a", 2), ("a", 1)]):
        root = scratch_dir(spark, "t-tie")
        sinks.upsert_latest(spark.createDataFrame(rows, "k STRING, v BIGINT").repartition(2), root, ["k"], 0)
        assert sinks.read_latest(spark, root, ["k"]).first()["v"] == 2


# ---------------------------------------------------------------- command line

@pytest.mark.parametrize("report", ["event_windows", "ip_trailing", "unique_ips_bitmaps", "dedup"])
def test_the_jobs_run_from_the_command_line(spark, report):
    src, sink, ckpt = _dirs(spark, "cli", "cli-sink", "cli-ckpt")
    lines(spark, SF_SMALL).select("line").coalesce(2).write.text(src)
    said = cli.run(["stream", "--report", report, "--files", src, "--sink", sink, "--checkpoint", ckpt, "--once"], spark)
    assert said.startswith(f"stream {report}:") and sinks.read_appended(spark, sink).count() > 0
    timed = parsing.report_rows(lines(spark, SF_SMALL), "remote_addr", "time_local", "epoch_ms").count()
    if report == "dedup":
        assert sinks.read_appended(spark, sink).count() == timed
    if report == "event_windows":
        assert windows.read_event_windows(spark, sink, ckpt).agg(F.sum("hits")).first()[0] == timed
