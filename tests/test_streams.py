"""Streaming: stream == batch, restart from checkpoint, replayed deliveries, sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscope.operators import reports, sinks
from logscope.plans.inputs import fields, lines
from logscope.session import scratch_dir
from logscope.sources import fixture
from logscope.streaming import dedup, jobs, sources


def _records(spark):
    return lines(spark, SF_SMALL).select(F.lit("t/0").alias("source"), F.col("event_id").alias("offset"),
                                         F.col("line").alias("value"))


def _rows(spark, *names):
    return fields(spark, SF_SMALL, *names)


def test_replay_files_are_consumed_in_offset_order(spark):
    path = scratch_dir(spark, "t-replay")
    assert fixture.write_replay(_records(spark), path) == 5
    seen = []

    def batch_fn(b, bid):
        r = b.agg(F.min("offset"), F.max("offset")).first()
        if r[0] is not None:
            seen.append((r[0], r[1]))

    stream = fixture.replay_records(spark, path, 1)
    jobs._run(stream, "", scratch_dir(spark, "t-ckpt"), batch_fn, mode="append")
    assert len(seen) == 5
    assert all(seen[i][1] < seen[i + 1][0] for i in range(len(seen) - 1))


def test_restart_from_checkpoint_keeps_totals_exact(spark):
    """Stop after part of the files, add the rest, restart: totals equal the batch result."""
    recs = _records(spark)
    src = scratch_dir(spark, "t-src")
    first = recs.filter("offset < 500")
    rest = recs.filter("offset >= 500")
    fixture.write_replay(first, f"{src}/a")
    sink, ckpt = scratch_dir(spark, "t-sink"), scratch_dir(spark, "t-ckpt")
    stream_a = fixture.replay_records(spark, src, 1)
    jobs.running_totals(stream_a, ["request_method"], sink, ckpt)
    fixture.write_replay(rest, f"{src}/b")
    stream_b = fixture.replay_records(spark, src, 1)
    run = jobs.running_totals(stream_b, ["request_method"], sink, ckpt)
    assert run.batches == 5                       # only the new files were read
    got = {r["request_method"]: r["hits"] for r in jobs.read_latest(spark, sink, ["request_method"]).collect()}
    want = {r["request_method"]: r["hits"]
            for r in reports.hits_by(_rows(spark, "request_method"), "request_method").collect()}
    assert got == want


def test_text_tail_source_equals_batch(spark):
    """Plain log files tailed from a directory give the same running totals as the batch report."""
    from logscope.sources import text

    src = scratch_dir(spark, "t-text")
    text.write_lines(lines(spark, SF_SMALL).repartition(3), src)
    sink, ckpt = scratch_dir(spark, "t-text-sink"), scratch_dir(spark, "t-text-ckpt")
    run = jobs.running_totals(sources.text_records(spark, src, 1), ["http_version"], sink, ckpt)
    assert run.batches == 3
    got = {r["http_version"]: r["hits"] for r in jobs.read_latest(spark, sink, ["http_version"]).collect()}
    want = {r["http_version"]: r["hits"]
            for r in reports.hits_by(_rows(spark, "http_version"), "http_version").collect()}
    assert got == want


def test_processing_time_trigger_runs_and_stops(spark):
    recs = _records(spark)
    path = scratch_dir(spark, "t-pt")
    fixture.write_replay(recs, path)
    sink, ckpt = scratch_dir(spark, "t-pt-sink"), scratch_dir(spark, "t-pt-ckpt")
    agg = jobs.parsed(fixture.replay_records(spark, path, 1), "status").groupBy("status").agg(
        F.count(F.lit(1)).alias("hits"))
    q = jobs.start(agg, ckpt, lambda b, bid: sinks.upsert_latest(b, sink, ["status"], bid),
                   interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["status"]: r["hits"] for r in jobs.read_latest(spark, sink, ["status"]).collect()}
    want = {r["status"]: r["hits"] for r in reports.hits_by(_rows(spark, "status"), "status").collect()}
    assert got == want


def test_console_preview_runs(spark):
    path = scratch_dir(spark, "t-cons")
    fixture.write_replay(_records(spark), path)
    counts = jobs.parsed(fixture.replay_records(spark, path, 1), "request_url").groupBy("request_url").agg(
        F.count(F.lit(1)).alias("hits"))
    q = jobs.console_preview(counts, scratch_dir(spark, "t-cons-ckpt"),
                             [F.col("hits").desc(), "request_url"])
    q.awaitTermination()
    assert q.exception() is None


def test_upsert_accumulate_ignores_replayed_batch(spark):
    root = scratch_dir(spark, "t-acc")
    d = spark.createDataFrame([("a", 2), ("b", 3)], "k STRING, v BIGINT")
    assert sinks.upsert_accumulate(d, root, ["k"], "v", 0)
    assert sinks.upsert_accumulate(d, root, ["k"], "v", 1)
    assert not sinks.upsert_accumulate(d, root, ["k"], "v", 1)      # replay: no-op
    got = {r["k"]: r["v"] for r in sinks.read_totals(spark, root, ["k"], "v").collect()}
    assert got == {"a": 4, "b": 6}


def test_upsert_latest_last_write_wins(spark):
    root = scratch_dir(spark, "t-up")
    sinks.upsert_latest(spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, v BIGINT"),
                        root, ["k"], 0)
    sinks.upsert_latest(spark.createDataFrame([("b", 7), ("c", 2)], "k STRING, v BIGINT"),
                        root, ["k"], 1)
    got = {r["k"]: (r["v"], r["batch_id"]) for r in sinks.read_latest(spark, root, ["k"]).collect()}
    assert got == {"a": (1, 0), "b": (7, 1), "c": (2, 1)}


def _filled(spark, root):
    acc, lat = f"{root}/acc", f"{root}/lat"
    for bid in range(1, 6):
        d = spark.createDataFrame([("a", bid), ("b", 1)], "k STRING, v BIGINT")
        sinks.upsert_accumulate(d, acc, ["k"], "v", bid)
        sinks.upsert_latest(d, lat, ["k"], bid)
    return acc, lat


def _read(spark, acc, lat):
    return ({r["k"]: r["v"] for r in sinks.read_totals(spark, acc, ["k"], "v").collect()},
            {r["k"]: (r["v"], r["batch_id"]) for r in sinks.read_latest(spark, lat, ["k"]).collect()})


def test_folding_changes_no_total_and_replays_stay_replays(spark):
    acc, lat = _filled(spark, scratch_dir(spark, "t-fold"))
    want = ({"a": 15, "b": 5}, {"a": (5, 5), "b": (1, 5)})
    assert _read(spark, acc, lat) == want
    assert sinks.fold(spark, acc, ["k"], "v") == 5 and sinks.fold(spark, lat, ["k"]) == 5
    assert _read(spark, acc, lat) == want and sinks.committed(spark, acc) == []
    again = spark.createDataFrame([("a", 5), ("b", 1)], "k STRING, v BIGINT")
    assert not sinks.upsert_accumulate(again, acc, ["k"], "v", 5)          # the batch that was folded last
    assert not sinks.upsert_latest(again, lat, ["k"], 3)
    assert _read(spark, acc, lat) == want
    assert sinks.upsert_accumulate(again, acc, ["k"], "v", 6)
    assert sinks.fold(spark, acc, ["k"], "v") == 6 and sinks.fold(spark, acc, ["k"], "v") == 6
    assert _read(spark, acc, lat)[0] == {"a": 20, "b": 6}


def test_a_fold_that_fails_loses_nothing(spark, monkeypatch):
    acc, lat = _filled(spark, scratch_dir(spark, "t-crash"))
    want = _read(spark, acc, lat)
    real = sinks._totals
    monkeypatch.setattr(sinks, "_totals", lambda *a: real(*a).withColumn("v", F.raise_error(F.lit("lost")).cast("bigint")))
    with pytest.raises(Exception, match="lost"):
        sinks.fold(spark, acc, ["k"], "v")
    monkeypatch.undo()
    assert _read(spark, acc, lat) == want                                  # the old files are all there
    # Stopped between the commit and the deletion: both are there, and count once.
    rows = sinks.read_totals(spark, acc, ["k"], "v")
    rows.write.parquet(f"{acc}/base/v=000000000005-crash")
    assert _read(spark, acc, lat) == want
    assert sinks.upsert_accumulate(spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), acc, ["k"], "v", 6)
    assert sinks.fold(spark, acc, ["k"], "v") == 6 and _read(spark, acc, lat)[0] == {"a": 16, "b": 5}


def test_uncommitted_batches_are_not_read(spark):
    root = scratch_dir(spark, "t-part")
    d = spark.createDataFrame([("a", 1)], "k STRING, v BIGINT")
    sinks.append_batch(d, root, 0)
    d.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/log/batch_id=1")
    assert sinks.committed(spark, root) == [0] and sinks.read_appended(spark, root).count() == 1
    assert sinks.append_batch(d, root, 1) and sinks.read_appended(spark, root).count() == 2


def test_records_are_named_by_their_whole_identity(spark):
    """Equal lines at equal offsets of two partitions, and equal lines of a text file, stay apart."""
    line = '1.2.3.4 - - [22/Jan/2019:03:56:16 +0000] "GET /a HTTP/1.1" 200 1 "-" "x"'
    raw = spark.createDataFrame([("t", 0, 5, line), ("t", 1, 5, line), ("t", 1, 6, line)],
                                "topic STRING, partition INT, offset BIGINT, value STRING")
    path, sink, ckpt = (scratch_dir(spark, x) for x in ("t-id", "t-id-sink", "t-id-ckpt"))
    recs = sources.kafka_shape(raw)
    fixture.write_replay(recs, path, redeliver=True)
    dedup.distinct_records(fixture.replay_records(spark, path), sink, ckpt)
    assert sinks.read_appended(spark, sink).count() == 3
    text = scratch_dir(spark, "t-id-text")
    spark.createDataFrame([(line,), (line,), (line.replace("/a", "/b"),)], "value STRING").coalesce(1).write.text(text)
    dedup.distinct_records(sources.text_records(spark, text), f"{sink}-text", f"{ckpt}-text", numbered=False)
    assert sinks.read_appended(spark, f"{sink}-text").count() == 3


def test_late_records_count_and_unusable_ones_are_counted(spark):
    path, sink, ckpt = (scratch_dir(spark, x) for x in ("t-late", "t-late-sink", "t-late-ckpt"))
    fixture.write_replay(_records(spark), path, disorder=True)
    run = jobs.hourly_windows(fixture.replay_records(spark, path), sink, ckpt)
    timed = _rows(spark, "epoch_ms").count()
    assert sinks.read_totals(spark, sink, ["bucket_ms"], "hits").agg({"hits": "sum"}).first()[0] == timed
    assert run.batches == 5 and run.records - run.unusable == timed


def test_append_batch_replay_overwrites_itself(spark):
    root = scratch_dir(spark, "t-app")
    d = spark.createDataFrame([("x",), ("y",)], "k STRING")
    assert sinks.append_batch(d, root, 0)
    assert not sinks.append_batch(d, root, 0)
    assert sinks.append_batch(d, root, 1)
    assert sinks.read_appended(spark, root).count() == 4


def test_key_scan_bounds(spark):
    t = spark.createDataFrame([(k,) for k in ["a1", "a2", "b1", "b2", "c1"]], "rk STRING")
    assert [r[0] for r in sinks.key_scan(t, "rk", "a2", "c").orderBy("rk").collect()] == ["a2", "b1", "b2"]
    assert [r[0] for r in sinks.key_scan(t, "rk", regex="1$").orderBy("rk").collect()] == ["a1", "b1", "c1"]


def test_kafka_columns_become_records(spark):
    """The connector's columns: binary keys and values, nulls, two partitions; a null value is a record without fields."""
    raw = spark.createDataFrame(
        [(None, bytearray(b"a line"), "t", 0, 7), (bytearray(b"k"), None, "t", 1, 7), (None, bytearray("é".encode()), "t", 1, 8)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT").withColumns(
            {"timestamp": F.current_timestamp(), "timestampType": F.lit(0)})
    got = sources.kafka_shape(raw)
    assert [tuple(r) for r in got.collect()] == [("t/0", 7, "a line"), ("t/1", 7, None), ("t/1", 8, "é")]
    assert ", ".join(f"{n} {t.upper()}" for n, t in got.dtypes) == sources.RECORD_SCHEMA


def test_lines_that_repeat_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sources, "PART", 7)
    rows = [("f1", None, "same")] * 100 + [("f2", None, "same")] * 3 + [("f1", None, None)] * 2 + [("t/0", 9, "same"), ("f1", None, "own")]
    got = sources.with_positions(spark.createDataFrame(rows, "source STRING, offset BIGINT, value STRING").repartition(4))
    assert got.columns == ["source", "offset", "value"]
    want = [("f1", i, "same") for i in range(1, 101)] + [("f2", i, "same") for i in (1, 2, 3)] + [("f1", 1, None), ("f1", 2, None), ("t/0", 9, "same"), ("f1", 1, "own")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_kafka_options():
    o = sources.kafka_options("h1:9092,h2:9092", "test", "earliest ")
    assert o["subscribe"] == "test"
    assert o["startingOffsets"] == "earliest"        # trailing space trimmed
    assert o["kafka.bootstrap.servers"] == "h1:9092,h2:9092"


def test_a_larger_replay_deals_each_range_over_several_files_that_are_one_micro_batch(spark, tmp_path, monkeypatch):
    """Ranges of uneven size, empty ones among them: none shares a micro-batch with the next, and no record is lost or doubled."""
    monkeypatch.setattr(fixture, "SLICE_RECORDS", 20)
    recs = spark.range(403).selectExpr("'events' AS source", "if(id < 400, id, id + 1597) AS offset", "concat('line ', id) AS value")
    path, seen = str(tmp_path / "replay"), []
    span = fixture.replay_span(recs)
    assert fixture.replay_slices(span) == 5
    assert fixture.write_replay(recs, path) == 2 * 5
    jobs._run(fixture.replay_records(spark, path, 5), str(tmp_path / "sink"), str(tmp_path / "ckpt"),
              lambda batch, bid: seen.append(sorted(r["offset"] for r in batch.collect())), mode="append")
    assert seen == [list(range(400)), [1997, 1998, 1999]]
