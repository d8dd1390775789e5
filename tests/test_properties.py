"""Invariants over the fixture and anchors from FIXTURES.md §7."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from logscope.operators import activity, parsing, reports
from logscope.plans.inputs import access, lines, strict


def test_fixture_anchor_counts(spark):
    ln = lines(spark, SF_ORACLE)
    assert ln.count() == 10_000
    assert parsing.filter_min_length(ln).count() == 9_896
    assert 0 < strict(spark, SF_ORACLE).count() < 9_798
    n = 10_000
    short = ln.filter(F.length("line") <= 10).count()
    # Independent of the parser: the fixture's rule for a status is a usable line with any request.
    usable = ln.where("event_id % 97 <> 0 AND event_id % 101 <> 0").count()
    assert short + parsing.filter_min_length(ln).count() == n
    assert parsing.report_rows(ln, "status").count() == parsing.report_rows(ln, "remote_addr").count() == usable
    assert access(spark, SF_ORACLE).count() == usable
    no_request = ln.where("event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 23 = 0").count()
    assert parsing.report_rows(ln, "request_url").count() == usable - no_request
    no_agent = ln.where("event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 37 = 0").count()
    assert parsing.report_rows(ln, "http_user_agent").count() == usable - no_agent


def test_sum_of_counts_equals_valid_lines(spark):
    acc = access(spark, SF_SMALL)
    n = acc.count()
    for key in ["remote_addr", "status", "hour"]:
        assert reports.hits_by(acc, key).agg(F.sum("hits")).first()[0] == n


def test_parsed_plus_quarantined_is_all_lines(spark):
    ln = lines(spark, SF_SMALL)
    assert parsing.access_table(ln).count() + parsing.quarantine(ln).count() == ln.count()


def test_unique_ips_at_most_hits_per_hour(spark):
    acc = access(spark, SF_SMALL)
    u = reports.unique_ips_by_hour(acc)
    h = reports.hits_by_hour(acc)
    bad = u.join(h, "hour").filter(F.col("unique_ips") > F.col("hits")).count()
    assert bad == 0


def test_trailing_1d_at_most_3d(spark):
    t = activity.trailing_activity(access(spark, SF_SMALL))
    assert t.filter(F.col("hits_1d") > F.col("hits_3d")).count() == 0
    assert t.filter(F.col("hits_1d") < 1).count() == 0


def test_totals_invariant_under_repartitioning(spark):
    acc = access(spark, SF_SMALL)
    a = sorted(reports.hits_by(acc, "remote_addr").collect())
    b = sorted(reports.hits_by(acc.repartition(3, "request_url"), "remote_addr").collect())
    assert a == b


def test_trailing_activity_matches_window_form(spark):
    """The join-based trailing count equals a per-IP range window at the latest row."""
    from pyspark.sql import Window

    acc = access(spark, SF_SMALL)
    w = Window.partitionBy("remote_addr").orderBy("epoch_ms").rangeBetween(-activity.DAY_MS, 0)
    last = Window.partitionBy("remote_addr")
    brute = (acc.select("remote_addr", "epoch_ms", F.count(F.lit(1)).over(w).alias("c"),
                        F.max("epoch_ms").over(last).alias("m"))
             .filter(F.col("epoch_ms") == F.col("m"))
             .groupBy("remote_addr").agg(F.max("c").alias("hits_1d")))
    ours = activity.trailing_activity(acc, {"hits_1d": activity.DAY_MS}).select("remote_addr", "hits_1d")
    assert sorted(brute.collect()) == sorted(ours.collect())
