"""A hot key holding a third of all rows: results stay exact and no row-level step is keyed by it alone."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from logscope.operators import activity, parsing, reports
from logscope.plans.inputs import lines

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot(spark):
    acc = parsing.report_rows(lines(spark, SF_ORACLE), "remote_addr", "epoch_ms", keep=("event_id",))
    return acc.withColumn("remote_addr", F.when(F.col("event_id") % 3 == 0, F.lit("9.9.9.9"))
                          .otherwise(F.col("remote_addr")))


def test_hot_ip_trailing_activity_exact_and_spread(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        acc = _hot(spark)
        out = activity.trailing_activity(acc, {"hits_1d": activity.DAY_MS})
        rows = {r["remote_addr"]: r["hits_1d"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        joins = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
        # the row-level join is keyed by (ip, hour bucket), spreading the hot IP over its hours;
        # the ip-only join reads the hourly table (rows per IP bounded by the hours spanned)
        assert any(ln.count("remote_addr#") == 2 and ln.count("_b#") == 2 for ln in joins), joins
        assert "hashpartitioning(remote_addr#" in plan and "_b#" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    w = Window.partitionBy("remote_addr")
    brute = (acc.withColumn("m", F.max("epoch_ms").over(w))
             .filter(F.col("epoch_ms") >= F.col("m") - activity.DAY_MS)
             .groupBy("remote_addr").count().collect())
    assert rows == {r["remote_addr"]: r["count"] for r in brute}
    assert rows["9.9.9.9"] > 0


def test_hot_ip_counts_exact(spark):
    acc = _hot(spark)
    n_hot = acc.filter(F.col("remote_addr") == "9.9.9.9").count()
    got = {r["remote_addr"]: r["hits"] for r in reports.hits_by(acc, "remote_addr").collect()}
    assert got["9.9.9.9"] == n_hot
    assert sum(got.values()) == acc.count()


def test_hot_value_index_join_is_exact(spark):
    """Heavy values come from a bounded broadcast, all others from a plain join; together they are whole."""
    from logscope.operators import features as FE
    from logscope.plans.inputs import strict

    req = strict(spark, SF_ORACLE).withColumn(
        "url", F.when(F.col("event_id") % 3 == 0, F.lit("/hot")).otherwise(F.concat("url", F.col("event_id").cast("string"))))
    req = req.withColumn("referer", F.when(F.col("event_id") % 5 > 0, F.col("referer")))           # and NULLs
    cols = ["ip", "url", "request_method", "referer", "user_agent"]
    idx = FE.frequency_index(req, cols)
    want = {(r["column"], r["value"]): float(r["freq_index"]) for r in idx.collect()}
    got = FE.apply_index(req, idx, cols)
    rows = got.collect()
    assert len(rows) == req.count()
    assert all(r[c + "_index"] == (want[c, r[c]] if r[c] is not None else None) for r in rows for c in cols)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
