"""ML invariants and physical-plan shape (§5.6)."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscope.operators import cluster, features, geo, reports
from logscope.plans.catalog import all_queries
from logscope.plans.inputs import fields, geo_ranges, lines, strict


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_index_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(f"v{rnd.randint(0, 400)}", rnd.randint(0, 5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "value STRING, g INT").repartition(7)
    counts = df.groupBy("value").agg(F.count(F.lit(1)).alias("hits"))
    got = features.global_index(counts, [F.col("hits").desc(), F.col("value").asc()])
    got = {r["value"]: r["gidx"] for r in got.collect()}
    brute = sorted(((-c, v) for v, c in
                    ((r["value"], r["hits"]) for r in counts.collect())))
    assert got == {v: i for i, (_, v) in enumerate(brute)}


def test_request_clusters_invariants(spark):
    req = strict(spark, SF_SMALL)
    out = cluster.request_clusters(req).select("event_id", "prediction").cache()
    n = req.count()
    assert out.count() == n
    assert out.filter(~F.col("prediction").between(0, cluster.K - 1)).count() == 0
    again = cluster.request_clusters(req).select("event_id", "prediction")
    assert sorted(out.collect()) == sorted(again.collect())          # fixed seed repeats


def test_pca_variance_non_increasing(spark):
    from pyspark.ml.feature import PCA

    feats = features.assemble(features.ip_features(strict(spark, SF_SMALL)), cluster.IP_FEATURES)
    model = PCA(k=2, inputCol="features", outputCol="pca").fit(feats)
    ev = model.explainedVariance.toArray()
    assert ev[0] >= ev[1] >= 0


def test_geo_join_is_hash_join_not_nested_loop(spark):
    ips = lines(spark, SF_SMALL).select(F.explode(F.regexp_extract_all("line", F.lit(r"(\d+\.\d+\.\d+\.\d+)"), 1)).alias("ip"))
    for shuffle in (False, True):
        out = geo.lookup(ips, geo_ranges(spark, SF_SMALL), shuffle=shuffle)
        out.collect()
        assert "NestedLoopJoin" not in _plan(out) and "Cartesian" not in _plan(out)


def test_trailing_activity_combines_before_its_shuffle(spark):
    """No exchange lies below the partial aggregate of the raw rows."""
    from logscope.operators import parsing

    rows = parsing.report_rows(lines(spark, SF_SMALL), "remote_addr", "epoch_ms")
    plan = _plan(rows.groupBy("remote_addr", "epoch_ms").count())
    assert plan.index("Exchange") < plan.rindex("HashAggregate") and plan.count("Exchange") == 1


def test_key_range_is_pushed_to_the_scan(spark):
    from logscope.plans import q_sinks
    from logscope.operators import sinks

    table = q_sinks.keyed_table(spark, SF_SMALL)
    plan = sinks.key_scan(table, "row_key", "10.", "2").where("log_date <= DATE'2024-01-05'") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,10.)" in plan and "LessThan(row_key,2)" in plan
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_json_replies(spark):
    from logscope.operators import geo

    lines_ = ['{"pro": "北京", "city": "x", "ip": "1.2.3.4", "more": [1]}', '{broken', '[]', '{"pro": "", "city": "c", "ip": "2.2.2.2"}',
              '{"pro": "a\\qb", "city": "c", "ip": "3.3.3.3"}', '{"city": "c"}', None]
    got = geo.parse_replies(spark.createDataFrame([(x,) for x in lines_], "line STRING"))
    rows = got.collect()
    assert len(rows) == len(lines_) and [r.bad for r in rows][1] == "{broken"
    assert {(r.pro, r.ips) for r in geo.replies_by_region(got).collect()} == {("北京", 1), ("a qb", 1)}


def test_cluster_profiles_against_duckdb(spark):
    """Sizes, modes, top URLs and the projection, from one written label table."""
    import duckdb
    from logscope.operators import grouped
    from logscope.session import scratch_dir

    path = scratch_dir(spark, "t-labels")
    out = cluster.projection(cluster.request_clusters(strict(spark, SF_SMALL)))
    out.select("event_id", "url", "status", "request_method", "user_agent", "prediction", "x", "y").write.parquet(path)
    table = spark.read.parquet(path)
    con = duckdb.connect()
    src = f"read_parquet('{path.replace('file:', '', 1)}/*.parquet')"
    n, cov, vx, vy = con.execute(f"SELECT count(*), covar_samp(x, y), var_samp(x), var_samp(y) FROM {src}").fetchall()[0]
    assert n == strict(spark, SF_SMALL).count() and abs(cov) <= 1e-3 * (vx * vy) ** 0.5 and vx >= vy
    want = con.execute(f"""SELECT prediction, url, hits, rank FROM (SELECT *, row_number() OVER (PARTITION BY prediction ORDER BY hits DESC, url) AS rank
        FROM (SELECT prediction, url, count(*) AS hits FROM {src} GROUP BY ALL)) WHERE rank <= 5 ORDER BY ALL""").fetchall()
    got = sorted((r.prediction, r.url, r.hits, r["rank"]) for r in grouped.top_k_per_group(table, "prediction", "url", 5).collect())
    assert got == want
    modes = {r.prediction: (r.mode_request_method, r.mode_status, r.mode_user_agent)
             for r in grouped.modes(table, "prediction", ["request_method", "status", "user_agent"]).collect()}
    for p, m, s, a in con.execute(f"""SELECT prediction, {', '.join(f"(SELECT CAST({c} AS VARCHAR) FROM {src} i WHERE i.prediction = o.prediction GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)" for c in ('request_method', 'status', 'user_agent'))}
        FROM (SELECT DISTINCT prediction FROM {src}) o""").fetchall():
        assert modes[p] == (m, s, a)
    assert {r.prediction for r in cluster.profile(table).collect()} == set(modes)


def test_ip_clusters_says_of_every_ip_whether_its_label_is_that_of_the_nearest_centre(spark):
    rows = all_queries()["ip_clusters"].build(spark, SF_SMALL).select("ip", "is_nearest").collect()
    assert {r["ip"] for r in rows} == {r["ip"] for r in strict(spark, SF_SMALL).select("ip").distinct().collect()}
    assert all(r["is_nearest"] for r in rows)


def test_top_k_is_take_ordered(spark):
    plan = _plan(reports.top_n(fields(spark, SF_SMALL, "remote_addr"), 10, "remote_addr"))
    assert "TakeOrderedAndProject" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(reports.hits_by(fields(spark, SF_SMALL, "request_url"), "request_url"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    assert "value:double" not in plan


def test_no_python_evaluation_in_any_batch_query(spark):
    skip = {n for n in all_queries() if n.startswith("stream_")}
    for name, spec in all_queries().items():
        if name in skip or name.startswith("cluster_") or name in (
                "request_clusters", "ip_clusters", "ip_cluster_projection", "sample_points", "sample_ip_points", "scaled_ip_features"):
            continue
        plan = _plan(spec.build(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_strict_regex_evaluated_once_per_line(spark):
    """The nine groups come from one regexp_replace; the filter reads the fenced result."""
    from logscope.operators import parsing

    df = parsing.strict_parse(lines(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert "regexp_extract(" not in plan
