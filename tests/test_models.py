"""Clusters, projections and stored models against plain arithmetic; frequent keys by bounded summaries."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscope.operators import cluster, heavy, reports, scoring, sinks
from logscope.plans.catalog import all_queries
from logscope.plans.inputs import fields, strict
from logscope.session import scratch_dir


@pytest.fixture(scope="module")
def labelled(spark):
    """{name: (points as the model saw them, labels, DataFrame)} of both models."""
    out = {}
    for name, made in (("requests", cluster.request_clusters(strict(spark, SF_SMALL))), ("ips", cluster.ip_clusters(strict(spark, SF_SMALL)))):
        rows = made.select(vector_to_array("scaledFeatures").alias("x"), "prediction", "is_nearest").collect()
        out[name] = (np.array([r["x"] for r in rows]), np.array([r["prediction"] for r in rows]), [r["is_nearest"] for r in rows], made)
    return out


def _inertia(x, labels):
    return sum(((x[labels == c] - x[labels == c].mean(0)) ** 2).sum() for c in set(labels.tolist()))


@pytest.mark.parametrize("name", ["requests", "ips"])
def test_labels_are_as_good_as_those_of_plain_restarts(labelled, name):
    x, labels, nearest, _ = labelled[name]
    assert all(nearest) and set(labels.tolist()) == set(range(cluster.K))
    rng, best = np.random.default_rng(1), None
    for _ in range(20):
        centres = x[rng.choice(len(x), cluster.K, replace=False)]
        for _ in range(50):
            own = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
            centres = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(cluster.K)])
        best = min(best or np.inf, _inertia(x, own))
    assert _inertia(x, labels) <= 1.35 * best


@pytest.mark.parametrize("name", ["requests", "ips"])
def test_variance_splits_into_within_and_between(labelled, name):
    _, labels, _, made = labelled[name]
    inputs = [f"{c}_index" for c in cluster.REQUEST_COLUMNS] if name == "requests" else cluster.IP_FEATURES
    x = np.array([[float(r[c]) for c in inputs] for r in made.select(*inputs).collect()])
    r = cluster.variance(made, inputs).first()
    assert r["n"] == len(x) and np.isclose(r["within_ss"], _inertia(x, labels)) and r["between_ss"] > 0
    assert np.isclose(r["within_ss"] + r["between_ss"], ((x - x.mean(0)) ** 2).sum())


@pytest.mark.parametrize("name", ["requests", "ips"])
def test_projection_is_the_principal_plane(labelled, name):
    made = labelled[name][3]
    x = np.array([r["v"] for r in made.select(vector_to_array("features").alias("v")).collect()])
    got = np.array([[r["x"], r["y"]] for r in cluster.projection(made).select("x", "y").collect()])
    values, axes = np.linalg.eigh(np.cov(x.T))
    for i in (0, 1):
        if values[-1 - i] <= cluster.FLAT * values.sum():
            assert not got[:, i].any()
            continue
        axis = axes[:, -1 - i]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose(np.sort(got[:, i]), np.sort(x @ axis), atol=1e-5)
        assert np.isclose(got[:, i].var(ddof=1), values[-1 - i], rtol=1e-4)
    assert abs(np.cov(got.T)[0, 1]) < 1e-3


def test_profile_agrees_with_the_labels(spark, labelled):
    made = labelled["requests"][3]
    rows = made.select("prediction", "url", "request_method", "status", "user_agent").collect()
    for r in cluster.profile(made).collect():
        mine = [x for x in rows if x["prediction"] == r["prediction"]]
        for column in ("request_method", "status", "user_agent"):
            counts = Counter(str(x[column]) for x in mine)
            assert r[f"mode_{column}"] == min(counts, key=lambda v: (-counts[v], v))
        urls = Counter(x["url"] for x in mine)
        assert [(u["url"], u["hits"]) for u in r["top_urls"]] == sorted(urls.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    sizes = Counter(x["prediction"] for x in rows)
    assert {r["prediction"]: r["requests"] for r in all_queries()["cluster_sizes"].build(spark, SF_SMALL).collect()} == sizes


@pytest.mark.parametrize("query", ["cluster_projection", "ip_cluster_projection"])
def test_the_plan_of_a_projection_holds_the_projection(spark, query):
    assert "pca" in all_queries()[query].build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- stored models

def test_a_stored_model_gives_its_own_rows_their_labels(spark):
    requests = strict(spark, SF_SMALL)
    for fit, score, fresh, key in ((scoring.fit_requests, scoring.score_requests, cluster.request_clusters, "event_id"),
                                   (scoring.fit_ips, scoring.score_ips, cluster.ip_clusters, "ip")):
        folder = scratch_dir(spark, "t-model")
        fit(requests, folder)
        want = {r[0]: r[1] for r in fresh(requests).select(key, "prediction").collect()}
        assert {r[0]: r[1] for r in score(requests, folder).select(key, "prediction").collect()} == want
        assert len(scoring.centres(spark, folder)) == cluster.K


def test_unseen_values_have_a_defined_index_and_a_cluster(spark):
    requests, folder = strict(spark, SF_SMALL), scratch_dir(spark, "t-unseen")
    scoring.fit_requests(requests, folder)
    one = requests.limit(1).collect()[0]
    rows = [(one["ip"], one["url"], one["request_method"], one["referer"], one["user_agent"]),
            ("new", "new", "new", "new", "new"), ("newer", "newer", None, None, "newer"), (one["ip"], "new", "GET", "-", None)]
    got = scoring.score_requests(spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in cluster.REQUEST_COLUMNS)), folder).collect()
    past = {c: requests.select(c).distinct().count() for c in cluster.REQUEST_COLUMNS}
    assert len(got) == 4 and all(0 <= r["prediction"] < cluster.K for r in got)
    for r in got:
        for c in cluster.REQUEST_COLUMNS:
            assert (r[f"{c}_index"] == past[c]) == (r[c] in (None, "new", "newer")) and r[f"{c}_index"] <= past[c]


# ---------------------------------------------------------------- frequent keys

def _summaries(spark, batches, slots):
    root = scratch_dir(spark, "t-heavy")
    for bid, keys in enumerate(batches):
        counts = reports.hits_by(spark.createDataFrame([(k,) for k in keys], "k STRING"), "k")
        sinks.append_batch(heavy.summary(counts, "k", slots), root, bid)
    return root


@pytest.mark.parametrize("slots", [3, 60, 1000])
def test_frequent_keys_of_many_batches_are_exact(spark, slots):
    rng = random.Random(slots)
    batches = [[f"k{min(int(rng.paretovariate(0.7)), 400) + (b % 3 if rng.random() < 0.3 else 0)}" for _ in range(600)] for b in range(4)] + [[]]
    true = Counter(k for b in batches for k in b)
    want = sorted(true.items(), key=lambda kv: (-kv[1], kv[0]))[:8]
    root = _summaries(spark, batches, slots)
    log = spark.createDataFrame([(k,) for b in batches for k in b], "k STRING")
    for folded in (False, True):
        table = sinks.read_appended(spark, root)
        assert table.count() <= len(batches) * (slots + 1)
        found, complete = heavy.candidates(table, "k", 8)
        ends = {r["k"]: (r["at_least"], r["at_most"]) for r in found.collect()}
        assert all(low <= true[k] <= high for k, (low, high) in ends.items())
        assert complete or slots == 3
        if complete:
            assert {k for k, _ in want} <= ends.keys() and (slots == 1000 or len(ends) < len(true))
        assert [(r["k"], r["hits"]) for r in heavy.top_n(table, log, "k", 8).collect()] == want
        if not folded:
            sinks.fold(spark, root, merge=lambda rows: heavy.merge(rows, "k"))


def test_no_keys_and_fewer_keys_than_asked_for(spark):
    empty = spark.createDataFrame([], "k STRING")
    assert heavy.top_n(sinks.read_appended(spark, _summaries(spark, [[], []], 5)), empty, "k", 3).count() == 0
    few = [["a", "b", "a"]]
    log = spark.createDataFrame([(k,) for k in few[0]], "k STRING")
    assert [tuple(r) for r in heavy.top_n(sinks.read_appended(spark, _summaries(spark, few, 50)), log, "k", 3).collect()] == [("a", 2), ("b", 1)]


def test_the_recount_reads_candidates_only(spark):
    log = fields(spark, SF_SMALL, "request_url")
    root = scratch_dir(spark, "t-urls")
    sinks.append_batch(heavy.summary(reports.hits_by(log, "request_url"), "request_url", 400), root, 0)
    out = heavy.top_n(sinks.read_appended(spark, root), log, "request_url", 5)
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.collect() == reports.top_n(log, 5, "request_url").collect()
    assert out.select(F.sum("hits")).first()[0] > 0
