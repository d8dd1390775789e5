"""Windows, per-group statistics, features and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from logscope.operators import activity, cluster, features, grouped, parsing, scoring
from logscope.plans.inputs import fields, lines, strict
from logscope.plans.oracle_sql import having
from logscope.plans.registry import register
from logscope.session import scratch_dir

_LAST_SQL = """
WITH timed AS """ + having("remote_addr", "epoch_ms") + """,
last AS (SELECT remote_addr, max(epoch_ms) AS last_seen_ms FROM timed GROUP BY remote_addr)
SELECT a.remote_addr, l.last_seen_ms, count(*) AS {name}
FROM timed a JOIN last l ON a.remote_addr = l.remote_addr
WHERE a.epoch_ms >= l.last_seen_ms - {span}
GROUP BY a.remote_addr, l.last_seen_ms"""


@register("ip_trailing_1d", _LAST_SQL.format(name="hits_1d", span=activity.DAY_MS))
def ip_trailing_1d(spark, sf):
    """Per IP: hits in the day ending at its latest request."""
    return activity.trailing_activity(fields(spark, sf, "remote_addr", "epoch_ms"), {"hits_1d": activity.DAY_MS})


@register("ip_trailing_3d", _LAST_SQL.format(name="hits_3d", span=3 * activity.DAY_MS))
def ip_trailing_3d(spark, sf):
    """Per IP: hits in the three days ending at its latest request."""
    return activity.trailing_activity(fields(spark, sf, "remote_addr", "epoch_ms"), {"hits_3d": 3 * activity.DAY_MS})


@register("ip_activity_snapshot", f"""
WITH h AS (SELECT remote_addr, CAST(floor(epoch_ms / {activity.HOUR_MS}) * {activity.HOUR_MS} AS BIGINT) AS bucket_ms,
                  count(*) AS hits FROM {having("remote_addr", "epoch_ms")} GROUP BY ALL)
SELECT remote_addr, bucket_ms, hits,
  CAST(sum(hits) OVER (PARTITION BY remote_addr ORDER BY bucket_ms
       RANGE BETWEEN {activity.DAY_MS - activity.HOUR_MS} PRECEDING AND CURRENT ROW) AS BIGINT) AS hits_1d,
  CAST(sum(hits) OVER (PARTITION BY remote_addr ORDER BY bucket_ms
       RANGE BETWEEN {3 * activity.DAY_MS - activity.HOUR_MS} PRECEDING AND CURRENT ROW) AS BIGINT) AS hits_3d
FROM h""")
def ip_activity_snapshot(spark, sf):
    """Per (IP, hour): hits and trailing 24 h / 72 h sums over hourly buckets."""
    return activity.hourly_activity(fields(spark, sf, "remote_addr", "epoch_ms"))


@register("top5_urls_per_group", f"""
WITH c AS (SELECT hour, request_url, count(*) AS hits FROM {having("hour", "request_url")} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY hits DESC, request_url) AS rank FROM c)
SELECT hour, request_url, hits, rank FROM r WHERE rank <= 5""")
def top5_urls_per_group(spark, sf):
    """Top-5 URLs per hour of day."""
    out = grouped.top_k_per_group(fields(spark, sf, "hour", "request_url"), "hour", "request_url", 5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("group_modes", f"""
WITH st AS (SELECT hour, 'request_method' AS col, request_method AS value FROM {having("hour")}
            UNION ALL SELECT hour, 'status', CAST(status AS VARCHAR) FROM {having("hour")}
            UNION ALL SELECT hour, 'http_user_agent', http_user_agent FROM {having("hour")}),
c AS (SELECT hour, col, value, count(*) AS n FROM st WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY hour, col ORDER BY n DESC, value) AS rn FROM c)
SELECT hour,
  max(CASE WHEN col = 'request_method' THEN value END) AS mode_request_method,
  max(CASE WHEN col = 'status' THEN value END) AS mode_status,
  max(CASE WHEN col = 'http_user_agent' THEN value END) AS mode_http_user_agent
FROM r WHERE rn = 1 GROUP BY hour""")
def group_modes(spark, sf):
    """Most frequent method, status and agent per hour of day."""
    columns = ["request_method", "status", "http_user_agent"]
    return grouped.modes(parsing.report_fields(lines(spark, sf), ["hour"], columns), "hour", columns)


_FREQ_COLS = ["ip", "url", "request_method", "referer", "user_agent"]


@register("frequency_index", "WITH st AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value FROM strict" for c in _FREQ_COLS) + """),
c AS (SELECT feature, value, count(*) AS hits FROM st GROUP BY ALL)
SELECT feature, value, hits,
       row_number() OVER (PARTITION BY feature ORDER BY hits DESC, value) - 1 AS freq_index FROM c""")
def frequency_index(spark, sf):
    """Frequency-ordered index (0 = most frequent, ties alphabetical) of each request column."""
    out = features.frequency_index(strict(spark, sf), _FREQ_COLS)
    return out.withColumnRenamed("column", "feature")


_IP_FEATURES_SQL = """
SELECT ip, count(DISTINCT url) AS distinct_urls, count(DISTINCT request_method) AS distinct_methods,
       count(DISTINCT user_agent) AS distinct_user_agents FROM strict GROUP BY ip"""


@register("ip_features", _IP_FEATURES_SQL)
def ip_features(spark, sf):
    """Distinct URLs, methods and agents per IP."""
    return features.ip_features(strict(spark, sf))


@register("scaled_ip_features", f"""
WITH f AS ({_IP_FEATURES_SQL}),
s AS (SELECT stddev_samp(distinct_urls) AS su, stddev_samp(distinct_methods) AS sm,
             stddev_samp(distinct_user_agents) AS sa FROM f)
SELECT ip,
  round(CASE WHEN coalesce(su, 0) = 0 THEN 0 ELSE distinct_urls / su END, 6) AS scaled_urls,
  round(CASE WHEN coalesce(sm, 0) = 0 THEN 0 ELSE distinct_methods / sm END, 6) AS scaled_methods,
  round(CASE WHEN coalesce(sa, 0) = 0 THEN 0 ELSE distinct_user_agents / sa END, 6) AS scaled_user_agents
FROM f, s""")
def scaled_ip_features(spark, sf):
    """Per-IP features divided by their sample standard deviation (StandardScaler)."""
    feats = cluster.materialise(features.ip_features(strict(spark, sf)))   # fit + transform read it
    scaled = features.standardise(features.assemble(feats, cluster.IP_FEATURES))
    out = features.vector_columns(scaled.select("ip", "scaledFeatures"), "scaledFeatures",
                                  ["scaled_urls", "scaled_methods", "scaled_user_agents"])
    return out


# ---- clustering: labels depend on the optimiser's path. What SQL can say of any right result is what enters the model, ----
# ---- how the total variance splits, and the projection; the labels themselves are tested in tests/test_ml_and_plans.py ----

_INDEXED_SQL = "ix AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM strict GROUP BY {c}"
    for c in _FREQ_COLS) + "),\nfeat AS (SELECT s.event_id, s.ip, s.url, " + ", ".join(f"i{n}.i AS f{n}" for n in range(5)) + " FROM strict s " + " ".join(
    f"JOIN ix i{n} ON i{n}.feature = '{c}' AND i{n}.value = s.{c}" for n, c in enumerate(_FREQ_COLS)) + ")"
_IP_FEAT_SQL = "feat AS (SELECT ip, distinct_urls AS f0, distinct_methods AS f1, distinct_user_agents AS f2 FROM (" + _IP_FEATURES_SQL + "))"


def _pca_sql(features: str, n: int, keys: str, where: str = "") -> str:
    """The first two principal axes of f0..f(n-1) by power iteration, the second after deflation, and all rows on them."""
    cells = [(i, j) for i in range(n) for j in range(n)]
    cov = ", ".join(f"covar_samp(f{i}, f{j}) AS c{i}{j}" for i, j in cells)

    def axis(name: str, matrix: str) -> str:
        times = ", ".join(" + ".join(f"c{i}{j} * v{j}" for j in range(n)) + f" AS w{i}" for i in range(n))
        norm = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in range(n)) + ")"
        start, step = ", ".join(f"CAST(1 AS DOUBLE) / {i + 1} AS v{i}" for i in range(n)), ", ".join(f"w{i} / {norm}" for i in range(n))
        return (f"{name}_steps AS (SELECT 0 AS k, {start} UNION ALL SELECT k + 1, {step} FROM "
                f"(SELECT k, {times} FROM {name}_steps, {matrix} WHERE k < 300)), {name} AS (SELECT * FROM {name}_steps WHERE k = 300)")
    value = " + ".join(f"c{i}{j} * v{i} * v{j}" for i, j in cells)
    rest = ", ".join(f"c{i}{j} - l * v{i} * v{j} AS c{i}{j}" for i, j in cells)
    largest = "greatest(" + ", ".join(f"abs(v{i})" for i in range(n)) + ")"
    sign = "CASE " + " ".join(f"WHEN abs(v{i}) = {largest} THEN sign(v{i})" for i in range(n)) + " END"
    on = " + ".join(f"f{i} * v{i}" for i in range(n))
    left, whole = (" + ".join(f"{m}.c{i}{i}" for i in range(n)) for m in ("m2", "m1"))
    return f"""
WITH RECURSIVE {features},
m1 AS (SELECT {cov} FROM feat),
{axis("a1", "m1")},
m2 AS (SELECT {rest} FROM (SELECT *, {value} AS l FROM m1, a1)),
{axis("a2", "m2")}
SELECT {keys}, round((SELECT ({on}) * {sign} FROM a1), 2) AS x,
  round((SELECT CASE WHEN {left} <= {cluster.FLAT} * ({whole}) THEN 0 ELSE ({on}) * {sign} END FROM a2, m1, m2), 2) AS y FROM feat {where}"""


def _points(df, *keys: str):
    return df.select(*keys, F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@register("request_clusters", "WITH " + _INDEXED_SQL + " SELECT event_id, ip, url, " + ", ".join(
    f"CAST(f{n} AS DOUBLE) AS {c}_index" for n, c in enumerate(_FREQ_COLS)) + " FROM feat")
def request_clusters(spark, sf):
    """Request clustering (index, assemble, scale, KMeans k=5): the labelled requests with the indices that the model saw."""
    out = cluster.request_clusters(strict(spark, sf)).where("prediction BETWEEN 0 AND 4")
    return out.select("event_id", "ip", "url", *[f"{c}_index" for c in _FREQ_COLS])


def _variance_sql(n: int, features: str) -> str:
    total = " + ".join(f"var_pop(f{i}) * count(*)" for i in range(n))
    return f"WITH {features} SELECT count(*) AS n, round({total}, 2) AS total_ss FROM feat"


def _total(variance):
    return variance.select("n", F.round(F.col("within_ss") + F.col("between_ss"), 2).alias("total_ss"))


@register("cluster_variance", _variance_sql(5, _INDEXED_SQL))
def cluster_variance(spark, sf):
    """Requests in clusters, and the variance within and between the clusters, which is all there is."""
    return _total(cluster.variance(cluster.request_clusters(strict(spark, sf)), [f"{c}_index" for c in _FREQ_COLS]))


@register("ip_cluster_variance", _variance_sql(3, _IP_FEAT_SQL))
def ip_cluster_variance(spark, sf):
    """IPs in clusters, and the variance within and between the clusters, which is all there is."""
    return _total(cluster.variance(cluster.ip_clusters(strict(spark, sf)), cluster.IP_FEATURES))


@register("cluster_sizes")
def cluster_sizes(spark, sf):
    """Requests per cluster."""
    out = cluster.request_clusters(strict(spark, sf))
    return out.groupBy("prediction").agg(F.count(F.lit(1)).alias("requests"))


@register("ip_clusters", _IP_FEATURES_SQL.replace("count(DISTINCT url)", "true AS is_nearest, count(DISTINCT url)"))
def ip_clusters(spark, sf):
    """IP clustering over per-IP behaviour counts: the labelled IPs, each with its nearest centre's label, and the counts that the model saw."""
    return cluster.ip_clusters(strict(spark, sf)).where("prediction BETWEEN 0 AND 4").select("ip", *cluster.IP_FEATURES, "is_nearest")


@register("cluster_projection", _pca_sql(_INDEXED_SQL, 5, "event_id"))
def cluster_projection(spark, sf):
    """PCA(2) of the unscaled request features, the points that are drawn with their clusters."""
    return _points(cluster.projection(cluster.request_clusters(strict(spark, sf))), "event_id")


@register("ip_cluster_projection", _pca_sql(_IP_FEAT_SQL, 3, "ip"))
def ip_cluster_projection(spark, sf):
    """PCA(2) of the IP features, by IP."""
    return _points(cluster.projection(cluster.ip_clusters(strict(spark, sf))), "ip")


_SAMPLE_SQL = "CAST('0x' || substring(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 0"


@register("sample_points", _pca_sql(_INDEXED_SQL, 5, "event_id, url", "WHERE " + _SAMPLE_SQL.format(key="event_id")))
def sample_points(spark, sf):
    """One in ten of the projected points, by a hash of the request's id."""
    return _points(cluster.sampled(cluster.projection(cluster.request_clusters(strict(spark, sf)))), "event_id", "url")


@register("sample_ip_points", _pca_sql(_IP_FEAT_SQL, 3, "ip", "WHERE " + _SAMPLE_SQL.format(key="ip")))
def sample_ip_points(spark, sf):
    """One in ten of the projected IP points, by a hash of the IP."""
    return _points(cluster.sampled(cluster.projection(cluster.ip_clusters(strict(spark, sf))), "ip"), "ip")


@register("cluster_modes")
def cluster_modes(spark, sf):
    """Most frequent method, status and agent per request cluster."""
    out = cluster.request_clusters(strict(spark, sf))
    return grouped.modes(out, "prediction", ["request_method", "status", "user_agent"])


@register("cluster_top_urls")
def cluster_top_urls(spark, sf):
    """Top-5 URLs per request cluster."""
    out = cluster.request_clusters(strict(spark, sf))
    return grouped.top_k_per_group(out, "prediction", "url", 5)


@register("cluster_profile")
def cluster_profile(spark, sf):
    """Per cluster: modes and top-5 URLs as array<struct<url, hits>>."""
    return cluster.profile(cluster.request_clusters(strict(spark, sf)))


# ---- a stored model: fitted on the first half of the month, scoring all of it; unseen values share the index past the last one ----

_FIRST_HALF = "CAST(substring(time, 1, 2) AS INT) <= 15"
_SEEN_SQL = "seen AS (SELECT * FROM strict WHERE " + _FIRST_HALF + "),\nix AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM seen GROUP BY {c}"
    for c in _FREQ_COLS) + "),\nsize AS (SELECT feature, count(*) AS n FROM ix GROUP BY feature)"


@register("stored_model_scores", "WITH " + _SEEN_SQL + " SELECT s.event_id, " + ", ".join(
    f"CAST(coalesce(i{n}.i, (SELECT n FROM size WHERE feature = '{c}')) AS DOUBLE) AS {c}_index" for n, c in enumerate(_FREQ_COLS))
    + " FROM strict s " + " ".join(f"LEFT JOIN ix i{n} ON i{n}.feature = '{c}' AND i{n}.value = s.{c}" for n, c in enumerate(_FREQ_COLS)))
def stored_model_scores(spark, sf):
    """All requests scored by a request model that was fitted on the first half of the month and stored."""
    folder = scratch_dir(spark, "request-model")
    requests = strict(spark, sf)
    scoring.fit_requests(requests.where(_FIRST_HALF), folder)
    scored = scoring.score_requests(requests.select("event_id", *_FREQ_COLS), folder).where("prediction BETWEEN 0 AND 4")
    return scored.select("event_id", *[f"{c}_index" for c in _FREQ_COLS])


@register("stored_ip_model_scores", _IP_FEATURES_SQL)
def stored_ip_model_scores(spark, sf):
    """All IPs scored by an IP model that was fitted on the first half of the month and stored."""
    folder = scratch_dir(spark, "ip-model")
    requests = strict(spark, sf)
    scoring.fit_ips(requests.where(_FIRST_HALF), folder)
    return scoring.score_ips(requests, folder).where("prediction BETWEEN 0 AND 4").select("ip", *cluster.IP_FEATURES)
