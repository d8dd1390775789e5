"""Clustering of requests and of IPs, PCA projection and cluster profiles (Spark ML).

KMeans (k-means|| init, distributed Lloyd iterations) persists its input
itself; the seed and column order are fixed so runs repeat exactly.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions.plan import written
from logscope.operators import features as FE
from logscope.operators import grouped

K = 5
SEED = 42
FLAT = 1e-9          # share of the variance up to which a principal component counts as none
REQUEST_COLUMNS = ["ip", "url", "request_method", "referer", "user_agent"]   # fixed order
IP_FEATURES = ["distinct_urls", "distinct_methods", "distinct_user_agents"]


def materialise(df: DataFrame) -> DataFrame:
    """Write the model input once, as columns.

    The scaler fit, the k-means|| initialisation and every Lloyd iteration
    read their input again; without this each pass re-parses the raw log.
    """
    return written(df, "model-input")


def clustering_estimator(inputs: list[str], k: int = K, seed: int = SEED) -> Pipeline:
    """assemble (fixed column order) -> standardise (unit std, no centring) -> KMeans."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
        StandardScaler(inputCol="features", outputCol="scaledFeatures", withMean=False, withStd=True),
        KMeans(featuresCol="scaledFeatures", k=k, seed=seed),
    ])


def indexed_requests(requests: DataFrame) -> DataFrame:
    """Requests with the frequency index of each of the five request columns; nothing else is carried."""
    slim = requests.select(*[c for c in ("event_id", "status", *REQUEST_COLUMNS) if c in requests.columns])
    index = FE.frequency_index(slim, REQUEST_COLUMNS)
    return materialise(FE.apply_index(slim, index, REQUEST_COLUMNS))


def with_nearest(model, clustered: DataFrame, name: str = "is_nearest") -> DataFrame:
    """Whether each row's cluster is that of the nearest centre (ties count), by plain arithmetic."""
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]       # k short vectors
    point = vector_to_array("scaledFeatures")
    far = [sum(((point[i] - F.lit(x)) * (point[i] - F.lit(x)) for i, x in enumerate(c)), F.lit(0.0)) for c in centres]
    own = F.element_at(F.array(*far), F.col("prediction") + 1)
    return clustered.withColumn(name, own <= F.least(*far) + 1e-9 if len(far) > 1 else F.lit(True))


def request_clusters(requests: DataFrame) -> DataFrame:
    """strict parse -> frequency index -> Pipeline(assemble, scale, KMeans k=5)."""
    indexed = indexed_requests(requests)
    inputs = [c + "_index" for c in REQUEST_COLUMNS]
    model = clustering_estimator(inputs).fit(indexed)
    return with_nearest(model, model.transform(indexed))


def ip_clusters(requests: DataFrame) -> DataFrame:
    """per-IP distinct counts -> Pipeline(assemble, scale, KMeans k=5)."""
    feats = materialise(FE.ip_features(requests))
    model = clustering_estimator(IP_FEATURES).fit(feats)
    return with_nearest(model, model.transform(feats))


def sampled(df: DataFrame, key: str = "event_id", one_in: int = 10) -> DataFrame:
    """A repeatable sample: rows whose key's MD5 is 0 modulo ``one_in``."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(digest % one_in == 0)


def projection(clustered: DataFrame, features_col: str = "features") -> DataFrame:
    """PCA to two components of the unscaled features -> x, y columns.

    A component's direction is free; its largest loading is made positive, so results can be compared. A component
    without variance (constant features) has any direction at all; its column is 0.
    """
    model = PCA(k=2, inputCol=features_col, outputCol="pca").fit(clustered)
    loadings = model.pc.toArray()                                          # features times two
    signs = [1.0 if max(column, key=abs) >= 0 else -1.0 for column in loadings.T.tolist()]
    out = model.transform(clustered)
    factors = [sign if share > FLAT else 0.0 for sign, share in zip(signs, model.explainedVariance.toArray().tolist())]
    flat = FE.vector_columns(out.select(*[c for c in out.columns if c not in (features_col, "scaledFeatures")]), "pca", ["x", "y"], digits=None)
    return flat.withColumn("x", F.col("x") * factors[0]).withColumn("y", F.col("y") * factors[1])


def variance(clustered: DataFrame, inputs: list[str], group: str = "prediction") -> DataFrame:
    """(n, within_ss, between_ss) over all rows: how the clusters split the inputs' total sum of squares.

    The clusters' own means are used, so that ``within_ss + between_ss`` is the total, whatever the labels are.
    """
    mean = [F.avg(c).alias(f"_m{i}") for i, c in enumerate(inputs)]
    spread = [F.coalesce(F.var_pop(c), F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(inputs)]
    each = clustered.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), *mean, *spread)          # one row per cluster
    n = F.sum("_n")
    within = sum((F.sum(F.col("_n") * F.col(f"_v{i}")) for i in range(len(inputs))), F.lit(0.0))
    between = sum((F.sum(F.col("_n") * F.col(f"_m{i}") * F.col(f"_m{i}")) - F.pow(F.sum(F.col("_n") * F.col(f"_m{i}")), 2) / n
                   for i in range(len(inputs))), F.lit(0.0))
    return each.agg(n.alias("n"), within.alias("within_ss"), between.alias("between_ss"))


def profile(clustered: DataFrame, group: str = "prediction", k: int = 5) -> DataFrame:
    """Per cluster: modes of method / status / agent and top-k URLs as array<struct>."""
    m = grouped.modes(clustered, group, ["request_method", "status", "user_agent"])
    top = grouped.top_k_per_group(clustered, group, "url", k)
    tops = top.groupBy(group).agg(F.sort_array(F.collect_list(
        F.struct("rank", "url", "hits"))).alias("_t"))
    tops = tops.select(group, F.transform("_t", lambda s: F.struct(s["url"].alias("url"),
                                                                  s["hits"].alias("hits")))
                       .alias("top_urls"))
    return m.join(tops, group, "left")
