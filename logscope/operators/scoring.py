"""Clustering as a stored model: fit once, keep it in the shared folder, score new log rows with it.

A request model is its frequency index (a table) and its fitted pipeline; an IP model is the pipeline alone. A value that the index
does not have, or none at all, gets the number of the values that it has: one past the rarest, the same
for all of them. So every row that is scored gets a cluster, and rows that the model was fitted on get the one they had.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.operators import cluster
from logscope.operators import features as FE


def _folder(folder: str, part: str) -> str:
    return f"{folder.rstrip('/')}/{part}"


def fit_requests(requests: DataFrame, folder: str, k: int = cluster.K, seed: int = cluster.SEED) -> None:
    """Fit a model of requests and keep it in a new ``folder``."""
    columns = cluster.REQUEST_COLUMNS
    slim = requests.select(*columns)
    FE.frequency_index(slim, columns).write.parquet(_folder(folder, "index"))
    indexed = cluster.materialise(index_requests(slim, folder))
    cluster.clustering_estimator([f"{c}_index" for c in columns], k, seed).fit(indexed).save(_folder(folder, "model"))


def index_requests(requests: DataFrame, folder: str) -> DataFrame:
    """``requests`` with a stored model's index of each request column."""
    columns = cluster.REQUEST_COLUMNS
    index = requests.sparkSession.read.parquet(_folder(folder, "index"))
    past = {r["column"]: float(r["n"]) for r in index.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}     # a row per column
    known = FE.apply_index(requests, index, columns)
    return known.withColumns({f"{c}_index": F.coalesce(f"{c}_index", F.lit(past.get(c, 0.0))) for c in columns})


def score_requests(requests: DataFrame, folder: str) -> DataFrame:
    """``requests`` with their indices and ``prediction``, by a stored model."""
    return _scored(index_requests(requests, folder), folder)


def fit_ips(requests: DataFrame, folder: str, k: int = cluster.K, seed: int = cluster.SEED) -> None:
    """Fit a model of IPs, by their requests, and keep it in a new ``folder``."""
    feats = cluster.materialise(FE.ip_features(requests))
    cluster.clustering_estimator(cluster.IP_FEATURES, k, seed).fit(feats).save(_folder(folder, "model"))


def score_ips(requests: DataFrame, folder: str) -> DataFrame:
    """The IPs of ``requests`` with their features and ``prediction``, by a stored model."""
    return _scored(FE.ip_features(requests), folder)


def _scored(rows: DataFrame, folder: str) -> DataFrame:
    return load(rows.sparkSession, folder).transform(rows).drop("features", "scaledFeatures")


def load(spark: SparkSession, folder: str) -> PipelineModel:
    return PipelineModel.read().session(spark).load(_folder(folder, "model"))


def centres(spark: SparkSession, folder: str) -> list[list[float]]:
    """A stored model's centres, in its scaled features."""
    return [[float(x) for x in c] for c in load(spark, folder).stages[-1].clusterCenters()]
