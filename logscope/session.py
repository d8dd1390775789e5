"""Session construction and shared scratch space.

Scratch data (stream sources, sink tables, checkpoints) lives under the shared folder the
cluster names in ``spark.checkpoint.dir``. Where that setting is absent, a local session gets a
folder of its own; on a cluster its absence is an error, as a machine-local folder would be
seen by one machine only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults sized for local tests; on a cluster these come from spark-submit and
# are left alone (``getOrCreate`` keeps an existing session's settings).
_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Running totals per ip / url / agent grow with the key space: RocksDB keeps
    # state off-heap (spilling to local disk) and checkpoints changelogs only.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "logscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="logscope-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh, unique name under the shared folder; what is written there makes the folder."""
    root = _checkpoint_root(spark).rstrip("/")
    if name is None:
        return root
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    for made in _scopes:
        made.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch folders that were made inside it, for jobs whose results are written elsewhere by then."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made under ``scratch_dir`` once its data is no longer read."""
    if not path.startswith(_checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not in this session's scratch space")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
