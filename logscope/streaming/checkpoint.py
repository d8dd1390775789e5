"""What a stopped or running query left in its checkpoint: batches, watermarks, state.

The state is read with Spark's ``statestore`` source, the batches' watermarks from the offsets that Spark writes before
a batch runs, so a replayed batch sees the watermark it saw the first time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.operators import sinks

_ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the query finished; -1 if none."""
    fs, p = _path(spark, f"{checkpoint}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def watermark_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark that a batch runs under; 0 before the first."""
    fs, p = _path(spark, f"{checkpoint}/offsets/{batch_id}")
    if batch_id < 0 or not fs.exists(p):
        return 0
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode().split("\n")[1])["batchWatermarkMs"]
    finally:
        stream.close()


def late_before_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """What ends at this time or before is late to a batch: a stateful operator drops it.

    A chain of stateful operators judges lateness by the watermark of the batch before, so that
    what one operator emits as its windows close is not late to the next.
    """
    chained = spark.conf.get(_ALLOW_MULTIPLE, "true").lower() == "true"
    return watermark_ms(spark, checkpoint, batch_id - 1 if chained else batch_id)


def state(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """(key, value, partition_id): the state of one operator after a finished batch, the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)


def audit_totals(spark: SparkSession, checkpoint: str, sink_root: str, keys: list[str], name: str = "hits") -> DataFrame:
    """(keys, state total, sink total): a running total's state next to what its sink holds, at the last finished batch.

    A key that only one side has gets NULL on the other.
    """
    done = last_batch(spark, checkpoint)
    held = state(spark, checkpoint, batch_id=done)
    value = held.schema["value"].dataType.names[0]
    held = held.select(*[F.col(f"key.{k}").alias(k) for k in keys], F.col(f"value.{value}").alias(f"state_{name}"))
    stored = sinks.read_appended(spark, sink_root).where(F.col("batch_id") <= done)
    stored = sinks.latest(stored, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(name).alias(f"sink_{name}"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = held.join(stored, same, "full_outer")
    return both.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], f"state_{name}", f"sink_{name}")
