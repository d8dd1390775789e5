"""Each record once, with bounded state and without a pass over everything that is stored.

* *Near* redelivery is dropped by the state store: ``dropDuplicatesWithinWatermark`` on the row key, under a watermark
  on the time of *arrival*. A key leaves the state when it has been there for ``near``; as
  every record arrives now, none is ever late, however old its own time is.
* *Older* redelivery passes the state and is dropped by an anti-join with the stored keys. Only the log dates that the
  micro-batch has are read: the table is partitioned by date and a redelivered record has its date again.
* A record that was written less than ``near / 2`` ago by its own clock cannot be an older redelivery: it would have to have arrived
  before it was written, or the clocks to be ``near / 2`` apart. It is not looked for, so that a live stream reads stored keys for its few
  late records only, not the keys of the whole day for every micro-batch.

The state has a key for every record of the last ``near``: it is kept in RocksDB, off the heap, whatever the session's store is.

So the sink holds distinct records only, and reading it needs no deduplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import sinks
from logscope.streaming import jobs
from logscope.streaming.sources import with_positions

DAYS = 366          # so many dates of a batch are named one by one; beyond that a range of dates is read


def _keyed(rows: DataFrame, line: str) -> DataFrame:
    key = P.row_key("remote_addr", "time_local", line, "source", "offset")
    return rows.select(key.alias("row_key"), "source", "offset", P.log_date().alias("log_date"), "epoch_ms")


def _dates(batch: DataFrame) -> Column | None:
    """A predicate on ``log_date`` that all rows of a batch satisfy; None for an empty batch."""
    days = [r["log_date"] for r in batch.select("log_date").distinct().limit(DAYS + 1).collect()]
    if not days:
        return None
    if len(days) <= DAYS:
        return F.col("log_date").isin([d for d in days if d is not None]) | (F.lit(None in days) & F.col("log_date").isNull())
    low, high = batch.agg(F.min("log_date"), F.max("log_date")).first()
    return F.col("log_date").between(low, high) | F.col("log_date").isNull()


def unseen(batch: DataFrame, sink_root: str) -> DataFrame:
    """The rows of a batch whose key the sink does not hold."""
    stored = sinks.read_appended(batch.sparkSession, sink_root)
    dates = None if stored is None else _dates(batch)
    if dates is None:
        return batch
    held = stored.where(dates).select(F.col("log_date").alias("_date"), F.col("row_key").alias("_key"))
    return batch.join(held, F.col("log_date").eqNullSafe(F.col("_date")) & (F.col("row_key") == F.col("_key")), "left_anti")


def distinct_records(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None, near_ms: int = 3_600_000,
                     numbered: bool = True, state_partitions: int | None = None) -> jobs.StreamRun:
    """Append every record once to a table (row_key, source, offset), partitioned by ``log_date``.

    ``numbered`` records have an offset. Lines of tailed files have none; they get their places per micro-batch
    (``with_positions``) and are told from stored ones alone.
    """
    rows = jobs.parsed(records.withColumn("line", F.col("value")), "remote_addr", "time_local", "epoch_ms",
                       keep=("source", "offset", "line"))
    if numbered:
        rows = _keyed(rows, "line").withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{near_ms} milliseconds") \
            .dropDuplicatesWithinWatermark(["row_key"])
        rows = rows.withColumn("_recent", F.col("epoch_ms") > F.unix_millis("_arrived") - near_ms // 2)

    def per_batch(batch: DataFrame, bid: int) -> None:
        if not numbered:
            batch = _keyed(with_positions(batch.withColumnRenamed("line", "value")), "value").dropDuplicates(["row_key"]) \
                .withColumn("_recent", F.lit(False))
        columns = ["row_key", "source", "offset", "log_date"]
        # Read more than once (its dates, its rows); without this its state would be computed as often.
        batch = batch.select(*columns, "_recent").persist()
        try:
            old = unseen(batch.where("NOT _recent").select(*columns), sink_root)
            fresh = batch.where("_recent").select(*columns).unionByName(old).hint("rebalance", "log_date")
            sinks.append_batch(fresh, sink_root, bid, **sinks.LOG_LAYOUT)
        finally:
            batch.unpersist()
    return jobs._run(rows, sink_root, checkpoint, per_batch, mode="append", trigger=trigger, state_partitions=state_partitions,
                     state_store=jobs.ROCKSDB)
