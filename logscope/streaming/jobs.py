"""Structured Streaming jobs: running totals, distinct visitors, hourly counts, ETL.

Every job reads ``(source, offset, value)`` records, parses only the fields it reports by the
batch path's expressions, and writes through the ``batch_id``-guarded sinks from
``foreachBatch``, so that a restarted query (offsets and state in ``checkpointLocation``) never
counts twice. No job here has a watermark: a late record counts like any other. What must not grow
in the state store is kept out of it: hourly counts and bitmaps of visitors are stateless per micro-batch and
come together in the sink. Records without the fields of a report are counted, not just dropped
(``StreamRun.unusable``).

Jobs with a watermark have modules of their own: ``windows`` (windows that close, late records as
corrections), ``dedup`` (each record once) and ``trailing`` (activity per client).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import distinct, heavy, parsing, reports, sinks
from logscope.streaming.sources import with_positions

HOUR_MS = 3_600_000
_OBSERVED = "records"


@dataclass
class StreamRun:
    sink_root: str
    checkpoint: str
    batches: int
    records: int = 0         # of the progress reports that the query keeps
    unusable: int = 0        # those of them without the report's fields
    state_rows: int = 0      # the most rows that the state held after a batch


def parsed(records: DataFrame, *fields: str, keep=()) -> DataFrame:
    """Records -> the named fields, of those that have all; how many have not is observed."""
    rows = parsing.report_fields(records, [], [*fields, "tokens"], line="value", keep=keep, all_lines=True)
    if fields == ("hour",):      # this report asks for enough tokens instead of another field
        rows = rows.withColumn("hour", F.when(F.col("tokens") > P.MIN_LINE_TOKENS, F.col("hour")))
    rows = rows.drop("tokens")
    missing = " OR ".join(f"{f} IS NULL" for f in fields)
    counted = rows.observe(_OBSERVED, F.count(F.lit(1)).alias("records"),
                           F.count(F.expr(f"CASE WHEN {missing} THEN 1 END")).alias("unusable"))
    return counted.dropna(subset=list(fields))


STATE_PARTITIONS_CONF = "spark.sql.shuffle.partitions"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, spark: SparkSession, state_partitions: int | None, state_store: str | None):
    """Start ``writer``; a new query gets ``state_partitions`` state-store partitions and the named state store.

    Stateful operators take their partition count from
    ``spark.sql.shuffle.partitions`` when a checkpoint is first created and keep
    it for life, as they do the store (both are stored in the checkpoint). They are
    applied only while the query starts; the session's values are restored right after.
    """
    wanted = {STATE_PARTITIONS_CONF: state_partitions and str(state_partitions), STATE_STORE_CONF: state_store}
    wanted = {k: v for k, v in wanted.items() if v}
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _run(df: DataFrame, sink_root: str, checkpoint: str, batch_fn, mode: str = "update",
         trigger: dict | None = None, state_partitions: int | None = None, state_store: str | None = None) -> StreamRun:
    """Start a foreachBatch query and wait for it.

    Default trigger is ``availableNow`` (drain what is there, then stop); pass
    ``{"processingTime": "1 second"}`` for the reference's fixed 1 s cadence.
    """
    run = StreamRun(sink_root, checkpoint, 0)

    def wrapped(batch: DataFrame, batch_id: int) -> None:
        batch_fn(batch, batch_id)
        run.batches += 1

    writer = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(wrapped))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    q = _start(writer, df.sparkSession, state_partitions, state_store)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    for progress in q.recentProgress:
        run.state_rows = max(run.state_rows, sum(op.numRowsTotal for op in progress.stateOperators))
        seen = progress.observedMetrics.get(_OBSERVED)
        if seen is not None:
            run.records, run.unusable = run.records + seen["records"], run.unusable + seen["unusable"]
    return run


def start(df: DataFrame, checkpoint: str, batch_fn, mode: str = "update",
          interval: str = "1 second"):
    """Long-running form: a fixed processing-time trigger (the reference's 1 s cadence).

    Returns the ``StreamingQuery``; offsets and state are recovered from
    ``checkpoint`` on restart, and the batch_id-guarded sinks make the replayed
    batch after a failure harmless.
    """
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(batch_fn).trigger(processingTime=interval).start())


def console_preview(df: DataFrame, checkpoint: str, sort_by: list | None = None, n: int = 10,
                    mode: str = "complete"):
    """Debug sink: print the first ``n`` rows of every micro-batch (sorted when asked)."""
    out = df.orderBy(*sort_by) if sort_by else df
    return (out.writeStream.outputMode(mode).format("console").option("numRows", n)
            .option("truncate", False).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def running_totals(records: DataFrame, keys: list[str], sink_root: str, checkpoint: str,
                   name: str = "hits", trigger: dict | None = None,
                   state_partitions: int | None = None) -> StreamRun:
    """Total per key since the stream started (state store) -> keyed upsert sink."""
    agg = parsed(records, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return _run(agg, sink_root, checkpoint, lambda b, bid: sinks.upsert_latest(b, sink_root, keys, bid),
                trigger=trigger, state_partitions=state_partitions)


def unique_ips_by_hour(records: DataFrame, sink_root: str, checkpoint: str,
                       state_partitions: int | None = None, trigger: dict | None = None) -> StreamRun:
    """True distinct IPs per hour: dedup (ip, hour) in state, then count per hour."""
    pairs = parsed(records, "remote_addr", "hour").dropDuplicates(["remote_addr", "hour"])
    agg = pairs.groupBy("hour").agg(F.count(F.lit(1)).alias("unique_ips"))
    return _run(agg, sink_root, checkpoint, lambda b, bid: sinks.upsert_latest(b, sink_root, ["hour"], bid),
                trigger=trigger, state_partitions=state_partitions)


def unique_ips_batch_sum(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None) -> StreamRun:
    """The reference's literal report: Σ over micro-batches of per-batch distinct IPs per hour."""
    def per_batch(batch: DataFrame, bid: int) -> None:
        sinks.upsert_accumulate(reports.unique_ips_by_hour(batch), sink_root, ["hour"], "unique_ips", bid)
    return _run(parsed(records, "remote_addr", "hour"), sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def unique_ips_bitmaps(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None) -> StreamRun:
    """True distinct IPs per hour without state: each micro-batch appends bitmaps, which unite on reading and in ``fold``."""
    def per_batch(batch: DataFrame, bid: int) -> None:
        sinks.append_batch(distinct.bitmaps(batch, "hour"), sink_root, bid)
    return _run(parsed(records, "remote_addr", "hour"), sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def batch_top_n(records: DataFrame, key: str, n_top: int, sink_root: str, checkpoint: str,
                trigger: dict | None = None) -> StreamRun:
    """Stateless ranking of each micro-batch, appended with its batch_id."""
    def per_batch(batch: DataFrame, bid: int) -> None:
        sinks.append_batch(reports.top_n(batch, n_top, key), sink_root, bid)
    return _run(parsed(records, key), sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def heavy_hitters(records: DataFrame, key: str, sink_root: str, checkpoint: str, trigger: dict | None = None,
                  slots: int = heavy.SLOTS) -> StreamRun:
    """A summary of each micro-batch's frequent keys, which add up to the candidates for the most frequent ones of all."""
    def per_batch(batch: DataFrame, bid: int) -> None:
        counts = reports.hits_by(batch, key).persist()
        try:
            sinks.append_batch(heavy.summary(counts, key, slots), sink_root, bid)
        finally:
            counts.unpersist()
    return _run(parsed(records, key), sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def access_etl(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None) -> StreamRun:
    """Parse each micro-batch once (persist), write the keyed, date-partitioned access rows and the quarantine."""
    def per_batch(batch: DataFrame, bid: int) -> None:
        split = parsing.split_parse(with_positions(batch), line="value", keep=("source", "offset")).persist()
        try:
            key = P.row_key("remote_addr", "time_local", "value", "source", "offset")
            good = split.filter(F.col("reject").isNull()).select("source", "offset", key.alias("row_key"), *parsing.ACCESS_COLUMNS,
                                                                 P.log_date().alias("log_date")).hint("rebalance", "log_date")
            bad = split.filter(F.col("reject").isNotNull()).select(
                "source", "offset", "value", F.col("reject").alias("reason"))
            sinks.append_batch(good, f"{sink_root}/access", bid, **sinks.LOG_LAYOUT)
            sinks.append_batch(bad, f"{sink_root}/quarantine", bid)
        finally:
            split.unpersist()
    return _run(records, sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def hourly_windows(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None) -> StreamRun:
    """Hits per event-time hour: each micro-batch's counts are added up in the sink, however late they come."""
    return _hourly(records, [], sink_root, checkpoint, trigger)


def ip_hourly_counts(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None) -> StreamRun:
    """Hits per (ip, event-time hour), the compact table that trailing activity is computed on."""
    return _hourly(records, ["remote_addr"], sink_root, checkpoint, trigger)


def _hourly(records: DataFrame, keys: list[str], sink_root: str, checkpoint: str, trigger: dict | None) -> StreamRun:
    def per_batch(batch: DataFrame, bid: int) -> None:
        counts = reports.hits_by(batch, *keys, "bucket_ms")
        sinks.upsert_accumulate(counts, sink_root, [*keys, "bucket_ms"], "hits", bid)
    rows = parsed(records, *keys, "epoch_ms").withColumn(
        "bucket_ms", (F.floor(F.col("epoch_ms") / HOUR_MS) * HOUR_MS).cast("bigint"))
    return _run(rows, sink_root, checkpoint, per_batch, mode="append", trigger=trigger)


def read_latest(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The table a running-total job maintains (newest value per key)."""
    cur = sinks.read_latest(spark, root, keys)
    if cur is None:
        raise RuntimeError(f"nothing committed under {root}")
    return cur


def read_totals(spark: SparkSession, root: str, keys: list[str], value: str) -> DataFrame:
    """The table an accumulating job maintains (summed deltas per key)."""
    cur = sinks.read_totals(spark, root, keys, value)
    if cur is None:
        raise RuntimeError(f"nothing committed under {root}")
    return cur
