"""Event-time windows that close: each is emitted once, its state goes, and late records are corrections.

A window's count is kept in the state store until the watermark passes its end; then it is emitted, once, and its
state is dropped, so the state holds the windows of the last ``delay`` only, however long the stream runs.
A record that comes after its window closed would be lost by that. Here the same query also hands each
micro-batch's own records on, and those behind the watermark are counted into a correction of that batch. So

    closed + late + open = all records

holds at every finished batch: ``closed`` and ``late`` come from the sink, ``open`` from the state. The price is that a
micro-batch's records are read twice, for their keys and times alone; only counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.operators import sinks
from logscope.streaming import checkpoint as ck
from logscope.streaming import jobs

HOUR_MS = 3_600_000
CLOSED, LATE, OPEN = "closed", "late", "open"


def event_windows(records: DataFrame, sink_root: str, checkpoint: str, keys: tuple[str, ...] = (), width_ms: int = HOUR_MS,
                  delay: str = "1 hour", trigger: dict | None = None, state_partitions: int | None = None) -> jobs.StreamRun:
    """Hits per (keys, window of ``width_ms``): closed windows and corrections go to the sink.

    Sink rows are (kind, keys, window_start_ms, hits); a window has one ``closed`` row and as many ``late`` ones as
    batches brought records for it after it closed.
    """
    spark, size = records.sparkSession, f"{width_ms} milliseconds"
    rows = jobs.parsed(records, *keys, "epoch_ms").withColumn("_at", F.timestamp_millis("epoch_ms")).withWatermark("_at", delay)
    start = (F.floor(F.col("epoch_ms") / width_ms) * width_ms).cast("bigint")
    closed = rows.groupBy(F.window("_at", size).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("hits")) \
        .select(F.lit(CLOSED).alias("kind"), *keys, F.unix_millis("_w.start").alias("window_start_ms"), "hits")
    # Every record of the batch, without a shuffle; which of them are late is known when the batch runs.
    own = rows.select(F.lit(LATE).alias("kind"), *keys, start.alias("window_start_ms"), F.lit(1).cast("bigint").alias("hits"))

    def per_batch(batch: DataFrame, bid: int) -> None:
        late = ck.late_before_ms(spark, checkpoint, bid)
        wanted = (F.col("kind") == CLOSED) | (F.col("window_start_ms") + width_ms <= late)
        counts = batch.where(wanted).groupBy("kind", *keys, "window_start_ms").agg(F.sum("hits").alias("hits"))
        sinks.append_batch(counts, sink_root, bid)

    return jobs._run(closed.unionByName(own), sink_root, checkpoint, per_batch, mode="append", trigger=trigger,
                     state_partitions=state_partitions)


def read_event_windows(spark: SparkSession, sink_root: str, checkpoint: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, window_start_ms, closed_hits, late_hits, open_hits, hits) at the last batch that the query finished."""
    done = ck.last_batch(spark, checkpoint)
    stored = sinks.read_appended(spark, sink_root).where(F.col("batch_id") <= done).select("kind", *keys, "window_start_ms", "hits")
    held = ck.state(spark, checkpoint, batch_id=done)
    names, window = held.schema["key"].dataType.names, held.schema["key"].dataType.names[0]
    still = held.select(F.lit(OPEN).alias("kind"), *[F.col(f"key.`{n}`").alias(k) for n, k in zip(names[1:], keys)],
                        F.unix_millis(F.col(f"key.`{window}`.start")).alias("window_start_ms"),
                        F.col("value")[held.schema["value"].dataType.names[0]].alias("hits"))

    def of(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("hits"))), F.lit(0)).cast("bigint").alias(f"{kind}_hits")
    return stored.unionByName(still).groupBy(*keys, "window_start_ms").agg(
        of(CLOSED), of(LATE), of(OPEN), F.sum("hits").cast("bigint").alias("hits"))


def merge_windows(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """For ``sinks.fold``: one row per (kind, keys, window)."""
    return rows.groupBy("kind", *keys, "window_start_ms").agg(F.sum("hits").cast("bigint").alias("hits"), F.max("batch_id").alias("batch_id"))
