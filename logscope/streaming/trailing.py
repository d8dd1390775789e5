"""Trailing per-client activity as a streaming result, with keyed state of a bounded size.

For each client the state holds the time of its latest request and, per hour of the last three days, the number of
its requests and their times with counts. A record moves the client's window; hours that fall out of it are removed
at once, by the client's own clock, so a record that comes late counts exactly if it is still inside the
window and not at all if it is not. That is what the batch report says of the same records.

A client that sends nothing for ``idle`` of arrival time loses its state by a timer; its last result stays in the
sink. Equal (client, time) pairs are counted per task before the shuffle, so a client with a third of all rows sends
one row per second and task to its state.

A processor with several states needs column families, which of Spark's stores only RocksDB has; the query asks for it,
whatever the session's store is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logscope.operators import sinks
from logscope.operators.activity import DAY_MS, HOUR_MS, TRAILING_SPANS
from logscope.streaming import jobs

IDLE_MS = 30 * DAY_MS
_TIME, _COUNT = "<i8", "<i8"

# The processor travels whole: Python workers, that on the driver included, need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal (client, time) pairs of a batch as one row with their number."""
    for batch in batches:
        if len(batch):
            both = pa.Table.from_batches([batch]).group_by(["remote_addr", "epoch_ms"]).aggregate([("hits", "sum")])
            yield from both.select(["remote_addr", "epoch_ms", "hits_sum"]).rename_columns(["remote_addr", "epoch_ms", "hits"]).to_batches()


class TrailingProcessor(StatefulProcessor):
    """Latest request and hits of the trailing spans of one client."""

    def __init__(self, spans: dict[str, int], idle_ms: int):
        self.spans, self.idle_ms = spans, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_ms LONG, timer_ms LONG")
        self.hours = handle.getMapState("hours", "hour LONG", "total LONG, times BINARY, counts BINARY")

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        ts = np.concatenate([f["epoch_ms"].to_numpy(np.int64) for f in frames])
        n = np.concatenate([f["hits"].to_numpy(np.int64) for f in frames])
        known = self.last.get() if self.last.exists() else None
        last = max(int(ts.max()), known[0] if known else int(ts.max()))
        first_hour = (last - max(self.spans.values())) // HOUR_MS
        for hour in np.unique(ts // HOUR_MS).tolist():
            if hour >= first_hour:
                mine = ts // HOUR_MS == hour
                self._add(hour, ts[mine], n[mine])
        if known is None or last // HOUR_MS > known[0] // HOUR_MS:
            for (hour,) in [h for h in self.hours.keys() if h[0] < first_hour]:
                self.hours.removeKey((hour,))
        self.last.update((last, self._timer(known[1] if known else None, timerValues)))
        held = {k[0]: v for k, v in self.hours.iterator()}
        counts = {name: [self._since(held, last - span)] for name, span in self.spans.items()}
        yield pd.DataFrame({"remote_addr": [key[0]], "last_seen_ms": [last], **counts})

    def _add(self, hour: int, ts: np.ndarray, n: np.ndarray) -> None:
        if self.hours.containsKey((hour,)):
            _, times, counts = self.hours.getValue((hour,))
            ts, n = np.append(np.frombuffer(times, _TIME), ts), np.append(np.frombuffer(counts, _COUNT), n)
        times, which = np.unique(ts, return_inverse=True)
        counts = np.zeros(len(times), np.int64)
        np.add.at(counts, which, n)
        self.hours.updateValue((hour,), (int(counts.sum()), times.astype(_TIME).tobytes(), counts.astype(_COUNT).tobytes()))

    @staticmethod
    def _since(held: dict, low: int) -> int:
        """Hits at ``low`` or later: whole hours, and the times of the hour that ``low`` is in."""
        edge = low // HOUR_MS
        total = sum(v[0] for hour, v in held.items() if hour > edge)
        if edge in held:
            _, times, counts = held[edge]
            total += int(np.frombuffer(counts, _COUNT)[np.frombuffer(times, _TIME) >= low].sum())
        return total

    def _timer(self, old: int | None, values) -> int:
        """One timer per client, ``idle`` after what has arrived so far."""
        due = max(values.getCurrentWatermarkInMs(), 0) + self.idle_ms
        if old != due:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(due)
        return due

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        self.hours.clear()
        return iter([])

    def close(self) -> None:
        pass


def trailing_activity(records: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None, spans: dict[str, int] | None = None,
                      idle_ms: int = IDLE_MS, state_partitions: int | None = None) -> jobs.StreamRun:
    """Per client and micro-batch: latest request and hits of each trailing span -> keyed upsert sink."""
    spans = spans or TRAILING_SPANS
    rows = jobs.parsed(records, "remote_addr", "epoch_ms").select("remote_addr", "epoch_ms", F.lit(1).cast("bigint").alias("hits"))
    counted = rows.mapInArrow(_counted, "remote_addr string, epoch_ms long, hits long")
    # The clock of the timers is arrival time: no record is late by it.
    arrived = counted.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds")
    columns = ", ".join(f"{name} long" for name in spans)
    out = arrived.groupBy("remote_addr").transformWithStateInPandas(
        TrailingProcessor(spans, idle_ms), f"remote_addr string, last_seen_ms long, {columns}", "Update", "EventTime")
    return jobs._run(out, sink_root, checkpoint, lambda b, bid: sinks.upsert_latest(b, sink_root, ["remote_addr"], bid),
                     trigger=trigger, state_partitions=state_partitions, state_store=jobs.ROCKSDB)
