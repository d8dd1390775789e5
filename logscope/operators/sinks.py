"""Idempotent table sinks over plain parquet in a shared folder.

Every write is a whole micro-batch named by its ``batch_id``; nothing is read, changed or
rewritten by it:

* ``append_batch``      — rows go to ``<root>/log/batch_id=b``. A batch that is committed already
  (Spark's ``_SUCCESS`` marker) is a replay and is skipped; a partial one is overwritten.
* ``upsert_latest``     — the same append; readers resolve the newest row per key.
* ``upsert_accumulate`` — the same append of deltas; readers sum them, so late rows just add.

Readers name the committed batches and read only those. ``fold`` is a maintenance job outside
the write path: it lists the committed batches once, writes what exactly these add up to as a new
snapshot under a fresh name, and only when that is committed deletes what it replaces. A batch that is
committed meanwhile is in neither and stays. A crash at any point leaves either
the old files or both; readers then ignore the batches that the newest snapshot covers.

A table may have a layout (partition columns, the order within files, columns with Bloom filters), stated by its
first write and kept in ``<root>/_layout.json``, so that folding keeps it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_KEY_DATE = re.compile(r"_([0-9]{2}/[A-Za-z]{3}/[0-9]{4}):")

# The layout of a log table: days, and in a day's files the keys in order.
LOG_LAYOUT = {"partition_by": ["log_date"], "order_by": ["row_key"], "bloom": ["row_key"]}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _folders(spark: SparkSession, root: str, prefix: str) -> dict[str, bool]:
    """Names of the folders ``<root>/<prefix>...`` and whether each is committed; two listings in all."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return {}
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{prefix}*/_SUCCESS")) or []
    done = {st.getPath().getParent().getName() for st in marks}
    return {n: n in done for n in names if n.startswith(prefix)}


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/log"


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/base"


def _batch(root: str, batch_id: int) -> str:
    return f"{_log(root)}/batch_id={batch_id}"


def _contents(spark: SparkSession, root: str) -> tuple[str | None, int, list[int]]:
    """The newest snapshot, the last batch it covers, and the committed batches above it.

    The batches are listed first: a fold that ends between the two listings then covers them.
    """
    ids = sorted(int(n.partition("=")[2]) for n, done in _folders(spark, _log(root), "batch_id=").items() if done)
    snapshot, upto = _snapshot(spark, root)
    return snapshot, upto, [i for i in ids if i > upto]


def committed(spark: SparkSession, root: str) -> list[int]:
    """Ids of the committed batches that no snapshot covers, in order."""
    return _contents(spark, root)[2]


def _snapshot(spark: SparkSession, root: str) -> tuple[str | None, int]:
    """The newest committed snapshot folder ``v=<last batch>-<name>`` and the last batch it covers."""
    done = sorted(n for n, ok in _folders(spark, _base(root), "v=").items() if ok)
    return (done[-1], int(done[-1][2:].split("-")[0])) if done else (None, -1)


def layout(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The table's layout: ``partition_by``, ``order_by`` and ``bloom``; empty if its writes state none."""
    fs, p, _ = _fs(spark, f"{root.rstrip('/')}/_layout.json")
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _state_layout(spark: SparkSession, root: str, stated: dict) -> None:
    fs, p, _ = _fs(spark, f"{root.rstrip('/')}/_layout.json")
    if stated and not fs.exists(p):
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(stated).encode()))
        stream.close()


def write_rows(rows: DataFrame, path: str, how: dict, mode: str) -> None:
    """Write ``rows`` in a layout."""
    partition_by, order_by = how.get("partition_by") or [], how.get("order_by") or []
    if order_by:
        rows = rows.sortWithinPartitions(*partition_by, *order_by)
    writer = rows.write.mode(mode)
    for column in how.get("bloom") or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_batch(batch: DataFrame, root: str, batch_id: int, partition_by: list[str] | None = None,
                 order_by: list[str] | None = None, bloom: list[str] | None = None) -> bool:
    """Append one batch. False, and nothing is written, if it is a replay of a committed batch.

    ``partition_by``, ``order_by`` (within files) and ``bloom`` (columns with a Bloom filter, for point
    lookups) make the table's layout, which ``fold`` keeps.
    """
    spark, path = batch.sparkSession, _batch(root, batch_id)
    fs, _, jvm = _fs(spark, path)
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")) or batch_id <= _snapshot(spark, root)[1]:
        return False
    how = {k: v for k, v in (("partition_by", partition_by), ("order_by", order_by), ("bloom", bloom)) if v}
    _state_layout(spark, root, how)
    write_rows(batch, path, how, "overwrite")
    return True


def upsert_latest(batch: DataFrame, root: str, keys: list[str], batch_id: int) -> bool:
    """Last write wins per key. False if the batch is a replay."""
    return append_batch(batch, root, batch_id)


def upsert_accumulate(batch: DataFrame, root: str, keys: list[str], value: str, batch_id: int) -> bool:
    """``value += delta`` per key. False if the batch is a replay (it does not count twice)."""
    return append_batch(batch.select(*keys, F.col(value).cast("bigint").alias(value)), root, batch_id)


def read_appended(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of the newest snapshot and of the committed batches above it, with their ``batch_id``."""
    snapshot, _, ids = _contents(spark, root)
    return _rows(spark, root, snapshot, ids)


def _rows(spark: SparkSession, root: str, snapshot: str | None, ids: list[int]) -> DataFrame | None:
    parts = []
    if snapshot:
        parts.append(spark.read.parquet(f"{_base(root)}/{snapshot}"))
    if ids:
        log = spark.read.option("basePath", _log(root)).parquet(*[_batch(root, i) for i in ids])
        parts.append(log.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    # Rows of one key in one batch have no order; the greatest values win, whatever file they are in.
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    best = rows.groupBy(*keys).agg(F.max(F.struct("batch_id", *values)).alias("_r"))
    return best.select(*keys, *[F.col("_r." + c).alias(c) for c in values], F.col("_r.batch_id").alias("batch_id"))


def _totals(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value), F.max("batch_id").alias("batch_id"))


def read_latest(spark: SparkSession, root: str, keys: list[str]) -> DataFrame | None:
    """Newest row per key (and the batch it came from)."""
    rows = read_appended(spark, root)
    return None if rows is None else latest(rows, keys)


def read_totals(spark: SparkSession, root: str, keys: list[str], value: str) -> DataFrame | None:
    """Summed deltas per key."""
    rows = read_appended(spark, root)
    return None if rows is None else _totals(rows, keys, value)


def fold(spark: SparkSession, root: str, keys: list[str] | None = None, value: str | None = None,
         merge: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Maintenance: replace the committed batches by one snapshot; returns the last batch it covers.

    With ``keys`` alone the snapshot keeps the newest row per key, with ``value`` also the sum
    per key, with ``merge`` what that makes of all rows, without any all rows. Safe to stop at any point, to run
    again, and to run beside a stream that goes on writing. The table's layout is kept.
    """
    old, upto, ids = _contents(spark, root)
    if not ids:
        return upto
    rows, how = _rows(spark, root, old, ids), layout(spark, root)
    out = merge(rows) if merge else rows if not keys else _totals(rows, keys, value) if value else latest(rows, keys)
    near = [*how.get("partition_by", []), *how.get("order_by", [])]
    if near:                             # each file gets a narrow range of keys
        out = out.repartitionByRange(*near)
    write_rows(out, f"{_base(root)}/v={ids[-1]:012d}-{uuid.uuid4().hex[:8]}", how, "errorifexists")
    fs, _, jvm = _fs(spark, root)
    for path in [_batch(root, i) for i in ids] + ([f"{_base(root)}/{old}"] if old else []):
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
    return ids[-1]


def key_get(table: DataFrame, keys: list[str], key: str = "row_key", date: str | None = "log_date") -> DataFrame:
    """Rows of a log table by their whole keys (``ip_dd/MMM/yyyy:time_digest``).

    The date that a key names prunes partitions; within a day's files the equality is pushed to the scan, where the order of the keys
    leaves one file's row groups, and its Bloom filter none if it does not have the key.
    """
    cond = F.col(key).isin(keys)
    if date is not None:
        named = sorted({m[1] for k in keys if (m := _KEY_DATE.search(k))})
        # The dates are constants by the time partitions are chosen.
        cond = cond & F.col(date).isin([F.try_to_date(F.lit(d), "dd/MMM/yyyy") for d in named])
    return table.filter(cond)


def key_scan(table: DataFrame, key: str, start: str | None = None, stop: str | None = None,
             regex: str | None = None) -> DataFrame:
    """Keyed-table scan: start inclusive, stop exclusive (lexicographic), regex = find on the key.

    On a table that stores the key, sorted within its files, the bounds are pushed to the
    parquet scan and skip row groups by their minima and maxima; the regex is a residual filter.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(key) >= F.lit(start))
    if stop is not None:
        cond = cond & (F.col(key) < F.lit(stop))
    if regex is not None:
        cond = cond & F.col(key).rlike(regex)
    return table.filter(cond)
