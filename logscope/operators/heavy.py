"""The N most frequent keys of a stream without the counts of all keys.

A summary of a micro-batch holds its keys with more than ``1 / slots`` of its records, at most ``slots`` of them, and
``bound``, the highest count among the keys it left out. Summaries add up: over many batches a key's true count is at
least the sum of its counts, and at most that plus the bounds of the batches whose summaries lack it. So

* the N-th largest lower end is reached by at least N keys, and
* a key whose upper end is below it cannot be among the first N.

What is left are the candidates; these alone are counted exactly, in one pass over the log with a semi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.operators import reports

SLOTS = 1000


def summary(counts: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """(key, hits, bound): the frequent keys of a batch's ``counts`` (key, hits), each with the batch's bound.

    The row without a key has the records of all keys that were left out. ``counts`` is read twice.
    """
    counts = counts.where(F.col(key).isNotNull())
    total = counts.agg(F.sum("hits")).first()[0] or 0
    kept = F.col("hits") * slots > total
    one = counts.select(F.when(kept, F.col(key)).alias(key), "hits", F.when(kept, 0).otherwise(F.col("hits")).alias("_out")) \
                .groupBy(key).agg(F.sum("hits").cast("bigint").alias("hits"), F.max("_out").cast("bigint").alias("_out"))
    every = Window.partitionBy(F.lit(0))                              # of at most slots + 1 rows
    return one.select(key, "hits", F.max("_out").over(every).alias("bound"))


def merge(rows: DataFrame, key: str) -> DataFrame:
    """Summaries of several batches as one (for ``sinks.fold``): a key's bound is the sum over the batches that hold it,
    that of the row without a key the sum over all batches that left something out."""
    last = [F.max("batch_id").alias("batch_id")] if "batch_id" in rows.columns else []
    return rows.groupBy(key).agg(F.sum("hits").cast("bigint").alias("hits"), F.sum("bound").cast("bigint").alias("bound"), *last)


def candidates(rows: DataFrame, key: str, n: int) -> tuple[DataFrame, bool]:
    """(key, at_least, at_most) of every key that may be among the first ``n``; and whether these are all such keys.

    They are not if a key that no summary holds may be as frequent, as with too few slots for this ``n``.
    """
    one = merge(rows, key)
    rest = one.where(F.col(key).isNull()).first()                     # one row, or none
    unlisted = rest["bound"] if rest else 0
    ends = one.where(F.col(key).isNotNull()) \
        .select(key, F.col("hits").alias("at_least"), (F.col("hits") + unlisted - F.col("bound")).alias("at_most"))
    first = ends.orderBy(F.desc("at_least")).limit(n).collect()       # n rows
    if len(first) < n:
        return ends, not unlisted
    least = min(r["at_least"] for r in first)
    return ends.where(F.col("at_most") >= least), unlisted < least


def top_n(rows: DataFrame, log: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` keys of ``log`` with their exact counts, by the summaries ``rows`` of its batches.

    If the summaries cannot exclude keys that none of them holds, all keys are counted.
    """
    found, complete = candidates(rows, key, n)
    if not complete:
        return reports.top_n(log, n, key)
    return reports.top_n(log.join(found.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_semi"), n, key)
