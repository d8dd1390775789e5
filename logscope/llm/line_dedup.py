"""Line dedup by repeated pairs of neighbouring lines.

A rolling hash over a window of two line hashes names each pair of neighbouring lines, wherever it
lies; a single line of more than ``LONG_WORDS`` words is named as well. Pairs are counted over all
documents. Of equal ones the first, in the smallest doc_id and then line, stays; the lines of every
other are removed, so that a repeated passage of two lines or more goes whole, whatever lies around
it. A first that would itself lose a line, as a repeat of something else, protects nothing: pairs are removed for the sake of
firsts alone that stay whole, so what is removed is always still there, in one piece, in the document of its first. An occurrence that
overlaps its own first is no repeat. Neighbouring pairs whose firsts are neighbours too form one chunk, which is compared byte by
byte with the lines of the firsts before it is removed.

Counts are aggregates with map-side combining and hashes are joined back as narrow rows, so
that a passage shared by a third of all documents is spread over tasks.

Defined results: a null text counts as empty; empty texts and those without repeated chunks are
unchanged; a document all of whose lines are repeats becomes empty; rows that repeat one doc_id
with equal text are one document and lose the same lines; rows with a null doc_id are not
changed; ties between equal pairs go to the smallest doc_id, then line; a very long text is split by lines in one task; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logscope.llm.common import keep_table, map_arrow, whole_text
from logscope.llm.wordhash import mix

LONG_WORDS = 50
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 1024


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, line, hash, single): each pair of neighbouring lines at its first line, and each long line."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for i in range(0, len(batch), _ROWS):
            part = batch.slice(i, _ROWS)
            ids, place, hashes, alone = [], [], [], []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                lines = text.split("\n")
                ids += [doc_id] * len(lines)
                place += range(len(lines))
                hashes += [digest(x.encode()) for x in lines]
                alone += [x.count(" ") >= LONG_WORDS for x in lines]
            ids, place, h = np.array(ids, np.int64), np.array(place, np.int32), np.array(hashes, np.uint64)
            pair = mix(h[:-1] * _FACTOR + h[1:])
            inside = place[1:] > 0      # else another text begins
            single = np.flatnonzero(np.array(alone, bool))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[:-1][inside], ids[single]])),
                pa.array(np.concatenate([place[:-1][inside], place[single]])),
                pa.array(np.concatenate([pair[inside], mix(h[single] + _FACTOR)]).view(np.int64)),
                pa.array(np.repeat([False, True], [int(inside.sum()), len(single)]))], ["doc_id", "line", "hash", "single"])


def _with_lines(text: str, result) -> Column:
    """``result(lines)`` for the lines of a text, which is split once however often they are used."""
    return F.transform(F.array(F.split(F.col(text), "\n", -1)), result)[0]


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, last): chunks of lines to remove, all but the first of equal ones."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body")).where("doc_id IS NOT NULL")
    pairs = keep_table(map_arrow(rows, _pairs, "doc_id long, line int, hash long, single boolean"), "line-pairs")
    place = F.struct("doc_id", "line")
    often = keep_table(pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                       .where("n > 1").select("hash", "first"), "pairs-repeated")
    apart = (F.col("first.doc_id") != F.col("doc_id")) | (F.abs(F.col("line") - F.col("first.line")) > F.when(F.col("single"), 0).otherwise(1))
    later = keep_table(pairs.join(often, "hash").where(apart).select(
        "doc_id", "line", "single", F.col("first.doc_id").alias("from_doc"), F.col("first.line").alias("from_line")).distinct(), "pairs-later")

    def lines_of(line: str) -> Column:
        return F.explode(F.when(F.col("single"), F.array(line)).otherwise(F.array(F.col(line), F.col(line) + 1)))

    # Firsts with a line that is a repeat itself are broken; nothing is removed for them.
    gone = later.select(F.col("doc_id").alias("g_doc"), lines_of("line").alias("g_line")).distinct()
    firsts = later.select("from_doc", "from_line", "single").distinct().select("*", lines_of("from_line").alias("_line"))
    broken = firsts.join(gone, (F.col("from_doc") == F.col("g_doc")) & (F.col("_line") == F.col("g_line")), "left_semi") \
        .select("from_doc", "from_line", "single").distinct()
    later = later.join(broken, ["from_doc", "from_line", "single"], "left_anti") \
        .select("doc_id", "line", "single", "from_doc", (F.col("line") - F.col("from_line")).alias("shift"))
    # A chunk's firsts lie next to each other as well, ``shift`` lines before it in ``from_doc``.
    source = ["doc_id", "single", "from_doc", "shift"]
    runs = later.withColumn("run", F.col("line") - F.row_number().over(W.partitionBy(*source).orderBy("line"))) \
        .groupBy(*source, "run").agg(F.min("line").alias("start"), F.max("line").alias("last")) \
        .select("doc_id", "start", (F.col("last") + F.when(F.col("single"), 0).otherwise(1)).alias("last"), "from_doc", "shift")
    chunks = keep_table(runs, "line-chunks")
    origin = [F.col("from_doc"), (F.col("start") - F.col("shift")).alias("from_start"), (F.col("last") - F.col("start")).alias("more")]

    own = chunks.select("doc_id", "start", *origin, F.lit(True).alias("own"))
    firsts = chunks.select(*origin).distinct().select(F.col("from_doc").alias("doc_id"), F.col("from_start").alias("start"), F.lit(None).cast("long")
                                                      .alias("from_doc"), F.lit(None).cast("int").alias("from_start"), "more", F.lit(False).alias("own"))
    # The list grows with the corpus: joined by shuffle at every size, never sent to all tasks.
    spans = own.unionByName(firsts).groupBy("doc_id") \
        .agg(F.collect_list(F.struct("start", "from_doc", "from_start", "more", "own")).alias("spans")).hint("merge")

    def texts(lines: Column) -> Column:
        return F.transform("spans", lambda s: F.struct(
            s.alias("s"), F.array_join(F.slice(lines, s["start"] + 1, s["more"] + 1), "\n").alias("bytes")))

    found = rows.join(spans, "doc_id").select("doc_id", F.explode(_with_lines("body", texts)).alias("x")).select("doc_id", "x.s.*", "x.bytes")
    found = keep_table(found, "chunk-texts")
    first = found.where("NOT own").select(F.col("doc_id").alias("from_doc"), F.col("start").alias("from_start"), "more",
                                          F.col("bytes").alias("first_bytes"))
    return found.where("own").drop("own").join(first.hint("merge"), ["from_doc", "from_start", "more"]) \
        .where("bytes = first_bytes").select("doc_id", "start", (F.col("start") + F.col("more")).alias("last")).distinct()


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_chars, n_lines, n_removed, removed): one row per row; ``removed`` lists first:last lines."""
    gone = repeated_chunks(docs, doc_id, text).groupBy("doc_id") \
        .agg(F.array_sort(F.collect_list(F.struct("start", "last"))).alias("spans")).withColumnRenamed("doc_id", "g_id")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    lines = F.split("body", "\n", -1)
    numbers = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["last"])))
    joined = rows.join(keep_table(gone, "lines-removed").hint("merge"), F.col("doc_id") == F.col("g_id"), "left") \
        .withColumn("drop", F.array_distinct(numbers))
    kept = _with_lines("body", lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), "drop"), lambda i: F.element_at(x, i + 1)))
    removed = F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["last"].cast("string"))), ","),
                         F.lit(""))
    body = F.when(F.col("drop").isNull(), F.col("body")).otherwise(F.array_join(kept, "\n"))
    return joined.select("doc_id", body.alias("text"), F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"), removed.alias("removed")) \
                 .withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("long"))) \
                 .select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"), "n_lines", "n_removed", "removed")
