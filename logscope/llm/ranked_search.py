"""Ranked lexical search over a document-sharded inverted index, by hybrid TAAT-DAAT.

**Index.** Tasks read their part of the documents and pack runs of them into segments of about
``SEGMENT_POSTINGS`` postings: the sorted terms (64-bit hashes of words), each term's documents in order with
its counts, and every document's id and length. Nothing is shuffled, and a frequent word's list is
cut by segments, however many documents hold it.

**Search.** Queries go in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` words. A first pass
over the index's term lists sums the document frequencies of a block's terms; these give the weights. Then each
segment answers each query:

1. *term at a time*: the lists of at most ``SHORT`` postings are summed up into accumulators, one per document;
2. the accumulators, sorted by document and with their maximum per window of ``WINDOW`` documents, are one
   more list with a bound; every long list has its largest contribution per window as well;
3. *document at a time*: windows are gone through in order; one whose bounds add up to less than
   the tenth best score so far is skipped on all lists at once. In the others the lists with the largest bounds are
   added first, and as soon as no document can reach that score with what is left, the remaining lists are skipped.

The best of a task's segments set the score that later segments must reach; a windowed rank over the tasks' best gives the result.

All scores are integers as the contract states them: w * ((1000000000 * tf) div (1000 * tf + 8 * m)), with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 25 + (75 * n * N) div L.

Defined results: a null or empty text has no terms, neither counts for N nor is found; a null or empty item has no
result; items that repeat an item_id are ranked each; rows that repeat a doc_id are documents of their own, each with its place;
equal scores come by ascending doc_id, rows without an id last; a very long text is one document, and one that alone has
more postings than a segment makes a segment; empty tables give an empty result; extra columns are ignored. Two words are taken for one only if
their 64-bit hashes agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.llm import wordhash
from logscope.llm.common import keep_folder, keep_table, map_arrow, whole_text

SEGMENT_POSTINGS, SEGMENT_DOCS = 1 << 20, 1 << 15
WINDOW, SHORT = 512, 64               # documents that are skipped together; postings of a short list
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 17
BEST = 10
_K, _B = 8, 75                        # of the score: 0.8 and 0.75, in integers
#: Bytes between terms: ASCII without digits and letters.
BETWEEN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

_INDEX = ("segment_docs long, segment_words long, doc_ids array<bigint>, lengths binary, terms binary, begin binary, "
          "docs binary, counts binary")


# ---------------------------------------------------------------- index

def _postings(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, row, count) of each row's distinct terms, by row, and each row's number of terms."""
    h, row = wordhash.words(raw, offs, BETWEEN)
    lengths = np.bincount(row, minlength=len(offs) - 1)
    terms, which = np.unique(h, return_inverse=True)
    both, count = np.unique(row * max(1, len(terms)) + which, return_counts=True)
    return terms[both % max(1, len(terms))], both // max(1, len(terms)), count, lengths


class _Segment:
    """Documents that are gathered until their postings fill a segment."""

    def __init__(self):
        self.parts, self.ids, self.lengths, self.docs, self.size = [], [], [], 0, 0

    def add(self, doc_ids: list, lengths: np.ndarray, term: np.ndarray, row: np.ndarray, count: np.ndarray) -> None:
        self.parts.append((term, row + self.docs, count))
        self.ids += doc_ids
        self.lengths.append(lengths)
        self.docs, self.size = self.docs + len(doc_ids), self.size + len(term)

    def packed(self) -> pa.RecordBatch:
        term, doc, count = (np.concatenate(c) for c in zip(*self.parts))
        lengths = np.concatenate(self.lengths)
        order = np.argsort(term, kind="stable")                  # each term's documents stay in order
        terms, begin = np.unique(term[order], return_index=True)
        blobs = (lengths.astype("<i8"), terms.astype("<u8"), np.append(begin, len(term)).astype("<u4"),
                 doc[order].astype("<u4"), count[order].astype("<u4"))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(np.count_nonzero(lengths))]), pa.array([int(lengths.sum())]),
             pa.array([self.ids], pa.list_(pa.int64())), *[pa.array([b.tobytes()], pa.binary()) for b in blobs]],
            ["segment_docs", "segment_words", "doc_ids", "lengths", "terms", "begin", "docs", "counts"])


def _segmented(postings: int, documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for i, raw, offs in wordhash.text_runs(batch.column(1)):
                term, row, count, lengths = _postings(raw, offs)
                if segment.docs and (segment.size + len(term) > postings or segment.docs + len(lengths) > documents):
                    yield segment.packed()
                    segment = _Segment()
                segment.add(batch.column(0).slice(i, len(lengths)).to_pylist(), lengths, term, row, count)
        if segment.docs:
            yield segment.packed()
    return run


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          segment_postings: int = SEGMENT_POSTINGS, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The index of all ``docs``: one row per segment."""
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    return keep_table(map_arrow(body, _segmented(segment_postings, segment_docs), _INDEX), "search-index")


# ---------------------------------------------------------------- queries

class _Block:
    """A block of items: the distinct terms of all, and each item's terms with their repeats."""

    def __init__(self, texts: list[str]):
        column = pa.array(texts, pa.string())
        found = [(h, row + i) for i, raw, offs in wordhash.text_runs(column) for h, row in [wordhash.words(raw, offs, BETWEEN)]]
        h = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.uint64)
        row = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        self.terms, which = np.unique(h, return_inverse=True)
        size = max(1, len(self.terms))
        both, times = np.unique(row * size + which, return_counts=True)
        cuts = np.searchsorted(both, np.arange(len(texts) + 1) * size)
        self.items = [((both[a:b] % size), times[a:b].astype(np.int64)) for a, b in zip(cuts[:-1], cuts[1:])]
        self.weights = np.zeros(len(self.terms), np.int64)


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, _Block]]:
    """(ids, block) of runs of items; the driver holds one at a time."""
    ids, texts, words = [], [], 0
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), whole_text(text).alias("body"))
    for r in rows.toLocalIterator(prefetchPartitions=False):
        if ids and (len(ids) >= BLOCK_ITEMS or words >= BLOCK_TERMS):
            yield ids, _Block(texts)
            ids, texts, words = [], [], 0
        ids.append(r.item_id)
        texts.append(r.body)
        words += len(r.body) // 4
    if ids:
        yield ids, _Block(texts)


def _frequencies(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        df = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, begin in zip(batch.column(0), batch.column(1)):
                terms, begin = np.frombuffer(terms.as_buffer(), "<u8"), np.frombuffer(begin.as_buffer(), "<u4")
                mine, at = _common(wanted, terms)
                df[mine] += np.diff(begin.astype(np.int64))[at]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])
    return run


def _common(wanted: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms that both sorted arrays have, in each."""
    at = np.searchsorted(terms, wanted)
    at[at == len(terms)] = 0
    mine = np.flatnonzero(terms[at] == wanted) if len(terms) else np.empty(0, np.int64)
    return mine, at[mine]


def _saturation(lengths: np.ndarray, n: int, words: int) -> np.ndarray:
    """Each document's m."""
    if _B * int(lengths.max(initial=0)) * n < 1 << 63:
        return 100 - _B + _B * lengths * n // words
    return np.array([100 - _B + _B * x * n // words for x in lengths.tolist()], np.int64)


# ---------------------------------------------------------------- search in one segment

class _Lists:
    """The lists of a block's terms in one segment, with each posting's contribution and each window's largest one."""

    def __init__(self, block: _Block, n: int, words: int, lengths, terms, begin, docs, counts):
        begin = begin.astype(np.int64)
        self.size = len(lengths)
        self.windows = -(-self.size // WINDOW)
        mine, at = _common(block.terms, terms)
        self.number = np.full(len(block.terms), -1, np.int64)
        self.number[mine] = np.arange(len(mine))
        length = (begin[at + 1] - begin[at])
        self.begin = np.concatenate([[0], np.cumsum(length)])
        take = np.arange(self.begin[-1]) + np.repeat(begin[at] - self.begin[:-1], length)
        self.docs, tf = docs[take].astype(np.int64), counts[take].astype(np.int64)
        m = _saturation(lengths, n, words)
        self.gain = np.repeat(block.weights[mine], length) * (1_000_000_000 * tf // (1000 * tf + _K * m[self.docs]))
        # A posting's (list, window) is in order, so each window of a list is a run.
        run = np.repeat(np.arange(len(mine)), length) * self.windows + self.docs // WINDOW
        self.at = np.searchsorted(run, np.arange(len(mine) * self.windows + 1)).reshape(-1) if len(mine) else np.zeros(1, np.int64)
        bound = np.zeros(len(mine) * self.windows, np.int64)
        full = np.flatnonzero(np.diff(self.at))
        if len(full):
            bound[full] = np.maximum.reduceat(self.gain, self.at[full])
        self.bound = bound.reshape(len(mine), self.windows)

    def accumulators(self, lists: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents in order, sums) over whole short lists, term at a time."""
        if not len(lists):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        spans = [slice(self.begin[i], self.begin[i + 1]) for i in lists.tolist()]
        docs, which = np.unique(np.concatenate([self.docs[s] for s in spans]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, which, np.concatenate([self.gain[s] * t for s, t in zip(spans, times.tolist())]))
        return docs, sums

    def best(self, terms: np.ndarray, times: np.ndarray, least: int, add) -> None:
        """Give ``add(documents, scores)`` all documents that reach ``least``, which ``add`` returns anew."""
        lists, known = self.number[terms], self.number[terms] >= 0
        lists, times = lists[known], times[known]
        if not len(lists):
            return
        short = self.begin[lists + 1] - self.begin[lists] <= SHORT
        acc_docs, acc = self.accumulators(lists[short], times[short])
        lists, times = lists[~short], times[~short]
        acc_at = np.searchsorted(acc_docs, np.arange(self.windows + 1) * WINDOW)
        acc_bound = np.zeros(self.windows, np.int64)
        full = np.flatnonzero(np.diff(acc_at))
        if len(full):
            acc_bound[full] = np.maximum.reduceat(acc, acc_at[full])
        # One row per iterator, the accumulators' last.
        bounds = np.vstack([self.bound[lists] * times[:, None], acc_bound])
        total = bounds.sum(0)
        for w in np.flatnonzero(total >= least).tolist():
            if total[w] < least:                              # the score to reach has risen since
                continue
            first, column = w * WINDOW, bounds[:, w]
            order = np.argsort(-column, kind="stable")
            rest = int(total[w])
            score = np.zeros(min(WINDOW, self.size - first), np.int64)
            for i in order[:np.count_nonzero(column)].tolist():
                if rest < least and int(score.max()) + rest < least:
                    break                                     # no document can reach it any more
                if i == len(lists):
                    span = slice(acc_at[w], acc_at[w + 1])
                    score[acc_docs[span] - first] += acc[span]
                else:
                    cell = int(lists[i]) * self.windows + w
                    span = slice(self.at[cell], self.at[cell + 1])
                    score[self.docs[span] - first] += self.gain[span] * times[i]
                rest -= int(column[i])
            else:
                reached = np.flatnonzero(score >= least)
                if len(reached):
                    least = add(reached + first, score[reached])


class _Best:
    """The best documents of one item, of all segments of a task."""

    def __init__(self, k: int):
        self.k, self.ids, self.none, self.scores = k, np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def least(self) -> int:
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, none: np.ndarray, scores: np.ndarray) -> int:
        ids, none, scores = np.append(self.ids, ids), np.append(self.none, none), np.append(self.scores, scores)
        order = np.lexsort((ids, none, -scores))[:self.k]
        self.ids, self.none, self.scores = ids[order], none[order], scores[order]
        return self.least()


def _searched(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, words = shared.value
        best = [_Best(k) for _ in block.items]
        for batch in batches:
            for s in range(len(batch)):
                ids = batch.column(0)[s].values
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                kinds = ("<i8", "<u8", "<u4", "<u4", "<u4")
                lists = _Lists(block, n, words, *(np.frombuffer(batch.column(1 + i)[s].as_buffer(), t) for i, t in enumerate(kinds)))
                for (terms, times), mine in zip(block.items, best):
                    def add(docs, scores, mine=mine):
                        return mine.add(ids[docs], none[docs], scores)
                    lists.best(terms, times, mine.least(), add)
        item = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.ids) for b in best])
        ids, none, scores = (np.concatenate([getattr(b, f) for b in best]) for f in ("ids", "none", "scores"))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=none), pa.array(scores)], ["item", "doc_id", "score"])
    return run


def search(index: DataFrame, items: DataFrame, k: int = BEST, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of the index for every item with a score above 0."""
    spark = index.sparkSession
    folder, schema = f"{keep_folder(spark, 'search-results')}/table", "item_id long, rank int, doc_id long, score long"
    n, words = index.agg(F.sum("segment_docs"), F.sum("segment_words")).first()
    spark.createDataFrame([], schema).write.parquet(folder)
    for ids, block in _blocks(items, item_id, text):
        if not words or not len(block.terms):
            continue
        terms = spark.sparkContext.broadcast(block.terms)                 # of at most one block
        df = map_arrow(index.select("terms", "begin"), _frequencies(terms), "term long, df long") \
            .groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        for term, count in zip(df.column("term").to_pylist(), df.column("df").to_pylist()):
            block.weights[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * count + 1)))
        shared = spark.sparkContext.broadcast((block, int(n), int(words)))
        found = map_arrow(index.select("doc_ids", "lengths", "terms", "begin", "docs", "counts"), _searched(shared, k),
                          "item int, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        numbers = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")    # at most BLOCK_ITEMS rows
        ranked.join(F.broadcast(numbers), "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)

