"""Lexical retrieval packing of documents into training sequences.

Words are hashed to a fixed number of terms (``CELLS``). One pass counts each term's document
frequency over all documents; that table has a fixed size and is broadcast. A second pass
tokenises every whole text once and gives each document the BM25 weights of all its terms that
other documents have too, in whole numbers, so that sums are exact. Documents are dealt out by their heaviest shared term, a frequent
term over as many groups as its frequency asks for, so that no group grows with the data. Each
task builds an inverted index of a shard of at most ``SHARD_DOCS`` documents at a time: a seed
fills its window first, then its unused neighbours by BM25 score, then the next unused
document. A document that does not fit is cut, and its rest is the next window's seed. At the
end of a task the open window is cut into powers of two, so no sequence needs padding.

Defined results: a null or empty text has the closing id only and is packed like any other;
rows that repeat are packed as often as they come; a null doc_id is kept; an empty table gives
an empty result; extra columns are ignored; a very long text fills as many windows as it needs; neighbours of equal
score come by their place in the shard, which is by doc_id and then by their ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm import wordhash
from logscope.llm.common import map_arrow, whole_text

TOKENIZER = "byte_bpe_50k.json"
WINDOW, CLOSE = 1024, 0              # ids in a sequence, the id that ends a document
CELLS, UNIT = 1 << 20, 1 << 12       # hashed terms in all, a weight of one
SHARD_DOCS, SHARD_TOKENS = 2048, 1 << 22     # documents and ids of an index shard at most
GROUP_DOCS = 512                     # documents that are dealt out together because of one term, about
COMMON, FIRST = 32, 16               # terms of more than 1 / COMMON of a shard are multiplied as matrices; neighbours sorted first
WIDE, PAIRS = 1024, 1 << 21          # rows of such a matrix, pairs of documents that are counted at a time
ENCODE_BYTES = 8 << 20               # text that is encoded at once, about; a longer text is encoded alone
K1, B = 1.2, 0.75
_DOCS, _WORDS = -1, -2               # rows of the statistics that are not terms


def _as_ranks(tokenizer):
    """The same vocabulary, pattern and merges as tiktoken's ranks, which give the same ids several
    times as fast; None for another kind of tokenizer than byte-level BPE without normaliser and prefix."""
    import tiktoken

    spec = json.loads(tokenizer.to_str())
    before, model = spec["pre_tokenizer"] or {}, spec["model"]
    if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") \
            or not before.get("use_regex", True) or model.get("type") != "BPE" or model.get("ignore_merges"):
        return None
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][m] for m in merges]
    if order != sorted(order):
        return None
    # A printable byte is itself in the vocabulary; the others follow from U+0100 in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in set(plain))}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_LETTER, _NUMBER, _SPACE, _OTHER, _STRANGE = range(5)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The class of each character of the basic plane, as the tokenizer's pattern tells them apart."""
    first = {"L": _LETTER, "N": _NUMBER}
    names = [unicodedata.category(chr(c)) for c in range(1 << 16)]
    kind = np.array([_STRANGE if n in ("Cn", "Cs") else first.get(n[0], _OTHER) for n in names], np.uint8)
    kind[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return kind


def _classes(raw: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to; ``_STRANGE`` beyond the basic plane."""
    kinds = _kinds()
    out = np.append(kinds[:128], np.full(128, _STRANGE, np.uint8))[raw]
    high = np.flatnonzero(raw >= 0xC0)
    two, three = high[raw[high] < 0xE0], high[(raw[high] >= 0xE0) & (raw[high] < 0xF0)]
    code = raw[two].astype(np.int32) << 6 & 0x7C0 | raw[two + 1] & 63
    out[two] = out[two + 1] = kinds[code]
    code = raw[three].astype(np.int32) << 12 & 0xF000 | raw[three + 1].astype(np.int32) << 6 & 0xFC0 | raw[three + 2] & 63
    out[three] = out[three + 1] = out[three + 2] = kinds[code]
    return out


def _pieces(raw: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the pieces begin into which ``public_tokenizers.PATTERN`` cuts each text."""
    n = len(raw)
    edge = np.zeros(n + 3, bool)                 # a text starts or ends here
    edge[offs] = edge[n:] = True
    begin = edge[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    # White space before something else: its last character is apart, a space belongs to what follows.
    after = np.flatnonzero(begin[1:] & ~edge[1:n] & (kind[:-1] == _SPACE)) + 1
    last = raw[after - 1]
    begin[after[last == 32]] = False
    wide = after[last >= 0x80]
    begin[after[last < 0x80] - 1] = True
    begin[wide - np.where(raw[wide - 2] >= 0xC0, 2, 3)] = True
    # 's 't 'm 'd 're 've 'll where a piece starts with them.
    at = np.flatnonzero((raw == 39) & begin & ~edge[1:n + 1])
    next1, next2 = raw[at + 1], raw[np.minimum(at + 2, n - 1)]
    short = np.isin(next1, np.frombuffer(b"stmd", np.uint8))
    long = ~edge[at + 2] & (((next1 == ord("r")) | (next1 == ord("v"))) & (next2 == ord("e")) | (next1 == ord("l")) & (next2 == ord("l")))
    begin[at[short | long] + 1] = False
    ends = np.append(at[short] + 2, at[long] + 3)
    begin[ends[ends < n]] = True
    return np.flatnonzero(begin)


class Tokens:
    """Ids of whole texts, as the tokenizer of a file gives them with ``add_special_tokens=False``, and ``close``.

    A special token's name in a text has that token's id, as the library gives it unless told otherwise.
    Many texts are cut into the pattern's pieces at once, and each distinct piece is encoded once.
    """

    def __init__(self, file: str, close: int = CLOSE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.kind = "<u2" if max(self.tokenizer.get_vocab_size(), close + 1) <= 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.ranks = _as_ranks(self.tokenizer)
        # The ranks know no special tokens; a text that may hold one goes to the tokenizer itself.
        self.special = re.compile("|".join(re.escape(t.content.strip()) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        self.close = np.array([close], self.kind).tobytes()
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level token has a character for each of its bytes.
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token)

    def _ids(self, text: str) -> list[int]:
        if self.ranks and not self.special.search(text):
            return self.ranks(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one(self, text: str) -> bytes:
        return array(self.code, self._ids(text)).tobytes() + self.close

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.ranks:
            return [self._one(t) for t in texts]
        out, plain = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if self.special.search(t):
                out[i] = self._one(t)
            else:
                plain.append(i)
        for first, raw, offs in wordhash.text_runs(pa.array([texts[i] for i in plain], pa.large_string()), ENCODE_BYTES):
            kind, mine = _classes(raw), plain[first:first + len(offs) - 1]
            strange = np.unique(np.searchsorted(offs, np.flatnonzero(kind == _STRANGE), "right") - 1)
            if len(strange):         # characters that engines may class differently: as the ranks' own pattern has it
                for i in strange.tolist():
                    out[mine[i]] = self._one(texts[mine[i]])
                size = np.diff(offs)
                keep = np.ones(len(size), bool)
                keep[strange] = False
                part = np.repeat(keep, size)
                raw, kind, offs = raw[part], kind[part], np.append(0, np.cumsum(size[keep]))
                mine = [i for i, k in zip(mine, keep.tolist()) if k]
            for i, ids in zip(mine, self._encoded(raw, offs, kind)):
                out[i] = ids + self.close
        return out

    def _of_pieces(self, pieces: pa.LargeStringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The ids of distinct pieces, in another order, and the place of each piece in it."""
        _, ends, data = pieces.buffers()
        ends = np.frombuffer(ends, np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        raw, begin, size = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends[:-1] - ends[0], np.diff(ends)
        kind = _classes(raw)
        # A space and what follows it are a piece wherever they come after such a piece: one call encodes them all.
        after = (size > 1) & (raw[begin] == 32) & (kind[np.minimum(begin + 1, len(raw) - 1)] != _SPACE)
        order = np.append(np.flatnonzero(after), np.flatnonzero(~after))
        ids = np.array(self.ranks(raw[np.repeat(after, size)].tobytes().decode()), self.kind)
        stop = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(size[after])) + 1
        # Any other is one piece by itself.
        alone = [array(self.code, self.ranks(p)).tobytes() for p in pieces.filter(pa.array(~after)).to_pylist()]
        stop = np.concatenate([[0], stop * ids.itemsize, ids.nbytes + np.cumsum([len(x) for x in alone], dtype=np.int64)])
        codes = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(order), [None, pa.py_buffer(stop.astype(np.int64)),
                                                                                 pa.py_buffer(ids.tobytes() + b"".join(alone))])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return codes, place

    def _encoded(self, raw: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> Iterator[bytes]:
        """The ids of each text without ``close``, from those of its pieces."""
        if len(raw) == 0:
            yield from [b""] * (len(offs) - 1)
            return
        begin = _pieces(raw, offs, kind)
        pieces = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(raw))), pa.py_buffer(raw)).dictionary_encode()
        codes, place = self._of_pieces(pieces.dictionary)
        _, ends, data = codes.take(pa.array(place[pieces.indices.to_numpy()])).buffers()
        ends, data = np.frombuffer(ends, np.int64), memoryview(data)
        at = ends[np.searchsorted(begin, offs)].tolist()
        for a, b in zip(at, at[1:]):
            yield bytes(data[a:b])


@lru_cache(maxsize=4)
def load(tokenizer: str = TOKENIZER, close: int = CLOSE) -> Tokens:
    """A tokenizer of a file, or of a public tokenizer's name; kept per process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if not os.path.exists(tokenizer):
        tokenizer = public_tokenizers.path(tokenizer)
    return Tokens(tokenizer, close)


def _term_counts(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of each row's distinct terms, and each row's number of words."""
    h, row = wordhash.words(raw, offs)
    both = (row.astype(np.int64) << 20) | (h >> np.uint64(44)).astype(np.int64)
    both, count = np.unique(both, return_counts=True)
    return both >> 20, both & (CELLS - 1), count, np.bincount(row, minlength=len(offs) - 1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs, words = np.zeros(CELLS, np.int64), 0, 0
    for batch in batches:
        for _, raw, offs in wordhash.text_runs(batch.column(0)):
            _, term, _, lengths = _term_counts(raw, offs)
            seen += np.bincount(term, minlength=CELLS)
            docs, words = docs + len(lengths), words + int(lengths.sum())
    term = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(term, [_DOCS, _WORDS])), pa.array(np.append(seen[term], [docs, words]))],
                                     ["term", "n"])


def term_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int, int]:
    """(documents that have each term, documents, words) over the whole table; the array has CELLS entries."""
    body = docs.select(whole_text(text).alias("body"))
    table = map_arrow(body, _frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = table.column("term").to_numpy(), table.column("n").to_numpy()
    real = term >= 0
    df = np.zeros(CELLS, np.int64)
    df[term[real]] = n[real]
    return df, int(n[term == _DOCS].sum()), int(n[term == _WORDS].sum())


def _indexed(stats, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, words = stats.value
        idf = np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32)
        average, tokens = max(1.0, words / max(1, docs)), load(tokenizer)
        for batch in batches:
            encoded = tokens.encode(batch.column(1).to_pylist())
            for first, raw, offs in wordhash.text_runs(batch.column(1)):
                n = len(offs) - 1
                row, term, count, lengths = _term_counts(raw, offs)
                shared = df[term] > 1
                row, term, count = row[shared], term[shared], count[shared]
                weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * lengths[row] / average))
                weight = np.maximum(weight * UNIT, 1).astype(np.int32)
                begin = np.searchsorted(row, np.arange(n + 1))
                size = np.diff(begin)
                has = size > 0
                group = np.full(n, -1, np.int64)
                if len(row):             # the heaviest term, of equal ones the least: rows come sorted by row and term
                    most = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, begin[:-1][has]), size[has]))
                    group[has] = term[most[np.unique(row[most], return_index=True)[1]]]
                groups = np.where(has, df[group] // GROUP_DOCS + 1, docs // GROUP_DOCS + 1)
                mixed = wordhash.mix(batch.column(0).slice(first, n).fill_null(0).to_numpy().astype(np.uint64))
                salt = (mixed % groups.astype(np.uint64)).astype(np.int64)
                cuts = [(4 * a, 4 * b) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                terms, weights = term.astype(np.int32).tobytes(), weight.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(group), pa.array(salt),
                    pa.array(encoded[first:first + n], pa.binary()),
                    pa.array([terms[a:b] for a, b in cuts], pa.binary()),
                    pa.array([weights[a:b] for a, b in cuts], pa.binary())],
                    ["doc_id", "term_group", "salt", "ids", "terms", "weights"])
    return run


class _Shard:
    """The BM25 scores of a bounded number of documents for each other, over all their terms."""

    def __init__(self, docs: list[tuple]):
        n = len(docs)
        self.docs, self.unused, self.next = docs, np.ones(n, bool), 0
        doc = np.repeat(np.arange(n), [len(d[2]) // 4 for d in docs])
        term = np.frombuffer(b"".join(d[2] for d in docs), np.int32)
        weight = np.frombuffer(b"".join(d[3] for d in docs), np.int32)
        known, at, times = np.unique(term, return_inverse=True, return_counts=True)
        # Whole numbers: sums are exact in whatever order.
        kind = np.float32 if np.bincount(doc, weight, n).max(initial=0) < 1 << 24 else np.float64
        self.score = np.zeros((n, n), kind)
        common = times * COMMON > n
        place = np.cumsum(common) - 1
        here = np.flatnonzero(common[at])
        for first in range(0, int(common.sum()), WIDE):
            row = place[at[here]] - first
            some = (row >= 0) & (row < WIDE)
            table = np.zeros((min(WIDE, int(common.sum()) - first), n), kind)
            table[row[some], doc[here[some]]] = weight[here[some]]
            self.score += (table > 0).T.astype(kind) @ table
        # All others by pairs of documents that have them, some documents at a time.
        rare = np.flatnonzero(~common[at] & (times[at] > 1))
        order = rare[np.argsort(at[rare], kind="stable")]
        holder, value = doc[order], weight[order].astype(np.float64)
        held = np.bincount(at[rare], minlength=len(known))
        begin = np.cumsum(held) - held
        length = held[at[rare]]
        done = np.cumsum(np.bincount(doc[rare], length, n)).astype(np.int64)
        cut = np.append(np.searchsorted(doc[rare], np.arange(n)), len(rare))
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + PAIRS, "right")))
            mine = slice(cut[low], cut[high])
            size = length[mine]
            to = np.arange(int(size.sum())) + np.repeat(begin[at[rare[mine]]] - (np.cumsum(size) - size), size)
            both = np.repeat((doc[rare[mine]] - low) * n, size) + holder[to]
            self.score[low:high] += np.bincount(both, value[to], (high - low) * n).reshape(high - low, n).astype(kind)
            low = high

    def first_unused(self) -> int | None:
        while self.next < len(self.docs) and not self.unused[self.next]:
            self.next += 1
        return self.next if self.next < len(self.docs) else None

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents that share a term with the seed, best BM25 score first; ties by place."""
        n, score = len(self.docs), self.score[seed]
        found = np.flatnonzero(self.unused & (score > 0))
        best = score[found].astype(np.int64) * n + (n - 1 - found)          # all different
        if len(found) > FIRST:                             # seldom are more asked for
            split = np.argpartition(-best, FIRST)
            sides = [split[:FIRST], split[FIRST:]]
        else:
            sides = [np.arange(len(found))]
        for side in sides:
            for i in found[side[np.argsort(-best[side])]].tolist():
                if self.unused[i]:
                    yield i


class _Packer:
    """Cuts documents into windows in the order in which the shard's index gives them."""

    def __init__(self, task: int):
        self.sequence, self.fill, self.open, self.rows = task << 32, 0, [], []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def place(self, doc: tuple) -> bool:
        """Adds a document; True if it closed a window."""
        doc_id, ids = doc[0], doc[1]
        at, closed = 0, False
        while at < len(ids):
            part = ids[at:at + WINDOW - self.fill]
            self.open.append((doc_id, at, part, len(ids)))
            at, self.fill = at + len(part), self.fill + len(part)
            if self.fill == WINDOW:
                self._close(self.open)
                self.open, self.fill, closed = [], 0, True
        return closed

    def pack(self, docs: list[tuple]) -> None:
        shard = _Shard(docs)
        while (seed := shard.first_unused()) is not None:
            shard.unused[seed] = False
            self.place(docs[seed])
            while self.fill and seed is not None:
                last, seed = seed, None
                for i in shard.neighbours(last):
                    shard.unused[i] = False
                    if self.place(docs[i]):
                        seed = i                # its rest, if any, is the next window's seed
                        break

    def finish(self) -> None:
        """Cuts the open window into sequences whose lengths are powers of two."""
        while self.fill:
            room, now, rest = 1 << self.fill.bit_length() - 1, [], []
            self.fill -= room
            for doc_id, start, ids, total in self.open:
                if room:
                    now.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self._close(now)
            self.open = rest


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _packed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, docs, tokens = _Packer(TaskContext.get().partitionId()), [], 0

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = list(zip(*rows)) if rows else [[]] * len(_PIECES)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

        for batch in batches:
            for doc_id, ids, terms, weights in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids = np.frombuffer(ids, kind).astype("<u4")
                docs.append((doc_id, ids, terms, weights))
                tokens += len(ids)
                if len(docs) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    packer.pack(docs)
                    docs, tokens = [], 0
                    yield out()
        packer.pack(docs)
        packer.finish()
        yield out()
    return run


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece of a document."""
    spark = docs.sparkSession
    stats = spark.sparkContext.broadcast(term_frequencies(docs, text))
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    rows = map_arrow(body, _indexed(stats, tokenizer),
                     "doc_id long, term_group long, salt long, ids binary, terms binary, weights binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "term_group", "salt").sortWithinPartitions("term_group", "salt", "doc_id", "ids") \
                .select("doc_id", "ids", "terms", "weights")
    return map_arrow(dealt, _packed(load(tokenizer).kind),
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
