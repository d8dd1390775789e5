"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no merge can cross: before a run of spaces, and around a line feed. New
words of a block of texts are encoded together in flat numpy arrays: each round finds the
segmented minimum of the pair ranks (one per word, the leftmost on ties), applies those merges
at once, recomputes only the pairs next to them and compacts the arrays, until no pair is
left. Merging one pair per word and round keeps the order of merges, and so the ids, exactly
those of the library. A word of more than ``LONG`` symbols, for which that would take a round
per merge, uses a heap of its pairs instead. Encoded words are remembered up to a fixed number.

Defined results: a null or empty text gives begin and end ids only and decodes to the empty
text; characters without a piece become byte pieces; U+2581 counts as a space, as in the
library; rows that repeat are encoded alike; an empty table gives an empty result; extra
columns are ignored. The model must have the identity normaliser, a dummy prefix and byte
fallback (checked on loading).
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm.common import map_arrow, whole_text

MODEL = "piece_bpe_32k.model"
LONG = 128                # symbols of a word from which the heap is used
REMEMBERED = 500_000      # words kept per task process
BLOCK_CHARS = 1 << 20
_SPACE = "▁"
_NONE = np.int64(1) << 62


class PieceModel:
    """Pieces, pair ranks and special ids of one model file."""

    def __init__(self, file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(file, "rb") as f:
            proto.ParseFromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces \
                or not trainer.byte_fallback or trainer.model_type != 2:
            raise ValueError("needs a BPE model with identity normaliser, dummy prefix and byte fallback")
        sp = sentencepiece.SentencePieceProcessor(model_file=file)
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        kind = pb.ModelProto.SentencePiece
        self.bytes_of, normal, self.byte_ids = [], {}, np.zeros(256, np.uint32)
        for i, p in enumerate(proto.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (kind.NORMAL, kind.USER_DEFINED):
                normal[p.piece] = i
                self.bytes_of.append(p.piece.replace(_SPACE, " ").encode())
            else:
                self.bytes_of.append(b"")
        self.splits_lines = not any("\n" in p and len(p) > 1 for p in normal)
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in normal):
            raise ValueError("a piece goes on after a space: words cannot be encoded apart")
        # Symbols: all pieces, then characters that occur in pieces only.
        self.symbol = dict(normal)
        for c in sorted(set("".join(normal))):
            self.symbol.setdefault(c, len(proto.pieces) + len(self.symbol))
        self.size = max(self.symbol.values()) + 1
        self.of_char = np.full(0x110000, -1, np.int32)
        for s, i in self.symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        order = {score: r for r, score in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        pairs = {}
        for s, i in normal.items():
            for cut in range(1, len(s)):
                a, b = self.symbol.get(s[:cut]), self.symbol.get(s[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (order[proto.pieces[i].score], i)
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_key.tolist()], np.int64)
        self.pair_to = np.array([pairs[k][1] for k in self.pair_key.tolist()], np.int32)
        self.pairs, self.ids_end = pairs, len(proto.pieces)
        self.after_space: dict[str, bytes] = {}     # word -> ids of a space and the word
        self.alone: dict[str, bytes] = {}           # word -> ids of the word

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], _NONE), self.pair_to[at]

    def _merge_rounds(self, symbols: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(symbols, word) of words that are done, as they are done."""
        rank, to = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int32)
        fresh = np.arange(len(symbols) - 1)
        while len(symbols):
            if len(fresh):
                fresh = fresh[fresh + 1 < len(symbols)]
                got, into = self._ranks(symbols[fresh], symbols[fresh + 1])
                rank[fresh] = np.where(word[fresh] == word[fresh + 1], got, _NONE)
                to[fresh] = into
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(symbols)))
            first = np.where(rank == np.repeat(least, length), np.arange(len(symbols)), len(symbols))
            first = np.minimum.reduceat(first, start)
            over = least == _NONE
            drop = np.repeat(over, length)
            if over.any():
                yield symbols[drop], word[drop]
            at = first[~over]
            symbols[at] = to[at]
            rank[at] = _NONE
            keep = ~drop
            keep[at + 1] = False
            moved = (np.cumsum(keep) - 1)[at]
            symbols, word, rank, to = symbols[keep], word[keep], rank[keep], to[keep]
            # Next to a merge: the pair that begins with it and the one that ends with it.
            if len(symbols):
                rank[-1] = _NONE
            near = np.zeros(len(symbols), bool)
            near[moved] = True
            near[moved[moved > 0] - 1] = True
            fresh = np.flatnonzero(near)

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One long word, by a heap of its pairs."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        end, heap = len(symbols), []

        def add(i: int) -> None:
            j = after[i]
            if j < end and symbols[i] >= 0 and symbols[j] >= 0:
                pair = self.pairs.get(symbols[i] * self.size + symbols[j])
                if pair:
                    heapq.heappush(heap, (pair[0], i, symbols[i], symbols[j], pair[1]))

        for i in range(end):
            add(i)
        gone = bytearray(end)
        while heap:
            _, i, a, b, into = heapq.heappop(heap)
            if gone[i] or symbols[i] != a or (j := after[i]) >= end or symbols[j] != b:
                continue
            symbols[i], gone[j] = into, 1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            add(i)
            if before[i] >= 0:
                add(before[i])
        return [s for s, g in zip(symbols, gone) if not g]

    def encode_words(self, todo: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        text = "".join(todo)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        symbols, sizes = self.of_char[codes], np.array([len(w) for w in todo], np.int64)
        # Characters without a symbol are themselves, as negative numbers.
        symbols = np.where(symbols < 0, -1 - codes.astype(np.int64), symbols).astype(np.int32)
        word = np.repeat(np.arange(len(todo), dtype=np.int32), sizes)
        short = (sizes <= LONG)[word] if len(word) else np.empty(0, bool)
        parts = list(self._merge_rounds(symbols[short], word[short]))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for i in np.flatnonzero(sizes > LONG):
            done = np.array(self._merge_long(symbols[bounds[i]:bounds[i + 1]].tolist()), np.int32)
            parts.append((done, np.full(len(done), i, np.int32)))
        symbols = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
        word = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int32)
        order = np.argsort(word, kind="stable")
        symbols, word = symbols[order], word[order]
        if len(odd := np.flatnonzero((symbols < 0) | (symbols >= self.ids_end))):      # byte fallback
            chars = {i: s for s, i in self.symbol.items() if i >= self.ids_end}
            raw = [(chars[s] if s >= 0 else chr(-1 - s)).encode() for s in symbols[odd].tolist()]
            reps = np.ones(len(symbols), np.int64)
            reps[odd] = [len(b) for b in raw]
            at = (np.cumsum(reps) - reps)[odd]
            symbols, word = np.repeat(symbols, reps), np.repeat(word, reps)
            for a, b in zip(at.tolist(), raw):
                symbols[a:a + len(b)] = self.byte_ids[list(b)]
        data = symbols.astype("<u4").tobytes()
        cuts = 4 * np.searchsorted(word, np.arange(len(todo) + 1))
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _units(self, text: str) -> tuple[list[list[str]], bool]:
        """Per line its words (all but the first after a space); False if the text has other runs of spaces."""
        lines = (" " + text).split("\n") if self.splits_lines else [" " + text]
        out = [line.split(" ") for line in lines]
        return out, not any("" in words[1:] for words in out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids with begin and end of each text, little-endian unsigned 32-bit."""
        if len(self.after_space) + len(self.alone) > REMEMBERED:
            self.after_space.clear()
            self.alone.clear()
        bos, eos = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        cut, spaced, alone = [], set(), {"\n"}
        for text in texts:
            text = text.replace(_SPACE, " ")
            lines, plain = self._units(text)
            if plain:
                for words in lines:
                    spaced.update(words[1:])
                    alone.add(words[0])
            elif text:
                lines = re.findall(rf"\n|{_SPACE}+[^{_SPACE}\n]*|[^{_SPACE}\n]+" if self.splits_lines else rf"{_SPACE}+[^{_SPACE}]*",
                                   _SPACE + text.replace(" ", _SPACE))
                alone.update(lines)
            cut.append((text, lines, plain))
        spaced, alone = [w for w in spaced if w not in self.after_space], [w for w in alone if w not in self.alone]
        self.after_space.update(zip(spaced, self.encode_words([_SPACE + w for w in spaced])))
        self.alone.update(zip(alone, self.encode_words(alone)))
        feed, after, one, out = self.alone["\n"], self.after_space.__getitem__, self.alone.__getitem__, []
        for text, lines, plain in cut:
            ids = [bos]
            if not text:
                pass
            elif plain:
                for n, words in enumerate(lines):
                    if n:
                        ids.append(feed)
                    ids.append(one(words[0]))
                    ids.extend(map(after, words[1:]))
            else:
                ids.extend(map(one, lines))
            ids.append(eos)
            out.append(b"".join(ids))
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """The text of each run of ids; one space of the dummy prefix goes."""
        out = []
        for run in ids:
            pieces = np.frombuffer(run, "<u4").tolist()
            raw = b"".join(map(self.bytes_of.__getitem__, pieces))
            first = next((i for i in pieces if self.bytes_of[i]), None)
            if raw[:1] == b" " and first is not None and first != self.byte_ids[32]:
                raw = raw[1:]
            out.append(raw.decode("utf-8", "replace"))
        return out


@lru_cache(maxsize=2)
def load(model: str = MODEL) -> PieceModel:
    """The model of a file, or of a public tokenizer's name; kept per process."""
    if not os.path.exists(model):
        import public_tokenizers

        model = public_tokenizers.path(model)
    return PieceModel(model)


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _encoded(batches: Iterator[pa.RecordBatch], model: str, result) -> Iterator[pa.RecordBatch]:
    pieces = load(model)
    for batch in batches:
        for first, texts in _blocks(batch.column(1).to_pylist()):
            columns = result(pieces, pieces.encode(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *columns.values()],
                                             ["doc_id", *columns])


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))


def encode(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers, begin and end included."""
    def run(batches):
        return _encoded(batches, model, lambda _, ids: {"ids": pa.array(ids, pa.binary())})
    return map_arrow(_rows(docs, doc_id, text), run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of a table (doc_id, ids) as ``encode`` makes it."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(load(model).decode(batch.column(1).to_pylist()))],
                                             ["doc_id", "text"])
    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the round trip, in one pass."""
    def hexes(parts):
        return pa.array([hashlib.sha256(x).hexdigest() for x in parts])

    def result(pieces, ids):
        return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": hexes(ids),
                "decoded_sha256": hexes(t.encode() for t in pieces.decode(ids))}

    def run(batches):
        return _encoded(batches, model, result)
    return map_arrow(_rows(docs, doc_id, text), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
