"""Language ID by a byte convolutional network, trained and applied in numpy.

Bytes (A-Z lower-cased) are embedded; filters of several widths run over fixed-length windows;
max pooling over each window and a softmax give the language. Training uses a bounded sample of
the labelled rows: about ``SAMPLE`` documents of each language and ``PIECES`` windows of each.
Every window of every whole text is then predicted, and a text's language is the one with the
largest sum of log probabilities; ``score`` is that language's mean probability.

Defined results: ``und`` with score 0.0 where the text is null, empty or without a letter, or
where there is nothing to learn from; rows that repeat get equal predictions; ties go to the
language first in alphabetical order; an empty table gives an empty result; extra columns are
ignored; a very long text is worked on in blocks of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.llm import wordhash
from logscope.llm.common import map_arrow, whole_text

SAMPLE, PIECES = 1500, 4             # documents per language, windows per document
LANGUAGES = 512                      # at most so many, the most frequent
WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE = 6, 64, 0.01
_BLOCK = 256                         # windows that are in memory at a time
_WIDEST = max(WIDTHS)
_STRIDE = WINDOW - _WIDEST + 1       # windows overlap so that no filter position is lost
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _blank() -> np.ndarray:
    """1 where a filter reads: a narrow filter has no weights for the last bytes."""
    mask = np.zeros((_WIDEST * EMBED, len(WIDTHS) * FILTERS), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
    return mask


@dataclass
class ByteCNN:
    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def _stacked(self, windows: np.ndarray) -> np.ndarray:
        x = self.embed[windows]
        z = np.empty((len(windows), _STRIDE, _WIDEST * EMBED), np.float32)
        for k in range(_WIDEST):
            z[:, :, k * EMBED:(k + 1) * EMBED] = x[:, k:k + _STRIDE]
        return z

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self._stacked(windows)
        pooled = (z.reshape(-1, z.shape[2]) @ self.filters).reshape(len(windows), _STRIDE, -1).max(axis=1)
        logits = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, labels: list[str], seed: int = 5) -> ByteCNN:
    """Adam on the cross-entropy; only the pooled positions carry a gradient."""
    rng, languages = np.random.default_rng(seed), sorted(set(labels))
    y = np.searchsorted(np.array(languages), np.array(labels))
    mask, n_filters = _blank(), len(WIDTHS) * FILTERS
    net = ByteCNN(languages, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  rng.normal(0, 0.3, mask.shape).astype(np.float32) * mask, np.zeros(n_filters, np.float32),
                  rng.normal(0, 0.1, (n_filters, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    names = ["embed", "filters", "bias", "dense", "offset"]
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in names}
    share = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))     # languages weigh alike
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at:at + BATCH]
            part, want, n = windows[pick], y[pick], len(pick)
            z = net._stacked(part)
            out = (z.reshape(-1, z.shape[2]) @ net.filters).reshape(n, _STRIDE, -1)
            where = out.argmax(axis=1)
            rows = np.arange(n)[:, None]
            pooled = np.take_along_axis(out, where[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            logits = hidden @ net.dense + net.offset
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), want] -= 1
            p *= (share[want] / n)[:, None].astype(np.float32)
            back = (p @ net.dense.T) * (pooled > 0)
            picked = z[rows, where]                                  # window, filter, stacked bytes
            to_filters = np.einsum("bfk,bf->kf", picked, back) * mask
            to_stack = back[:, :, None] * net.filters.T[None]
            to_embed = np.zeros_like(net.embed)
            for k in range(_WIDEST):
                np.add.at(to_embed, part[rows, where + k], to_stack[:, :, k * EMBED:(k + 1) * EMBED])
            grads = {"embed": to_embed, "filters": to_filters, "bias": back.sum(0), "dense": hidden.T @ p, "offset": p.sum(0)}
            step += 1
            for name, g in grads.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value = getattr(net, name)
                value -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def _windows(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows of bytes, zeros after a text's end."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    return np.where(inside, _LOWER[raw[np.where(inside, at, 0)]], 0).astype(np.uint8)


def _layout(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of all windows of all texts; an empty text has none."""
    size = np.diff(offs)
    count = np.where(size > 0, np.maximum(1, -(-(size - WINDOW) // _STRIDE) + 1), 0)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, offs[:-1][row] + nth * _STRIDE, offs[1:][row]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw, offs in wordhash.text_runs(batch.column(1)):
            langs = batch.column(0).slice(first, len(offs) - 1).to_pylist()
            out, names = [], []
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                if b <= a:
                    continue
                rng = np.random.default_rng(b - a)
                for k in range(PIECES):
                    start = int(rng.integers(a, max(a + 1, b - WINDOW + 1)))
                    end = b if k % 2 == 0 else min(b, start + int(rng.integers(16, WINDOW + 1)))   # short texts, too
                    out.append(_windows(raw, np.array([start]), np.array([end]))[0].tobytes())
                    names.append(langs[i])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.binary())], ["lang", "bytes"])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", seed: int = 5) -> ByteCNN | None:
    """A network from a bounded sample of rows with a language and a text; None if there are none."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("body")).where("lang IS NOT NULL AND length(body) > 0")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    share = {r["lang"]: min(1.0, SAMPLE / r["count"]) for r in counts}
    sample = rows.sampleBy("lang", share, seed)
    got = map_arrow(sample, _sampled, "lang string, bytes binary").limit(2 * SAMPLE * PIECES * len(counts)).collect()
    got = sorted((r["lang"], bytes(r["bytes"])) for r in got)
    windows = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), WINDOW)
    return train(windows, [name for name, _ in got], seed)


def _predicted(net: ByteCNN | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offs in wordhash.text_runs(batch.column(1)):
                n = len(offs) - 1
                letter = batch.column(2).slice(first, n).to_numpy(zero_copy_only=False)
                names, score = np.full(n, "und", object), np.zeros(n)
                if net is not None:
                    logs, probs, count = np.zeros((n, len(net.languages))), np.zeros((n, len(net.languages))), np.zeros(n)
                    row, starts, ends = _layout(offs)
                    for i in range(0, len(row), _BLOCK):
                        part = net.log_probabilities(_windows(raw, starts[i:i + _BLOCK], ends[i:i + _BLOCK]))
                        at = row[i:i + _BLOCK]
                        np.add.at(logs, at, part)
                        np.add.at(probs, at, np.exp(part))
                        np.add.at(count, at, 1)
                    best = logs.argmax(axis=1)
                    known = letter & (count > 0)
                    names[known] = np.array(net.languages, object)[best[known]]
                    score[known] = np.minimum(1.0, probs[known, best[known]] / count[known])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, net: ByteCNN | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text."""
    body = whole_text(text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"), body.rlike(r"\p{L}").alias("letter"))
    return map_arrow(rows, _predicted(net), "doc_id long, lang_pred string, score double")
