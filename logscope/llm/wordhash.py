"""Word and shingle hashes of whole texts, vectorised over the UTF-8 bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20      # texts are worked on in runs of about so many bytes; a longer text is a run of its own
_GOLD = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _BYTE[_LOWER]
_BASE = 0xD1342543DE82EF95                      # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, BLOCK_BYTES + 1), np.uint64(base))
        out[0] = 1
        out = np.cumprod(out)
        if n > 4 * BLOCK_BYTES:                  # a very long text: not worth keeping
            return out
        have = _powers[base] = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits, so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_runs(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of a non-null string column."""
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def words(raw: np.ndarray, offs: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word, in order; words are runs without bytes of ``between`` (ASCII white space), A-Z lower-cased."""
    n = len(raw)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = between[raw]
    edge = np.zeros(n + 1, bool)                 # a text starts or ends here
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWERED[raw] * _power(_BASE, n), out=total[1:])
    hashes = (total[ends] - total[starts]) * _power(_INVERSE, n)[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * _GOLD), np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(starts, offs)))


def shingle_sets(raw: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct k-word shingles of row i are hashes[bounds[i]:bounds[i + 1]].

    A row with fewer than k words has its whole sequence as one shingle; one without words has none.
    """
    h, row = words(raw, offs)
    rows = len(offs) - 1
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])
    weight = mix(np.arange(1, k + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)
    size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(bounds[-1], np.uint64)
    if len(h) >= k:
        sums = np.zeros(len(h) - k + 1, np.uint64)
        for t in range(k):
            sums += h[t:len(h) - k + 1 + t] * weight[t]
        whole = row[:len(h) - k + 1] == row[k - 1:]
        at = bounds[row[:len(sums)]] + np.arange(len(sums)) - first[row[:len(sums)]]
        out[at[whole]] = sums[whole]
    for i in np.flatnonzero((count > 0) & (count < k)):
        part = h[first[i]:first[i + 1]]
        out[bounds[i]] = (int((part * weight[:len(part)]).sum(dtype=np.uint64)) + len(part) * int(_GOLD)) & 0xFFFFFFFFFFFFFFFF
    out = mix(out)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][size > 0]] = True
    new = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], new[bounds]
