"""Fill-in-the-middle transformation by displacement scatter, and its inverse by gather.

A text is cut at two places between its tokens into prefix, middle and suffix, and its parts
are written in another order behind marks, so that a left-to-right model learns to fill gaps.
A whole block of texts is moved at once: a scan over its bytes finds where tokens end, each part's
shift (its place in the output less that in the input) goes into a difference array, a cumulative
sum turns that into every byte's shift, and one numpy scatter writes all outputs. ``restore``
finds the marks in the outputs alone, builds the same kind of array and gathers the texts.

Where and how a text is cut depends on nothing but ``seed`` and its id, so a lost task's rerun
gives the same rows. Marks are unambiguous: a text that holds one stays plain, and no mark can
arise across the border of a part and a mark.

Defined results: a null or empty text gives an empty plain output, which is restored as the empty text; a null
id is drawn as if its decimal form were empty; rows that repeat an id are cut by the same draws, each
over its own tokens; a very long text is a block of its own; cuts at one place give an empty middle, cuts at an end an empty prefix or suffix; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm import wordhash
from logscope.llm.common import map_arrow, whole_text

SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]
# The letters of the marks <P>, <S> and <M>, before prefix, suffix and middle.
_P, _S, _M = (ord(c) for c in "PSM")
_OPEN, _CLOSE, _MARK = ord("<"), ord(">"), 3


def _token_ends(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the byte after each token, number of tokens of each row); a token is white space and the word
    behind it, or the white space at a text's end."""
    if not len(raw):
        return np.empty(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    space = wordhash.SPACE[raw]
    text_end = np.zeros(len(raw) + 1, bool)
    text_end[offs[1:]] = True
    next_space = np.append(space[1:], True)
    ends = np.flatnonzero(text_end[1:] | (~space & next_space)) + 1
    return ends, np.diff(np.searchsorted(ends, offs, "right"))


def _marks(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, letter, row) of every mark that lies within one row."""
    if len(raw) < _MARK:
        return (np.empty(0, np.int64),) * 3
    letter = raw[1:-1]
    at = np.flatnonzero((raw[:-2] == _OPEN) & (raw[2:] == _CLOSE) & ((letter == _P) | (letter == _S) | (letter == _M)))
    row = np.searchsorted(offs, at, "right") - 1
    inside = at + _MARK <= offs[row + 1]
    return at[inside], letter[at[inside]].astype(np.int64), row[inside]


def _shifts(begin: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    """Every byte's shift: parts begin, in order, at ``begin``, and an empty part leaves no trace."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, begin, np.diff(shift, prepend=0))
    return np.cumsum(step[:-1])


def _texts(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    wide = offs[-1] >= 1 << 31
    kind, where = (pa.large_string(), np.int64) if wide else (pa.string(), np.int32)
    made = pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs.astype(where)), pa.py_buffer(np.ascontiguousarray(data))])
    return made


def _scattered(raw: np.ndarray, offs: np.ndarray, draws: np.ndarray, fim: int, spm: int) -> list:
    """(tokens, form, prefix characters, middle characters, output) of a block's rows."""
    rows, begin, end = len(offs) - 1, offs[:-1], offs[1:]
    ends, n = _token_ends(raw, offs)
    first = np.cumsum(n) - n
    form = np.where(draws[:, 2] % 100 >= fim, PLAIN, np.where(draws[:, 3] % 100 < spm, SPM, PSM))
    form[n == 0] = PLAIN
    form[_marks(raw, offs)[2]] = PLAIN
    moved = form != PLAIN
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    # A token's end by its number in the block; before the first token a cut is where the text begins.
    ends = np.append(ends, 0)
    p, q = (np.where(c > 0, ends[np.minimum(first + c - 1, len(ends) - 1)], begin) for c in cuts.T)
    p, q = np.where(moved, p, end), np.where(moved, q, end)

    size = end - begin + np.where(moved, 3 * _MARK, 0)
    out_offs = np.concatenate([[0], np.cumsum(size)])
    to, prefix, suffix = out_offs[:-1], p - begin, end - q
    to_prefix = to + np.where(form == PSM, _MARK, np.where(form == SPM, 2 * _MARK + suffix, 0))
    to_suffix = to + np.where(form == PSM, 2 * _MARK + prefix, _MARK)
    to_middle = to + 3 * _MARK + prefix + suffix
    parts = np.stack([begin, p, q], axis=1)
    shift = np.where(moved[:, None], np.stack([to_prefix, to_middle, to_suffix], axis=1) - parts, (to - begin)[:, None])
    out = np.empty(out_offs[-1], np.uint8)
    out[np.arange(len(raw)) + _shifts(parts.ravel(), shift.ravel(), len(raw))] = raw
    for letter, at in ((_P, to_prefix), (_S, to_suffix), (_M, to_middle)):
        at = at[moved]
        out[at - 3], out[at - 2], out[at - 1] = _OPEN, letter, _CLOSE

    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [pa.array(n), pa.array(np.array(FORMS, object)[form], pa.string()),
            pa.array(chars[p] - chars[begin], mask=~moved), pa.array(chars[q] - chars[p], mask=~moved),
            _texts(out, out_offs)]


def _transformed(fim: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, 4).astype(np.int64)
            for i, raw, offs in wordhash.text_runs(batch.column(2)):
                rows = len(offs) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, rows), *_scattered(raw, offs, drawn[i:i + rows], fim, spm)],
                                                 ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per row of ``docs``.

    ``n`` counts a text's tokens, ``form`` is plain, psm or spm; the two lengths are code points, null if plain.
    """
    named = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    draws = F.unhex(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), named), 256), 1, 32))
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), draws.alias("draws"), whole_text(text).alias("body"))
    return map_arrow(body, _transformed(fim_percent, spm_percent),
                     "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _gathered(raw: np.ndarray, offs: np.ndarray, moved: np.ndarray) -> pa.Array:
    """The texts that a block of outputs stands for; ``moved`` says which of them are not plain."""
    rows, begin, end = len(offs) - 1, offs[:-1], offs[1:]
    at, letter, row = _marks(raw, offs)
    at, letter, row = (x[moved[row]] for x in (at, letter, row))
    if (np.bincount(row, minlength=rows)[moved] != 3).any():
        raise ValueError("an output has not one mark of each kind")
    place = {}
    for which in (_P, _S, _M):
        place[which] = np.zeros(rows, np.int64)
        place[which][row[letter == which]] = at[letter == which] + _MARK
        if np.count_nonzero(place[which][moved]) != np.count_nonzero(moved):
            raise ValueError("an output has not one mark of each kind")
    p, s, m = place[_P], place[_S], place[_M]
    # Each part ends where the next mark or the output begins.
    prefix = np.where(s > p, s, m) - _MARK - p
    suffix = np.where(s > p, m, p) - _MARK - s
    prefix, suffix = np.where(moved, prefix, end - begin), np.where(moved, suffix, 0)
    middle = np.where(moved, end - m, 0)
    size = prefix + middle + suffix
    out_offs = np.concatenate([[0], np.cumsum(size)])
    to = out_offs[:-1]
    parts = np.stack([to, to + prefix, to + prefix + middle], axis=1)
    source = np.stack([np.where(moved, p, begin), np.where(moved, m, end), np.where(moved, s, end)], axis=1)
    total = int(out_offs[-1])
    back = np.arange(total) + _shifts(parts.ravel(), (source - parts).ravel(), total)
    return _texts(raw[back], out_offs)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names[:-1] + ["restored"]
        moved = np.array(batch.column(batch.num_columns - 2).to_pylist(), object) != FORMS[PLAIN]
        for i, raw, offs in wordhash.text_runs(batch.column(batch.num_columns - 1)):
            rows = len(offs) - 1
            kept = [batch.column(c).slice(i, rows) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, _gathered(raw, offs, moved[i:i + rows])], names)


def restore(coded: DataFrame, form: str = "form", output: str = "output") -> DataFrame:
    """``coded`` with the column ``restored``, the text that ``form`` and ``output`` alone stand for.

    A null form counts as plain; an output of another form that has not one mark of each kind is an error.
    """
    rest = [c for c in coded.columns if c not in ("restored", "_form", "_output")]
    rows = coded.select(*rest, F.coalesce(F.col(form), F.lit(FORMS[PLAIN])).alias("_form"), whole_text(output).alias("_output"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, _restored, f"{schema}, restored string").drop("_form")
