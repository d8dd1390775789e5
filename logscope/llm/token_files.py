"""Token ids of a corpus as flat binary files with 64-bit document offsets, memory-mapped by readers.

A data set is a folder in the shared store:

* ``<name>.bin``  the ids of consecutive documents, one after the other, little-endian unsigned 16-bit
  (vocabularies up to 65,536) or 32-bit integers, nothing else;
* ``<name>.idx``  a header of four 64-bit integers (``MAGIC``, documents, documents without an id,
  bytes of an id), then documents + 1 unsigned 64-bit offsets into the ``.bin`` (in ids), then
  the documents' 64-bit ids, those without one first, as 0;
* ``manifest.json`` the files in order with the number of the first document and the first id of each:
  the prefix sums over what the files hold. It is written last; a folder without it is no data set.

Documents are range-partitioned and sorted by id in Spark. Every task encodes its range and writes files of at
most ``FILE_TOKENS`` ids or ``FILE_DOCS`` documents under names of its own; which attempt's files count is
decided by Spark's commit of the task's rows, so a lost executor or a second attempt leaves only files
that nobody names, and those are deleted at the end. The driver sees one row per file.

Defined results: a null or empty text has the end id only; rows without an id come first; rows that repeat an
id are all written, in the order of their texts' hashes (equal rows are alike); many rows of one id are split
over tasks; a very long text is encoded by itself and may make a file longer than ``FILE_TOKENS``; an empty table gives a
manifest without files; extra columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.llm import packing
from logscope.llm.common import keep_table, map_arrow, whole_text

TOKENIZER, END = packing.TOKENIZER, 2
FILE_TOKENS, FILE_DOCS = 1 << 28, 1 << 20
SLICE_DOCS = 2048                     # documents that a reading task takes at a time
MAGIC, _HEADER = 0x53454C49464B4F54, 4
MANIFEST = "manifest.json"
_FILE = "task long, nth long, name string, docs long, nulls long, tokens long, first_id long, last_id long"


def _open(folder: str):
    return arrow_fs.FileSystem.from_uri(folder)


class _Writer:
    """The open files of one task."""

    def __init__(self, folder: str, task: int, kind: str, file_tokens: int, file_docs: int):
        self.fs, self.root = _open(folder)
        self.task, self.kind, self.limits = task, kind, (file_tokens, file_docs)
        self.out, self.rows = None, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.out is not None and (self.at >= self.limits[0] or len(self.ids) >= self.limits[1]):
            self.close()
        if self.out is None:
            self.name = f"part-{self.task:06d}-{len(self.rows):04d}-{uuid.uuid4().hex[:12]}"
            self.out, self.at, self.offsets, self.ids = self.fs.open_output_stream(f"{self.root}/{self.name}.bin"), 0, [0], []
        self.out.write(ids)
        self.at += len(ids) // np.dtype(self.kind).itemsize
        self.offsets.append(self.at)
        self.ids.append(doc_id)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        known = [d for d in self.ids if d is not None]
        nulls = len(self.ids) - len(known)
        with self.fs.open_output_stream(f"{self.root}/{self.name}.idx") as out:
            out.write(np.array([MAGIC, len(self.ids), nulls, np.dtype(self.kind).itemsize], "<i8").tobytes())
            out.write(np.array(self.offsets, "<u8").tobytes())
            out.write(np.array([0] * nulls + known, "<i8").tobytes())
        self.rows.append((self.task, len(self.rows), self.name, len(self.ids), nulls, self.at,
                          known[0] if known else None, known[-1] if known else None))
        self.out = None


def _written(folder: str, tokenizer: str, end: int, file_tokens: int, file_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = packing.load(tokenizer, end)
        writer = _Writer(folder, TaskContext.get().partitionId(), tokens.kind, file_tokens, file_docs)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1).to_pylist())):
                writer.add(doc_id, ids)
        writer.close()
        columns = list(zip(*writer.rows)) if writer.rows else [[]] * 8
        kinds = [pa.string() if i == 2 else pa.int64() for i in range(8)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         ["task", "nth", "name", "docs", "nulls", "tokens", "first_id", "last_id"])
    return run


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END, doc_id: str = "doc_id", text: str = "text",
          file_tokens: int = FILE_TOKENS, file_docs: int = FILE_DOCS) -> dict:
    """Write the ids of all ``docs`` in ascending order of their ids to a new ``folder``; returns the manifest."""
    at, root = _open(folder)
    if at.get_file_info(f"{root}/{MANIFEST}").type != arrow_fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds a data set")
    at.create_dir(root, recursive=True)
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    # Rows of one id are told apart by their texts and, where these are equal, by their places, so no range is larger for them.
    keyed = body.select("doc_id", "body", F.xxhash64("body").alias("tie"), F.monotonically_increasing_id().alias("place"))
    dealt = keyed.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie").select("doc_id", "body")
    files = keep_table(map_arrow(dealt, _written(folder, tokenizer, end, file_tokens, file_docs), _FILE), "token-files")
    rows = sorted(files.collect(), key=lambda r: (r.task, r.nth))                # one row per file
    manifest = {"version": 1, "kind": packing.load(tokenizer, end).kind, "end": end, "files": []}
    base_doc = base = 0
    last = None
    for r in rows:
        if last is not None and (r.nulls or (r.first_id is not None and r.first_id < last)):
            raise RuntimeError(f"{r.name} does not follow the files before it")
        manifest["files"].append({"name": r.name, "docs": r.docs, "nulls": r.nulls, "tokens": r.tokens, "first_id": r.first_id,
                                  "last_id": r.last_id, "base_doc": base_doc, "base": base})
        base_doc, base = base_doc + r.docs, base + r.tokens
        last = r.last_id if r.last_id is not None else last
    manifest |= {"docs": base_doc, "tokens": base}
    named = {r.name for r in rows}
    for info in at.get_file_info(arrow_fs.FileSelector(root)):
        if info.base_name.rpartition(".")[0] not in named:
            at.delete_file(info.path)                                            # of an attempt that was not committed
    with at.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def manifest(folder: str) -> dict:
    at, root = _open(folder)
    with at.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


class _Part:
    """One pair of files; memory-mapped on a local or mounted file system, read in ranges elsewhere."""

    def __init__(self, at, path: str, kind: str):
        def opened(name):
            return pa.memory_map(name) if isinstance(at, arrow_fs.LocalFileSystem) else at.open_input_file(name)
        self.bin, self.idx, self.kind = opened(f"{path}.bin"), opened(f"{path}.idx"), np.dtype(kind)
        magic, self.docs, self.nulls, width = np.frombuffer(self.idx.read_at(8 * _HEADER, 0), "<i8").tolist()
        if magic != MAGIC or width != self.kind.itemsize or self.bin.size() != width * int(self.offsets(self.docs, self.docs + 1)[0]):
            raise ValueError(f"{path} is not a pair of files of this data set")

    def offsets(self, first: int, stop: int) -> np.ndarray:
        return np.frombuffer(self.idx.read_at(8 * (stop - first), 8 * (_HEADER + first)), "<u8").astype(np.int64)

    def doc_ids(self, first: int, stop: int) -> np.ndarray:
        return np.frombuffer(self.idx.read_at(8 * (stop - first), 8 * (_HEADER + self.docs + 1 + first)), "<i8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """A view of the mapped file: nothing is copied."""
        return np.frombuffer(self.bin.read_at(self.kind.itemsize * (stop - start), self.kind.itemsize * start), self.kind)

    def close(self) -> None:
        self.bin.close()
        self.idx.close()


class TokenFiles:
    """Random access to a data set from one process, as a training loader needs it."""

    def __init__(self, folder: str):
        self.manifest = manifest(folder)
        self.fs, self.root = _open(folder)
        self.base_docs = np.array([f["base_doc"] for f in self.manifest["files"]], np.int64)
        self.bases = np.array([f["base"] for f in self.manifest["files"]], np.int64)
        self._parts: dict[int, _Part] = {}

    def __len__(self) -> int:
        return self.manifest["docs"]

    def _part(self, i: int) -> _Part:
        if i not in self._parts:
            self._parts[i] = _Part(self.fs, f"{self.root}/{self.manifest['files'][i]['name']}", self.manifest["kind"])
        return self._parts[i]

    def __getitem__(self, doc: int) -> np.ndarray:
        """The ids of the document with this number, counted from 0 in the order of the data set."""
        if not 0 <= doc < len(self):
            raise IndexError(doc)
        i = int(np.searchsorted(self.base_docs, doc, "right")) - 1
        start, stop = self._part(i).offsets(doc - self.base_docs[i], doc - self.base_docs[i] + 2).tolist()
        return self._part(i).ids(start, stop)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids by their places in the whole data set, across files."""
        out, start, stop = [], max(0, start), min(stop, self.manifest["tokens"])
        while start < stop:
            i = int(np.searchsorted(self.bases, start, "right")) - 1
            end = min(stop, int(self.bases[i]) + self.manifest["files"][i]["tokens"])
            out.append(self._part(i).ids(start - int(self.bases[i]), end - int(self.bases[i])))
            start = end
        return np.concatenate(out) if out else np.empty(0, self.manifest["kind"])

    def find(self, doc_id: int) -> int:
        """The number of the first document with this id; KeyError if there is none."""
        for i, f in enumerate(self.manifest["files"]):
            if f["last_id"] is not None and f["first_id"] <= doc_id <= f["last_id"]:
                ids = self._part(i).doc_ids(f["nulls"], f["docs"])
                at = int(np.searchsorted(ids, doc_id))
                if at < len(ids) and ids[at] == doc_id:
                    return f["base_doc"] + f["nulls"] + at
        raise KeyError(doc_id)

    def close(self) -> None:
        for part in self._parts.values():
            part.close()


def _slices(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    """(name, base, first document, document to stop at): the manifest's files, cut into bounded slices."""
    known = manifest(folder)
    files = spark.createDataFrame([(f["name"], f["base"], f["docs"]) for f in known["files"]], "name string, base long, docs long")
    cut = files.select("name", "base", "docs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(SLICE_DOCS).cast("long"))).alias("first"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut.select("name", "base", "first", F.least(F.col("first") + SLICE_DOCS, "docs").alias("stop")) \
        .repartition(parts, "name", "first"), known["kind"]


def _read(folder: str, kind: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, root = _open(folder)
        for batch in batches:
            for name, base, first, stop in zip(*(c.to_pylist() for c in batch.columns)):
                part = _Part(at, f"{root}/{name}", kind)
                offsets = part.offsets(first, stop + 1)
                doc_ids = pa.array(part.doc_ids(first, stop), mask=np.arange(first, stop) < part.nulls)
                size = np.diff(offsets)
                pieces = (part.ids(a, b).astype("<u4").tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                if not whole:
                    columns = [pa.array(np.fromiter((zlib.crc32(x) for x in pieces), np.int64, len(size)))]
                    yield pa.RecordBatch.from_arrays([doc_ids, pa.array(offsets[:-1] + base), pa.array(size), *columns],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])
                else:
                    for i, x in enumerate(pieces):
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.slice(i, 1), pa.array([int(offsets[i]) + base]), pa.array([int(size[i])]), pa.array([x], pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"])
                part.close()
    return run


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    slices, kind = _slices(spark, folder)
    return map_arrow(slices, _read(folder, kind, False), "doc_id long, start long, n_tokens long, ids_crc32 long")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, read from the files; ids as little-endian 32-bit integers."""
    slices, kind = _slices(spark, folder)
    return map_arrow(slices, _read(folder, kind, True), "doc_id long, start long, n_tokens long, ids binary")
