"""Document fingerprints: a Merkle tree of paragraphs and sections.

A paragraph is a line, and its node the hash of its exact bytes. A section is a run of paragraphs that ends at a blank
line or at a paragraph whose hash ends in three zero bits, so that an insertion moves no later boundary; its
node is the hash of its paragraphs' nodes, and the root that of the sections' nodes. So equal roots mean equal texts, and two
trees are compared from the root down, into unequal nodes only. Below a paragraph are the hashes of its spans of ``SPAN`` words; the first
``SINGLE`` words of a text are spans of their own, bound to their place, so that short texts have several. They say where in
a paragraph an edit is, and how alike two texts are.

The serialised fingerprint holds all nodes: ``root|section|section``, a section being ``node:paragraph,paragraph`` and a
paragraph its node (``NODE`` hex digits) and its spans (``LEAF`` each). So two fingerprints tell where texts differ without the texts.

``neighbour_edits`` pairs each document with the next one in descending doc_id without a global
sort in one task: quantile bounds deal the ids out to buckets, and the one document that the
end of a bucket needs from the next bucket is sent along as a guest.

Defined results: a null text counts as empty; the empty text is one empty paragraph and has no spans; two
texts without spans are alike (1.0) if equal, else 0.0; texts that differ in white space alone are less than 1.0 alike; a very long
text has as large a tree as it needs, in one task; rows that repeat a doc_id follow each
other in the order of their texts, equal texts in any order; a null doc_id comes after all others; a table of one row is
its own next document; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.llm.common import map_arrow, whole_text

SPAN, SINGLE = 6, 8
NODE, LEAF = 16, 12      # hex digits of a stored node, and of a span
BUCKETS = 3              # per shuffle partition
_ROWS = 512              # rows that Python holds as strings at a time
_PARAGRAPH, _SECTION, _ROOT = b"p", b"s", b"r"       # what a hash is of, so that no node can stand for another kind


def _node(kind: bytes, content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16, person=kind).digest()


def fingerprint(text: str) -> str:
    """The serialised Merkle tree of a text."""
    digest, place = xxhash.xxh64_hexdigest, 0
    sections, nodes, open_nodes, open_texts = [], [], [], []

    def close() -> None:
        nodes.append(_node(_SECTION, b"".join(open_nodes)))
        sections.append(f"{nodes[-1].hex()[:NODE]}:{','.join(open_texts)}")
        open_nodes.clear()
        open_texts.clear()

    for line in text.split("\n"):
        node, words = _node(_PARAGRAPH, line.encode()), line.split()
        spans = []
        for word in words[:max(0, SINGLE - place)]:
            spans.append(digest(f"{place} {word}")[:LEAF])
            place += 1
        for i in range(len(spans), len(words), SPAN):
            spans.append(digest(" ".join(words[i:i + SPAN]))[:LEAF])
        open_nodes.append(node)
        open_texts.append(node.hex()[:NODE] + "".join(spans))
        if not words or node[-1] & 7 == 0:
            close()
    if open_nodes:
        close()
    return "|".join([_node(_ROOT, b"".join(nodes)).hex(), *sections])


def tree(printed: str) -> tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]:
    """(root, [(section, [(paragraph, [span])])]) of a serialised fingerprint."""
    root, *sections = printed.split("|")
    out = []
    for s in sections:
        node, _, paragraphs = s.partition(":")
        out.append((node, [(p[:NODE], [p[i:i + LEAF] for i in range(NODE, len(p), LEAF)]) for p in paragraphs.split(",")]))
    return root, out


def _spans(printed: str) -> list[str]:
    return [span for _, paragraphs in tree(printed)[1] for _, spans in paragraphs for span in spans]


def likeness(a: str, b: str) -> float:
    """Share of spans that two fingerprints have in common: 1.0 for equal texts, and for these alone."""
    if a.partition("|")[0] == b.partition("|")[0]:
        return 1.0
    x, y = Counter(_spans(a)), Counter(_spans(b))
    total = x.total() + y.total()
    return min(2 * (x & y).total() / total, total / (total + 1)) if total else 0.0


def differing(a: str, b: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, span) of ``a`` that ``b`` lacks, from the root down; equal nodes are not looked into.

    Span -1 stands for a paragraph whose words ``b`` has, but with other white space between, or in another order.
    """
    (root, sections), (other_root, others) = tree(a), tree(b)
    if root == other_root:
        return []
    known = {node for node, _ in others}
    paragraphs = {node for _, ps in others for node, _ in ps}
    leaves = {span for _, ps in others for _, spans in ps for span in spans}
    out = []
    for i, (node, ps) in enumerate(sections):
        if node not in known:
            for j, (paragraph, spans) in enumerate(ps):
                if paragraph not in paragraphs:
                    out += [(i, j, k) for k, span in enumerate(spans) if span not in leaves] or [(i, j, -1)]
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), _ROWS):
                part = batch.slice(i, _ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([fingerprint(t) for t in part.column(1).to_pylist()], pa.string())],
                    ["doc_id", "fingerprint"])
    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body")),
                     run, "doc_id long, fingerprint string")


def _bucket(bounds: list[int], value: Column) -> Column:
    """How many bounds are smaller, by two short scans of about the root of their number each."""
    step = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)] or [[]]
    longs = [F.array(*[F.lit(b) for b in c]).cast("array<bigint>") for c in chunks] + [F.array().cast("array<bigint>")]
    tops = F.array(*[F.lit(c[-1]) for c in chunks if c]).cast("array<bigint>")
    chunk = F.size(F.filter(tops, lambda b: b < value))
    within = F.size(F.filter(F.element_at(F.array(*longs), chunk + 1), lambda b: b < value))
    return F.when(value.isNull(), F.lit(-1)).otherwise(chunk * step + within)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None         # bucket, doc_id, text, fingerprint of the row that waits for its next
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for batch in batches:
        for i in range(0, len(batch), _ROWS):
            out = []
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.slice(i, _ROWS).columns)):
                if guest and held is None:
                    continue        # a guest whose place was taken by a row that repeats it
                print_ = fingerprint(text)
                if held is not None:
                    _, own_id, own, own_print = held
                    part = len(own) // 3
                    edited = own[:len(own) - part] + text[:part]
                    edited_print = own_print if edited == own else fingerprint(edited)
                    out.append((own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_print, edited_print,
                                likeness(own_print, edited_print), likeness(own_print, print_)))
                held = None if guest else (bucket, doc_id, text, print_)
            if out:
                columns = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def neighbour_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (its last third replaced by the
    beginning of the next document in descending doc_id), and the likeness of both and of the next."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    n = BUCKETS * parts
    found = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    bucket = _bucket(sorted(set(found or [])), F.col("doc_id"))
    # At most one row per bucket reaches the driver.
    tops = ids.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    guests = [(r.top, after.bucket) for r, after in zip(tops, tops[1:] + tops[:1])]
    known = F.broadcast(spark.createDataFrame(guests, "top long, goes_to int"))      # one row per bucket
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"), ) \
               .withColumn("bucket", bucket).join(known, F.col("doc_id").eqNullSafe(F.col("top")), "left")
    places = F.filter(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
                              F.when(F.col("goes_to").isNotNull(), F.struct(F.col("goes_to").alias("bucket"), F.lit(True).alias("guest")))),
                      lambda x: x.isNotNull())
    dealt = rows.select(F.explode(places).alias("at"), "doc_id", "body") \
                .select("at.bucket", "at.guest", "doc_id", "body") \
                .repartition(parts, "bucket") \
                .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "body")
    return map_arrow(dealt, _edits, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
