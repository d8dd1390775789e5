"""MinHash near-dedup with an LSH forest.

Each text gets its set of distinct word shingles (64-bit hashes) and a signature of
``TREES * DEPTH`` minima. Texts with equal sets form one class, and its smallest doc_id stands
for it. Each tree is one order of the signature; all class rows are range-sorted by it, and
rows next to each other whose longest common prefix has at least ``DEPTH`` values are
candidates. The depth adapts to the region: where few rows share the prefix, all of them are
paired with each other; in a dense region a row is paired only with its ``NEAR`` neighbours on
each side, which are those with the longest common prefixes. Range sorting splits a region of
any size over many tasks. Candidates are confirmed on the full sets: first each row's most
promising one, then all others that lie in different components so far (a pair inside one
component cannot change the result).

A candidate also agrees in at least ``AGREE`` of the ``KEY`` values of the order, which texts that
merely share a passage seldom do. At a similarity of 0.8 a pair fails that with probability 1e-3,
misses one tree with 0.49 and all 32 with 1e-10.

All rows of dense regions then take an exact path, which looks only between components known so
far. Sets are ordered by one global order, rare shingles first; two sets of enough similarity have
their first common shingle in a prefix of both, whose length follows from their sizes alone. The
order comes from a sample, which bears on the work and not on the result. Rows that share a
prefix shingle held by at most ``HOT`` rows are joined; those of hotter shingles form groups, dealt
over pairs of blocks of about ``BLOCK`` rows, in which all sets are compared by a matrix product.

Defined results: a null text counts as empty; a text without words has no shingles, is linked
with nothing and is its own component; rows that repeat one doc_id with one set share a decision, those with
different texts are linked each by its own set; a null doc_id is never linked and its row stays; a very long text is one set, whole; of equal similarities
any one joins two components, which has no bearing on the result; an empty table gives an empty result; extra columns pass through
``drop_near_duplicates``, whatever they are called, and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm import wordhash
from logscope.llm.common import keep_table, map_arrow, text_digest, whole_text, without_rows
from logscope.llm.graph import components

TREES, DEPTH, KEY = 32, 3, 16        # trees, least common prefix, values in a sort key
NEAR, SMALL = 6, 12                 # neighbours in dense regions, rows of a region that is not dense
HOT, BLOCK, WIDE = 64, 256, 4        # rows of a hot shingle, rows of a block, a group's rows to its hottest shingle's
ORDERED, LISTED = 10_000, 1 << 17    # rows whose shingles are counted for the global order, shingles it lists
OTHER = -(1 << 62)                   # classes of another text under a doc_id that stands for a class already are numbered from here down
AGREE = 9                            # of a key's values that a candidate shares at least, in any places
_SIZE = TREES * DEPTH
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, _SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, raw, offs in wordhash.text_runs(batch.column(1)):
                hashes, bounds = wordhash.shingle_sets(raw, offs, k)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                sig = np.zeros((len(sizes), _SIZE), np.uint16)
                if len(full):
                    for p in range(_SIZE):
                        low = np.minimum.reduceat((hashes * _FACTORS[p]) >> np.uint64(32), bounds[full])
                        sig[full, p] = low.astype(np.uint16)
                view = memoryview(hashes).cast("B")
                digests = [hashlib.blake2b(view[8 * a:8 * b], digest_size=16).digest()
                           for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(sizes)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([r.tobytes() for r in sig], pa.binary()), batch.column(2).slice(first, len(sizes))],
                    ["doc_id", "n_shingles", "digest", "sig", "text_digest"])
    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree: the tree, its sort key (big-endian, so that bytes sort as values) and the class."""
    order = (np.arange(TREES)[:, None] * DEPTH + np.arange(KEY)) % _SIZE
    for batch in batches:
        ids = batch.column(0).to_numpy()
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(ids), _SIZE)
        for tree in range(TREES):
            rows = np.ascontiguousarray(sig[:, order[tree]].astype(">u2"))
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * KEY), len(ids), [None, pa.py_buffer(rows.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), tree, np.int32)), keys.cast(pa.binary()), pa.array(ids)], ["tree", "key", "id"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates among rows sorted by tree and key, and each row of a dense region as a pair with itself;
    the last rows of a batch are carried into the next."""
    held = None
    for batch in batches:
        tree = batch.column(0).to_numpy().astype(np.uint16)
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(len(tree), KEY).astype(np.uint16)
        rows, ids = np.column_stack([tree, keys]), batch.column(2).to_numpy()
        old = 0
        if held is not None:
            old = len(held[1])
            rows, ids = np.vstack([held[0], rows]), np.concatenate([held[1], ids])
        n = len(ids)
        # The rows before were seen with each other already; here the later row of a pair is new.
        far = np.zeros(n, bool)      # SMALL rows back is still the same region: it is dense
        if n > SMALL:
            far[SMALL:] = (rows[SMALL:, :DEPTH + 1] == rows[:-SMALL, :DEPTH + 1]).all(1)
        dense = far.copy()
        for step in range(1, min(SMALL + 1, n)):
            dense[:-step] |= far[step:]
        if dense.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[dense]), pa.array(ids[dense]), pa.array(np.zeros(int(dense.sum()), np.int32))], ["a", "b", "common"])
        for step in range(1, min(SMALL, n)):
            later = np.arange(max(old, step), n)
            if step > NEAR:
                later = later[~far[later]]
            same = rows[later] == rows[later - step]
            common = np.where(same.all(1), KEY + 1, same.argmin(1)) - 1
            hit = (common >= DEPTH) & (same[:, 1:].sum(1) >= AGREE)
            x, y = ids[later[hit]], ids[later[hit] - step]
            if hit.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(common[hit].astype(np.int32))],
                    ["a", "b", "common"])
        held = rows[-SMALL:], ids[-SMALL:]


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offs in wordhash.text_runs(batch.column(1)):
                hashes, bounds = wordhash.shingle_sets(raw, offs, k)
                view = memoryview(hashes).cast("B")
                sets = [bytes(view[8 * a:8 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array(sets, pa.binary())],
                                                 ["id", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
    return run


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), np.int64))], ["token"])


def _prefixes(percent: int, listed: np.ndarray, counts: np.ndarray):
    """The rarest shingles of each set, as many as another set of enough similarity can lack, and one more.

    ``early``: also among those that a set at least as large can lack.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, comps, tokens, early, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy(), [], [], []
            for x in batch.column(2):
                h = np.frombuffer(x.as_buffer(), np.uint64)
                rank = np.zeros(len(h), np.int64)
                if len(listed):
                    at = np.minimum(np.searchsorted(listed, h), len(listed) - 1)
                    rank = np.where(listed[at] == h, counts[at], 0)
                n = min(len(h), len(h) + 1 + -percent * len(h) // 100)
                tokens.append(h[np.lexsort((h, rank))[:n]].view(np.int64))
                early.append(np.arange(n) < len(h) + 1 + -2 * percent * len(h) // (100 + percent))
                sizes.append(n)
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(np.repeat(ids, sizes)), pa.array(np.repeat(comps, sizes)),
                     pa.array(np.concatenate(early))], ["token", "id", "c", "early"])
    return run


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of each of ``x`` with each of ``y``."""
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    out = np.zeros((len(x), len(y)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, h = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, h), max(len(both) - 1, 0))
        hit = both[at] == h if len(both) else np.zeros(len(h), bool)
        return row[hit], at[hit]

    (xr, xc), (yr, yc) = places(x), places(y)
    for first in range(0, len(both), 4096):
        one, two = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
        for m, r, c in ((one, xr, xc), (two, yr, yc)):
            here = (c >= first) & (c < first + 4096)
            m[r[here], c[here] - first] = 1
        out += one @ two.T
    return out


def _blocks(percent: int):
    """Links between components in each pair of blocks, as many as tell which of them belong together."""
    def found(held: list[tuple[int, int, int, np.ndarray]], one: bool) -> pa.RecordBatch | None:
        x = [h for h in held if h[0] == 0]
        y = x if one else [h for h in held if h[0] == 1]
        if not x or not y or len({h[2] for h in held}) < 2:
            return None
        sizes = [np.array([len(h[3]) for h in side], np.int64) for side in (x, y)]
        comps = [np.array([h[2] for h in side], np.int64) for side in (x, y)]
        common = np.rint(_overlaps([h[3] for h in x], [h[3] for h in y])).astype(np.int64)
        total = sizes[0][:, None] + sizes[1][None, :] - common
        near = (100 * common >= percent * total) & (comps[0][:, None] != comps[1][None, :])
        up: dict[int, int] = {}
        a, b = [], []
        for i, j in np.argwhere(near).tolist():
            p, q = x[i][2], y[j][2]
            while p in up:
                p = up[p]
            while q in up:
                q = up[q]
            if p != q:
                up[max(p, q)] = min(p, q)
                a.append(min(x[i][1], y[j][1]))
                b.append(max(x[i][1], y[j][1]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]) if a else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for key, side, id_, c, x in zip(keys, *(batch.column(i).to_pylist() for i in (4, 5, 6)), batch.column(7)):
                if key != at:
                    if at and (out := found(held, at[2] == at[3])):
                        yield out
                    at, held = key, []
                held.append((side, id_, c, np.frombuffer(x.as_py(), np.uint64)))
        if at and (out := found(held, at[2] == at[3])):
            yield out
    return run


def _exact(sets: DataFrame, dense: DataFrame, known: DataFrame, percent: int, confirmed) -> DataFrame | None:
    """Links (a, b) among the rows of dense regions that lie in different components (n, c) so far."""
    n = dense.count()
    if not n:
        return None
    spark, parts = sets.sparkSession, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.join(dense.hint("merge"), "id", "left_semi")
    some = map_arrow(rows.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // ORDERED))) == 0).select("shingles"), _single, "token long")
    top = some.groupBy("token").count().where("count > 1").orderBy(F.desc("count"), "token").limit(LISTED).toArrow()
    listed, counts = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(listed)
    placed = rows.join(known, rows.id == known.n, "left").select("id", F.coalesce("c", "id").alias("c"), "shingles")
    prefix = keep_table(map_arrow(placed, _prefixes(percent, listed[order], counts[order]),
                                  "token long, id long, c long, early boolean"), "shingle-prefixes")
    mixed = prefix.groupBy("token", "c").agg(F.count(F.lit(1)).alias("n"), F.max("early").alias("early")) \
        .groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps"), F.max("early").alias("any"),
                              F.max_by("c", "n").alias("major")).where("comps > 1 AND any")
    live = keep_table(prefix.join(mixed.select("token", "n", "major").hint("merge"), "token"), "prefixes-mixed")
    # Of two components one is not the shingle's largest.
    few = live.where(F.col("n") <= HOT)
    x, y = few.select("token", "id", "c", "early"), few.where("c != major").toDF("token", "id2", "c2", "early2", "n2", "major2")
    pairs = x.join(y.hint("merge"), "token").where("c != c2 AND (early OR early2)") \
        .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
    out = confirmed(pairs, "links-rare")
    hot = live.where(F.col("n") > HOT).select("token", "id", "c", "n")
    if hot.isEmpty():
        return out
    # Hot shingles that meet in a prefix form one group; where that is much larger than each, they stay apart.
    first = hot.groupBy("id").agg(F.min("token").alias("first"))
    edges = hot.join(first, "id").where("token != first").select(F.col("token").alias("a"), F.col("first").alias("b")).distinct()
    whole = components(edges).select(F.col("node").alias("token"), F.col("component").alias("g"))
    # Groups are sized by way of the shingles, so that no group's rows meet in one task.
    named = hot.groupBy("token").agg(F.max("n").alias("n")).join(whole, "token", "left") \
        .join(first.groupBy(F.col("first").alias("token")).agg(F.count(F.lit(1)).alias("firsts")), "token", "left") \
        .select("token", "n", F.coalesce("g", "token").alias("g"), F.coalesce("firsts", F.lit(0)).alias("firsts"))
    group = named.groupBy("g").agg(F.sum("firsts").alias("rows"), F.max("n").alias("most"))
    wide = F.col("rows") > WIDE * F.col("most")
    dealing = keep_table(named.join(group, "g").select(
        "token", wide.alias("wide"), F.when(wide, F.col("token")).otherwise(F.col("g")).alias("g"),
        F.ceil(F.when(wide, F.col("n")).otherwise(F.col("rows")) / BLOCK).cast("int").alias("blocks")), "hot-shingles")
    member = keep_table(hot.join(dealing, "token").select("wide", "g", "blocks", "id", "c").distinct(), "hot-groups")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = member.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")) \
        .select("wide", "g", "own", "id", "c", other) \
        .select("wide", "g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "c")
    met = dealt.join(sets.hint("merge"), "id").select("wide", "g", "i", "j", "side", "id", "c", "shingles") \
        .repartition(parts, "wide", "g", "i", "j").sortWithinPartitions("wide", "g", "i", "j")
    return out.unionByName(keep_table(map_arrow(met, _blocks(percent), "a long, b long").distinct(), "links-hot"))


def _numbered(classes: DataFrame) -> tuple[DataFrame, bool]:
    """``classes`` with different ids, and whether some had to be made up: a doc_id may stand for several texts."""
    often = classes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if often.isEmpty():
        return classes, False
    repeated = classes.join(often, "id", "left_semi").groupBy(F.col("id").alias("r_id")).agg(F.min("digest").alias("first"))
    other = F.lit(OTHER) - F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1))
    named = classes.join(repeated, F.col("id") == F.col("r_id"), "left") \
        .withColumn("id", F.when(F.col("r_id").isNull() | (F.col("digest") == F.col("first")), F.col("id")).otherwise(other))
    return keep_table(named.drop("r_id", "first"), "set-classes"), True


def links(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") \
        -> tuple[DataFrame, DataFrame, bool]:
    """(members, links, made up): members (doc_id, n_shingles, class_id, text_digest) of every document, links (a, b) between
    class representatives that join what confirmed links join, and whether some representatives are no doc_id."""
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"), text_digest(text).alias("text_digest"))
    rows = keep_table(map_arrow(body, _signatures(k), "doc_id long, n_shingles long, digest binary, sig binary, text_digest long"),
                      "signatures")
    real = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("digest").agg(F.min(F.struct("doc_id", "text_digest")).alias("r"), F.first("sig").alias("sig")) \
                  .select("digest", F.col("r.doc_id").alias("id"), F.col("r.doc_id").alias("rep"), F.col("r.text_digest").alias("rep_text"), "sig")
    classes, made_up = _numbered(keep_table(classes, "set-classes"))
    named = classes.select(F.col("digest").alias("c_digest"), F.col("id").alias("class_id"))
    members = rows.join(named, (rows.digest == named.c_digest) & (rows.n_shingles > 0) & rows.doc_id.isNotNull(), "left") \
                  .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), "text_digest")
    forest = map_arrow(classes.select("id", "sig"), _keys, "tree int, key binary, id long")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = forest.repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    pairs = map_arrow(ordered, _neighbours, "a long, b long, common int")
    seen = keep_table(pairs.groupBy("a", "b").agg(F.struct(F.count(F.lit(1)), F.sum("common")).alias("weight")), "candidates")
    pairs, dense = seen.where("a != b"), seen.where("a = b").select(F.col("a").alias("id"))
    # The list grows with the corpus: joined by shuffle at every size, never sent to all tasks.
    ids = seen.select(F.explode(F.array("a", "b")).alias("id")).distinct().hint("merge")
    if made_up:
        ids = ids.join(classes.select("id", "rep", "rep_text"), "id")
        wanted = body.join(ids.hint("merge"), (body.doc_id == ids.rep) & (body.text_digest == ids.rep_text)).select("id", "body")
    else:
        wanted = body.join(ids, body.doc_id == ids.id, "left_semi").select("doc_id", "body")
    sets = keep_table(map_arrow(wanted, _sets(k), "id long, shingles binary"), "shingle-sets")

    def confirmed(some: DataFrame, label: str) -> DataFrame:
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        both = some.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return keep_table(map_arrow(both, _confirm(percent), "a long, b long"), label)

    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("weight", -F.col("a"))).alias("a"))
    # A component so far is known by its stars: the next contraction starts from them instead of from all links.
    stars = components(confirmed(best, "links-best")).select(F.col("node").alias("a"), F.col("component").alias("b"))
    known = stars.toDF("n", "c")
    rest = pairs.select("a", "b").join(known.select(F.col("n").alias("a"), F.col("c").alias("ca")), "a", "left") \
                .join(known.select(F.col("n").alias("b"), F.col("c").alias("cb")), "b", "left") \
                .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")) \
                .join(best, ["a", "b"], "left_anti")
    stars = components(stars.unionByName(confirmed(rest, "links-rest"))).select(F.col("node").alias("a"), F.col("component").alias("b"))
    more = _exact(sets, dense, stars.toDF("n", "c"), percent, confirmed)
    return members, stars if more is None else stars.unionByName(more), made_up


def _decided(docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    members, found, made_up = links(docs, k, percent, doc_id, text)
    part = components(found).select(F.col("node").alias("n"), F.col("component"))
    rows = members.join(part, members.class_id == part.n, "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"), "text_digest")
    if made_up:                          # a component is named by its smallest doc_id
        rows = keep_table(rows, "near-rows")
        least = rows.where(F.col("component_id") <= OTHER).groupBy(F.col("component_id").alias("c")).agg(F.min("doc_id").alias("least"))
        rows = rows.join(least, rows.component_id == least.c, "left").withColumn("component_id", F.coalesce("least", "component_id"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"), "text_digest")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per input row."""
    return _decided(docs, k, percent, doc_id, text).drop("text_digest")


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, that with the smallest doc_id."""
    return without_rows(docs, doc_id, text, _decided(docs, k, percent, doc_id, text).where("NOT kept").select("doc_id", "text_digest"))
