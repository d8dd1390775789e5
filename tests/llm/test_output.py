"""Token files, fill-in-the-middle and ranked search against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from helpers import LOWER, SCHEMA, documents, empty_documents, odd_documents, odd_rows, row
from logscope.llm import infill, packing, queries, ranked_search, token_files, wordhash
from logscope.llm.common import keep_folder

TOKENS = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


# ---------------------------------------------------------------- token files

def _ids(text):
    return TOKENS.encode(text or "", add_special_tokens=False).ids + [token_files.END]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_query(spark):
    got = {r.doc_id: r for r in queries.op11_token_files(spark, SF_SMALL).collect()}
    start = 0
    for r in sorted(documents(spark, SF_SMALL).collect(), key=lambda r: r.doc_id):
        ids = _ids(r.text)
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), _crc(ids))
        start += len(ids)
    assert len(got) == documents(spark, SF_SMALL).count()


SPECIAL = [row(40, "a <|endoftext|> b"), row(41, "<|endoftext|>"), row(42, "𝒳😀 <|endoftext"), row(43, "퟿￿𐀀")]


def test_token_files_odd_rows_and_many_files(spark):
    rows = odd_rows() + SPECIAL + [row(5, "another text of an id"), row(None, "no id either"), row(None, None)]
    folder = keep_folder(spark, "files")
    made = token_files.write(spark.createDataFrame(rows, SCHEMA).repartition(5), folder, file_tokens=700, file_docs=3)
    assert len(made["files"]) > 8 and made == token_files.manifest(folder)
    got = sorted(token_files.documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4"))) for r in got) == Counter((r[0], tuple(_ids(r[1]))) for r in rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    sums = sorted(token_files.checksums(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.ids_crc32) for r in sums] == [(r.doc_id, zlib.crc32(r.ids)) for r in got]
    files = token_files.TokenFiles(folder)
    whole = np.concatenate([files[i] for i in range(len(files))])
    assert len(files) == len(rows) and files.manifest["tokens"] == len(whole)
    assert (files.tokens(0, len(whole)) == whole).all() and (files.tokens(650, 2100) == whole[650:2100]).all()
    assert files.tokens(9, 9).size == 0 and files[0].base is not None
    for d in {r[0] for r in rows if r[0] is not None}:
        at = files.find(d)
        assert got[at].doc_id == d and got[at - 1].doc_id != d
    for missing in (0, 99, -1):
        with pytest.raises(KeyError):
            files.find(missing)
    with pytest.raises(IndexError):
        files[len(files)]
    files.close()
    with pytest.raises(FileExistsError):
        token_files.write(empty_documents(spark), folder)


def test_a_frequent_id_is_spread_over_tasks(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("the same text").alias("text"))
    folder = keep_folder(spark, "files")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = token_files.write(docs, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(f["first_id"] <= 7 <= f["last_id"] for f in made["files"]) >= 2 and max(f["docs"] for f in made["files"]) < 1000
    assert sorted(r.doc_id for r in token_files.checksums(spark, folder).collect()) == sorted(r.doc_id for r in docs.collect())


def test_files_of_uncommitted_attempts_go(spark, monkeypatch):
    folder, kept = keep_folder(spark, "files"), token_files.keep_table

    def lost_attempt(df, label):
        out = kept(df, label)
        fs, root = token_files._open(folder)
        for end in ("bin", "idx"):
            fs.open_output_stream(f"{root}/part-000000-0000-lost.{end}").close()
        return out
    monkeypatch.setattr(token_files, "keep_table", lost_attempt)
    token_files.write(documents(spark, SF_SMALL), folder)
    fs, root = token_files._open(folder)
    names = {i.base_name for i in fs.get_file_info(token_files.arrow_fs.FileSelector(root))}
    assert not any("lost" in n for n in names) and len(names) == 2 * len(token_files.manifest(folder)["files"]) + 1


def test_token_files_of_nothing(spark):
    folder = keep_folder(spark, "files")
    assert token_files.write(empty_documents(spark), folder)["files"] == []
    assert token_files.checksums(spark, folder).count() == 0 and len(token_files.TokenFiles(folder)) == 0


def test_special_names_have_the_librarys_ids():
    for close in (0, 2):
        tokens = packing.load(token_files.TOKENIZER, close)
        for r in SPECIAL:
            assert np.frombuffer(tokens.encode([r[1]])[0], "<u2").tolist() == TOKENS.encode(r[1], add_special_tokens=False).ids + [close]


# ---------------------------------------------------------------- fill in the middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _infilled(doc_id, text, seed=42):
    text = text or ""
    units = TOKEN.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_infill_query(spark):
    got = {r.doc_id: r for r in queries.op12_fill_in_middle(spark, SF_SMALL).collect()}
    forms = Counter()
    for r in documents(spark, SF_SMALL).collect():
        n, form, pre, mid, out = _infilled(r.doc_id, r.text)
        g = got[r.doc_id]
        assert (g.n, g.form, g.prefix_chars, g.middle_chars) == (n, form, pre, mid)
        assert g.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert g.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        forms[form] += 1
    assert set(forms) == {"plain", "psm", "spm"}


def test_infill_odd_rows(spark):
    rows = odd_rows() + [row(20 + i, t) for i, t in enumerate(["<P>", "a <S> b", "<", "<P <S", "P>", "<<", " x", "x ", "é 日本\t👍", "<M", ">", "a<"])]
    rows += [row(d, "words <P of a <S text >M> <") for d in range(100, 160)]
    coded = infill.transform(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in infill.restore(coded).collect())
    assert got == Counter((r[0], *_infilled(r[0], r[1]), r[1] or "") for r in rows)
    none = infill.restore(infill.transform(empty_documents(spark)))
    assert none.count() == 0 and "restored" in none.columns
    always = infill.transform(odd_documents(spark), seed=7, fim_percent=100, spm_percent=0).collect()
    assert {r.form for r in always} == {"plain", "psm"} and all(r.output == "" or "<" in r.output for r in always if r.form == "plain")


def _block(texts):
    column = pa.array(texts, pa.string())
    return next(wordhash.text_runs(column))[1:] if texts else (np.empty(0, np.uint8), np.zeros(1, np.int64))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([*"ab<>PSM \n\té日", "<P>", "<S", "👍", "\x1c"]), max_size=12).map("".join),
                          st.integers(0, 2 ** 32 - 1), st.integers(0, 2 ** 32 - 1), st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=8))
def test_scatter_and_gather_of_blocks(rows):
    texts = [r[0] for r in rows]
    raw, offs = _block(texts)
    n, form, pre, mid, out = infill._scattered(raw, offs, np.array([r[1:] for r in rows], np.int64), 70, 50)
    for (text, h1, h2, h3, h4), *got in zip(rows, n.to_pylist(), form.to_pylist(), pre.to_pylist(), mid.to_pylist(), out.to_pylist()):
        units = TOKEN.findall(text)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 >= 70:
            want = [len(units), "plain", None, None, text]
        else:
            want = [len(units), *(["spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"] if h4 < 50 else ["psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"])]
        assert got == want
    raw, offs = _block(out.to_pylist())
    assert infill._gathered(raw, offs, np.array(form.to_pylist(), object) != "plain").to_pylist() == texts


def test_restore_refuses_broken_outputs():
    for text in ("<P>a<S>b", "<P>a<P>b<M>c", "<P>a<S>b<M>c<M>d", "plain"):
        with pytest.raises(ValueError):
            infill._gathered(*_block([text]), np.array([True]))


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _ranked(rows, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document."""
    docs = [(d, Counter(_terms(t))) for d, t in rows]
    n, words = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c in docs:
            size = sum(c.values())
            score = 0
            for t in _terms(text):
                if c[t]:
                    m = 25 + 75 * size * n // words
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(found)[:k])]
    return Counter(out)


def _rows(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_query(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = _ranked([(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()], items)
    assert _rows(queries.op13_ranked_search(spark, SF_SMALL)) == want


def test_search_odd_rows(spark):
    rows = odd_rows() + [row(30 + i, "tie words") for i in range(40)] + [row(30, "tie words"), row(None, "tie words"), row(70, "É é ABC-abc_9 ß x\x7fy")]
    items = [(1, "the word1 w2 and hunter2hunter2"), (1, "tie"), (2, None), (3, ""), (None, "tie tie words THE"), (5, "... %%"), (6, "nowhere"),
             (7, "é abc 9 x y ß"), (8, " ".join(f"long{i} word{i}" for i in range(3000)))]
    queried = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("rank", F.lit("x"))
    for k, size in ((10, 1 << 20), (3, 60)):
        index = ranked_search.build(spark.createDataFrame(rows, SCHEMA).repartition(3), segment_postings=size, segment_docs=max(7, size >> 4))
        assert _rows(ranked_search.search(index, queried, k)) == _ranked([(r[0], r[1]) for r in rows], items, k)
    assert ranked_search.search(index, queried.limit(0)).count() == 0
    assert ranked_search.search(ranked_search.build(empty_documents(spark)), queried).count() == 0


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 7)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    index = ranked_search.build(documents(spark, SF_SMALL))
    want = _ranked([(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()], items)
    assert _rows(ranked_search.search(index, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))) == want


@pytest.mark.parametrize("window, short", [(4, 0), (4, 3), (16, 8), (512, 1000)])
def test_skipping_loses_nothing(monkeypatch, window, short):
    monkeypatch.setattr(ranked_search, "WINDOW", window)
    monkeypatch.setattr(ranked_search, "SHORT", short)
    rng = np.random.default_rng(window + short)
    skipped = 0
    for _ in range(40):
        vocabulary = [f"t{i}" for i in range(30)]
        p = 1 / np.arange(1, 31)
        texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30), p=p / p.sum())) for _ in range(rng.integers(1, 200))]
        items = [" ".join(rng.choice(vocabulary, rng.integers(0, 8))) for _ in range(6)]
        segment = ranked_search._Segment()
        term, r, count, lengths = ranked_search._postings(*_block(texts))
        segment.add(list(range(len(texts))), lengths, term, r, count)
        n, words = int((lengths > 0).sum()), int(lengths.sum())
        if not words:
            continue
        packed = segment.packed()
        block = ranked_search._Block(items)
        df = Counter(term.tolist())
        block.weights[:] = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in block.terms.tolist()]
        kinds = ("<i8", "<u8", "<u4", "<u4", "<u4")
        lists = ranked_search._Lists(block, n, words, *(np.frombuffer(packed.column(3 + i)[0].as_buffer(), t) for i, t in enumerate(kinds)))
        got = Counter()
        for i, (terms, times) in enumerate(block.items):
            best, seen = ranked_search._Best(5), []

            def add(docs, scores):
                seen.append(len(docs))
                return best.add(docs, np.zeros(len(docs), bool), scores)
            lists.best(terms, times, best.least(), add)
            skipped += len(seen) < lists.windows
            got.update((i, j + 1, int(d), int(s)) for j, (d, s) in enumerate(zip(best.ids, best.scores)))
        assert got == _ranked(list(enumerate(texts)), list(enumerate(items)), 5)
    assert skipped or window == 512
