"""Exact dedup, near dedup and line dedup against brute force, and their defined results."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from helpers import documents, empty_documents, near_components, odd_documents, odd_rows, row, shingles, SCHEMA
from logscope.llm import exact_dedup, graph, line_dedup, near_dedup, queries


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(_normal(t), []).append(d)
    return groups


def test_exact_dedup_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    groups = _exact(rows)
    got = {r.doc_id: r for r in queries.op5_exact_dedup(spark, SF_SMALL).collect()}
    for d, t in rows:
        same = groups[_normal(t)]
        assert (got[d].keep_id, got[d].group_size, got[d].kept) == (min(same), len(same), d == min(same))
        assert got[d].text_sha256 == hashlib.sha256(_normal(t).encode()).hexdigest()


def test_exact_dedup_oracle(spark, duck_small):
    from logscope.plans.compare import compare

    out = compare("op5", queries.op5_exact_dedup(spark, SF_SMALL), duck_small, queries.OP5_SQL)
    assert out.ok, out.detail


def test_exact_dedup_odd_rows(spark):
    got = exact_dedup.memberships(odd_documents(spark)).collect()
    assert len(got) == len(odd_rows())
    by = {(r.doc_id, r.text_sha256): r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    assert by[3, empty].keep_id == by[4, empty].keep_id == 3 and by[4, empty].group_size == 2 and not by[4, empty].kept
    assert [r.kept for r in got if r.doc_id == 8] == [True, True] and {r.keep_id for r in got if r.doc_id == 2} == {1}
    assert [r.keep_id for r in got if r.doc_id is None] == [None]
    kept = exact_dedup.drop_duplicates(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 5, 6, 7, 8, 8, 9, 10, 11, 12, 13, 14]
    assert exact_dedup.memberships(empty_documents(spark)).count() == 0


def test_same_prefix_and_length_are_told_apart(spark):
    head = "a" * 400
    docs = spark.createDataFrame([row(1, head + "x"), row(2, head + "y"), row(3, head + "x")], SCHEMA)
    assert {r.doc_id: r.keep_id for r in exact_dedup.memberships(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_no_python_in_exact_dedup(spark):
    plan = exact_dedup.memberships(documents(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_near_dedup_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    want = near_components(rows, 4)
    got = queries.op10_near_dedup(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_chains_and_a_large_group(spark):
    base = [f"w{i}" for i in range(100)]
    rows, hot = [], 150
    for i in range(hot):                                   # a large group of near copies, two words changed in each
        w = list(base)
        w[i % 100], w[(7 * i + 3) % 100] = f"x{i}", f"y{i}"
        rows.append((1000 + i, " ".join(w)))
    chain = [f"c{i}" for i in range(90)]                    # each next one differs in two more words
    for i in range(12):
        rows.append((2000 + i, " ".join(chain)))
        chain[5 * i % 90] = f"d{i}"
    rows += [(3000 + i, " ".join(f"{i}u{j}" for j in range(30))) for i in range(40)]
    want = near_components(rows, 5)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def _dense_components(rows, k, percent=80):
    """What near_components gives, by a matrix of the shingles that several rows share."""
    sets = [shingles(t, k) for _, t in rows]
    often = [g for g, n in Counter(g for s in sets for g in s).items() if n > 1]
    at = {g: i for i, g in enumerate(often)}
    held = np.zeros((len(rows), len(often)), np.float32)
    for i, s in enumerate(sets):
        held[i, [at[g] for g in s if g in at]] = 1
    common, size = held @ held.T, np.array([len(s) for s in sets])
    near = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    np.fill_diagonal(near, True)
    part = np.arange(len(rows))
    while True:
        least = np.where(near, part[None, :], len(rows)).min(1)
        if (least == part).all():
            return {d: (len(s), rows[p][0]) for (d, _), s, p in zip(rows, sets, part.tolist())}
        part = least


def test_near_dedup_pairs_among_thousands_of_rivals(spark):
    """Pairs at 0.818 among 3000 rivals at 0.778, and a template with a few words changed in each text."""
    template, rng, rows = [f"t{i}" for i in range(214)], random.Random(3), []
    for i in range(3000):
        shared = [f"s{i // 2}_{j}" for j in range(6)] if i < 400 else [f"r{i}_{j}" for j in range(6)]
        rows.append((i, " ".join(template + shared + [f"r{i}_{j}" for j in range(6, 30)])))
    form = [f"f{i}" for i in range(204)]
    for i in range(900):
        words = list(form)
        for at in rng.sample(range(204), 3):
            words[at] = f"x{i}_{at}"
        rows.append((10_000 + i, " ".join(words)))
    want = _dense_components(rows, 5)
    assert [want[i][1] for i in range(4)] == [0, 0, 2, 2] and want[2999][1] == 2999
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_dedup_odd_rows(spark):
    got = near_dedup.near_duplicates(odd_documents(spark), k=4).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and by[8].component_id == 1 and by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0
    assert by[4].component_id == 4 and by[6].n_shingles == 1 and by[7].n_shingles == 1 and by[None].component_id is None
    kept = near_dedup.drop_near_duplicates(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and {1, 3, 4} <= {r.doc_id for r in kept.collect()}
    assert near_dedup.near_duplicates(empty_documents(spark)).count() == 0


def _texts_left(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_a_duplicate_takes_no_other_text_along(spark):
    """Rows go by id and text: neither another text of a repeated id nor rows without an id are lost."""
    base = " ".join(f"w{i}" for i in range(60))
    near = base + " tail"
    rows = [row(1, "same"), row(None, "same"), row(None, "unique A"), row(5, "same"), row(5, "unique B"), row(None, None), row(6, ""),
            row(10, base), row(12, near), row(12, "a text of its own that also has number twelve"), row(None, near), row(3, base + " other end")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert _texts_left(exact_dedup.drop_duplicates(docs)) == Counter(
        [(r[0], r[1]) for r in rows if (r[0], r[1]) not in {(None, "same"), (5, "same"), (None, None), (None, near)}])
    assert _texts_left(near_dedup.drop_near_duplicates(docs)) == Counter(
        [(r[0], r[1]) for r in rows if (r[0], r[1]) not in {(5, "same"), (10, base), (12, near)}])
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect() if r.doc_id is not None}
    assert got[12, 57] == (3, False) and got[12, 6] == (12, True) and got[3, 58] == (3, True)


def test_texts_under_one_id_are_linked_each_by_its_own_set(spark):
    rng, rows = random.Random(5), []
    for i in range(60):                        # 30 ids with two texts each, each a near copy of one under another id
        words = [f"{i}u{j}" for j in range(50)]
        rows.append((i % 30, " ".join(words)))
        words[rng.randrange(50)] = "x"
        rows.append((100 + i, " ".join(words)))
    want = near_components(list(enumerate(t for _, t in rows)), 5)
    least = {}
    for n, (d, _) in enumerate(rows):
        least[want[n][1]] = min(least.get(want[n][1], d), d)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()) == Counter(
        (d, want[n][0], least[want[n][1]], d == least[want[n][1]]) for n, (d, _) in enumerate(rows))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(900, 901), (901, 905)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 901: 900, 905: 900}


def test_line_dedup_removes_only_repeats(spark):
    rows = {r.doc_id: r.text for r in documents(spark, SF_SMALL).collect()}
    got = {r.doc_id: r for r in queries.op6_line_dedup(spark, SF_SMALL).collect()}
    assert got.keys() == rows.keys()
    lines = {d: t.split("\n") for d, t in rows.items()}
    for d, r in got.items():
        drop = set()
        for part in r.removed.split(",") if r.removed else []:
            a, b = map(int, part.split(":"))
            drop |= set(range(a, b + 1))
            chunk = lines[d][a:b + 1]
            earlier = any(lines[e][i:i + len(chunk)] == chunk for e in rows if e <= d for i in range(len(lines[e]) if e < d else a))
            assert earlier and (b > a or len(chunk[0].split(" ")) > line_dedup.LONG_WORDS)
        assert r.text == "\n".join(x for i, x in enumerate(lines[d]) if i not in drop) and r.n_removed == len(drop)


def test_line_dedup_finds_shifted_passages(spark):
    passage = [f"line {i} of a passage that several documents share, number {i * i}" for i in range(12)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(i % 5)] + passage + [f"end {i}"])) for i in range(1, 20)]
    rows += [(100, "short one\nand another"), (101, "short one\nbut no repeat")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[100].n_removed == got[101].n_removed == 0
    removed = [got[i].n_removed for i in range(2, 20)]
    assert len(set(removed)) == 1 and removed[0] >= 8 and all(f"end {i}" in got[i].text for i in range(1, 20))


def test_line_dedup_removes_whole_passages(spark):
    """Passages of two lines, and passages of five inside a document that has an exact copy."""
    rows = []
    for i in range(40):
        two = [f"{i} {part} " + " ".join(f"w{j}" for j in range(28)) for part in ("first", "second")]
        rows += [(1000 * i + d, "\n".join([f"a{i} {d}", *two, f"b{i} {d}"])) for d in (1, 2, 3)]
        five = [f"passage {i} line {j}" for j in range(5)]
        full = "\n".join([*[f"head {i} {j}" for j in range(4)], *five, *[f"tail {i} {j}" for j in range(4)]])
        rows += [(1000 * i + 11, "\n".join([f"c{i}", *five, f"d{i}"])), (1000 * i + 12, full), (1000 * i + 13, full)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for i in range(40):
        assert got[1000 * i + 1].text == texts[1000 * i + 1] and got[1000 * i + 11].text == texts[1000 * i + 11]
        assert all(got[1000 * i + d].text == f"a{i} {d}\nb{i} {d}" for d in (2, 3))
        assert got[1000 * i + 12].text == "\n".join([*[f"head {i} {j}" for j in range(4)], *[f"tail {i} {j}" for j in range(4)]])
        assert got[1000 * i + 13].text == "" and got[1000 * i + 13].n_removed == 13


def _lines_removed(rows):
    """{doc_id: lines that go}, by the definition, in one place."""
    at, where = {}, {}
    for d, t in rows:
        lines = (t or "").split("\n")
        at[d] = lines
        for i, x in enumerate(lines):
            if i + 1 < len(lines):
                where.setdefault((x, lines[i + 1]), []).append((d, i))
            if x.count(" ") >= line_dedup.LONG_WORDS:
                where.setdefault((x,), []).append((d, i))
    later = []
    for unit, places in where.items():
        first = min(places)
        later += [(p, first, len(unit)) for p in places if p[0] != first[0] or abs(p[1] - first[1]) >= len(unit)]
    lost = {(d, i + k) for (d, i), _, n in later for k in range(n)}
    out = {d: set() for d in at}
    for (d, i), (e, j), n in later:
        if not any((e, j + k) in lost for k in range(n)):
            out[d] |= {i + k for k in range(n)}
    return out


def test_line_dedup_against_its_definition(spark):
    rng = random.Random(6)
    rows = [(1, "P\nQ\nx"), (2, "P\nQ\nR"), (3, "Q\nR\nz"), (4, "\n".join("a" * 5)), (5, "b\nb\nb")]
    rows += [(10 + i, "\n".join(rng.choice("cdefghij") for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    long = " ".join(f"w{i}" for i in range(60))
    rows += [(200, f"k\n{long}\nl"), (201, f"m\n{long}\nn"), (202, f"k\n{long}"), (203, long)]
    rows += [(r.doc_id + 1000, r.text) for r in documents(spark, SF_SMALL).collect()]
    want = _lines_removed(rows)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    for d, t in rows:
        assert got[d].text == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d]), d
    assert got[2].text == "R" and got[3].text == "Q\nR\nz" and got[4].text == "a\na" and got[5].text == "b\nb\nb"


def test_what_line_dedup_removes_is_still_there(spark):
    """Every chunk that goes is, in one piece, in what is left of the document that it repeats."""
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choice("stuvwxyz") for _ in range(rng.randrange(2, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = {d: t.split("\n") for d, t in rows}
    left = {r.doc_id: f"\n{r.text}\n" for r in line_dedup.dedup_lines(docs).collect()}
    chunks = line_dedup.repeated_chunks(docs).collect()
    assert len(chunks) > 50
    for c in chunks:
        text = "\n" + "\n".join(lines[c.doc_id][c.start:c.last + 1]) + "\n"
        assert any(text in t for d, t in left.items() if d <= c.doc_id)


def test_line_dedup_odd_rows(spark):
    got = line_dedup.dedup_lines(odd_documents(spark)).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[3].text == by[4].text == "" and by[2].text == "" and by[2].n_removed == 1 and by[1].n_removed == 0
    assert [r.text for r in got if r.doc_id is None] == ["no id"]
    assert line_dedup.dedup_lines(empty_documents(spark)).count() == 0
