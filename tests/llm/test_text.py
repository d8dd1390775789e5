"""Extraction, language ID, fingerprints and secrets against brute force, and their defined results."""

from __future__ import annotations

import hashlib
import re
import zlib
from html import unescape

import numpy as np
import pytest

from conftest import SF_ORACLE, SF_SMALL
from helpers import SCHEMA, base_secrets, documents, empty_documents, odd_documents, odd_rows, row
from logscope.llm import html_extract, lang_cnn, merkle, queries, secret_scan

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style></head><body class="page has-sidebar">
<header class="site-header"><h1>Site name</h1><p>tag line</p></header><nav><a href="/">Home</a></nav>
<div id="cookie-notice">We use cookies</div><div class="layout-{n}"><div class="sidebar"><p>{filler}</p></div>
<div class="post-body post-{n}"><h2>Title &lt;{n}&gt;</h2><p>One <b>two</b>
  three<br>four <p>Caf&eacute; &#228; <a href="a>b">link</a>.<ul><li>first<li>second</ul><aside>No</aside>
<div class="ad">Buy</div><form><p>mail</p><input></form><script>if (a < b) write("<p>x</p>")</script></div>
<section id="comments"><p>{filler}</p></section></div><div class="box"><p>Extra {n}</p></div><footer>&copy; foot</footer></body></html>"""
WANT = "Title <{n}>\n\nOne two three four\n\nCafé ä link.\n\nfirst\n\nsecond"


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, paths string")


def test_extraction_of_the_given_pages(spark):
    """The article element's blocks, by an independent reading of the pages' one template."""
    def brute(html):
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        return "\n\n".join(b for b in blocks if b)

    got = {r.page_id: r for r in queries.op1_html_extraction(spark, SF_ORACLE).collect()}
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == brute(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_extraction_by_consensus(spark):
    filler = "noise words that go on and on " * 3
    rows = [(n, f"https://User@a.example.com:80/{n}", PAGE.format(n=n, filler=filler), "x", "y") for n in range(30)]
    # On this page the box holds most text; the host's consensus still finds the article.
    odd = PAGE.format(n=99, filler=filler).replace("Extra 99", "Extra " * 400)
    rows.append((99, "https://a.example.com/99", odd, "x", "y"))
    got = {r.page_id: r.text for r in html_extract.extract(_pages(spark, rows)).collect()}
    assert all(got[n] == WANT.format(n=n) for n in [*range(30), 99])


def test_extraction_defined_results(spark):
    rows = [(1, None, None, None, None), (2, "u", "", "x", "y"), (3, "not a url", "plain &amp; <b>bold", "x", "y"),
            (4, None, "<p>a<p>b <div>c", "x", "y"), (5, "http://h/1", "<nav>only menu</nav>", "x", "y"), (None, "http://h/2", "<p>t", "x", "y"),
            (6, "http://h/3", "<article>" + "<p>word</p>" * 20_000, "x", "y"), (6, "http://h/3", "<article><p>again", "x", "y"),
            (7, "http://h/4", "<div class='modal'><p>all is in a dialog</p></div>", "x", "y")]
    got = html_extract.extract(_pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got if r.page_id != 6}
    assert by == {1: "", 2: "", 3: "plain & bold", 4: "a\n\nb\n\nc", 5: "", None: "t", 7: ""}
    assert sorted(len(r.text) for r in got if r.page_id == 6) == [5, 20_000 * 6 - 2]
    assert html_extract.extract(_pages(spark, [])).count() == 0


def test_attributes_are_names_and_values():
    assert html_extract._attributes(' title="the hidden truth" data-id="search" CLASS=a class="b" hidden') == {"class": "a", "hidden": ""}
    assert html_extract._attributes(""" id='x y' data-role="menu" aria-hidden = "true" style="a: b" alt=role""") == {
        "id": "x y", "aria-hidden": "true", "style": "a: b"}
    kept = ['<p title="the hidden truth">word</p>', '<p><a title="hidden gem" href="x">word</a></p>', '<div data-id="search"><p>word</p></div>',
            '<div data-role="menu"><p>word</p></div>', '<div class="search-engine-article"><p>word</p></div>', '<div class="alert-levels">word</div>',
            '<section class="has-sidebar no-comments">word</section>', '<div id="market-share">word</div>', "<p alt='x hidden y'>word</p>"]
    gone = ["<div class='cookie-notice'>word</div>", "<div id=sidebar-left>word</div>", "<div class='x ad-slot'>word</div>", "<p hidden>word</p>",
            "<ul class='post-comments'><li>word</ul>", '<div role="search">word</div>', '<p aria-hidden="true">word</p>', "<div class='share-buttons'>word</div>"]
    for part, want in [(h, True) for h in kept] + [(h, False) for h in gone]:
        page = html_extract.blocks(f"<article><p>first</p>{part}<p>last</p></article>")
        assert [t for t, _, _ in page] == ["first", *["word"] * want, "last"], part


TEASER = "<div class='box'><p>Site teaser of some length that is on every page</p></div>"
SIDE = "<div class='lower'><p>A side box with words of its own</p></div>"


def _templated(name, n):
    return f"<html><body>{TEASER}<div class='{name}'><h1>Head {n}</h1><p>{'body of the story ' * 12}{n}</p><p>more {n}</p></div>{SIDE}</body></html>"


def test_every_template_of_a_host_has_its_winner(spark):
    for names in (["story-body", "longread"], ["story-body", "longread", "reportage", "feature", "interview", "gallery-text", "column-x"]):
        rows = [(n, f"https://h.example/{n}", _templated(names[n % len(names)], n), "x", "y") for n in range(70)]
        rows.append((900, "https://h.example/900", "<body><div class='cookie-notice'><p>We use cookies</p></div></body>", "x", "y"))
        got = {r.page_id: r.text for r in html_extract.extract(_pages(spark, rows)).collect()}
        assert got.pop(900) == ""
        assert got == {n: f"Head {n}\n\n{'body of the story ' * 12}{n}\n\nmore {n}" for n in range(70)}


def _voted(rows):
    """The extraction by the definition: shares summed per host and path in one place."""
    parsed = [(i, re.match(r"https?://(?:[^/@]*@)?([^/:?#]+)", (u or "").lower()), html_extract.blocks(h or "")) for i, u, h in rows]
    parsed = [(i, m[1] if m else "", page) for i, m, page in parsed]
    out = []
    for i, host, page in parsed:
        same = [html_extract.shares(p) for _, h, p in parsed if h == host and p]
        able = []
        for path in {p for s in same for p in s if not html_extract._everything(p)}:
            held = [s[path] for s in same if path in s]
            if len(held) >= max(min(2, len(same)), html_extract.LEAST_PAGES * len(same)) and sum(held) / len(held) >= html_extract.LEAST_SHARE:
                able.append((-html_extract.preference(path, sum(held) / len(held)), path))
        mine = [p for _, p in sorted(able) if any(p in chain for _, _, chain in page)]
        best = mine[0] if mine else html_extract.own_path(page)
        out.append((i, "\n\n".join(t for t, _, chain in page if best is None or best in chain)))
    return out


def test_extraction_against_a_vote_by_definition(spark):
    given = [(p.page_id, p.url, p.html) for p in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    filler = "noise words that go on and on " * 3
    rows = given[:40] + [(1000 + n, "https://t.example/", _templated(["a", "b b2", "c"][n % 3], n)) for n in range(20)]
    rows += [(2000 + n, "https://a.example.com/", PAGE.format(n=n, filler=filler)) for n in range(9)]
    rows += [(3000, None, _templated("x", 1)), (3001, "bad", "<p>one<p>two"), (3002, "https://one.example/", _templated("z", 2)), (3003, None, None)]
    got = html_extract.extract(_pages(spark, [(*r, "x", "y") for r in rows])).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted(_voted(rows))


def test_language_held_out_accuracy(spark):
    got = queries.op7_language_id(spark, SF_ORACLE).collect()
    lang = {r.doc_id: r.lang for r in documents(spark, SF_ORACLE).collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got) and len(got) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_defined_results(spark):
    net = lang_cnn.fit(documents(spark, SF_SMALL).select("lang", "text"))
    got = {(r.doc_id, r.lang_pred) for r in lang_cnn.predict(odd_documents(spark), net).collect() if r.doc_id in (3, 4, 5, 11)}
    assert got == {(3, "und"), (4, "und"), (5, "und"), (11, "und")}
    assert lang_cnn.predict(odd_documents(spark), net).count() == len(odd_rows())
    assert lang_cnn.fit(empty_documents(spark)) is None
    assert {r.lang_pred for r in lang_cnn.predict(odd_documents(spark), None).collect()} == {"und"}
    assert lang_cnn.predict(empty_documents(spark), net).count() == 0


def test_convolution_against_loops():
    """Pooled filters, by the definition, on one window."""
    rng = np.random.default_rng(0)
    net = lang_cnn.train(rng.integers(1, 200, (64, lang_cnn.WINDOW)).astype(np.uint8), ["a", "b"] * 32)
    window = rng.integers(0, 256, lang_cnn.WINDOW).astype(np.uint8)
    x, pooled = net.embed[window], []
    for i, w in enumerate(lang_cnn.WIDTHS):
        for f in range(lang_cnn.FILTERS):
            weights = net.filters[:w * lang_cnn.EMBED, i * lang_cnn.FILTERS + f].reshape(w, -1)
            pooled.append(max((x[p:p + w] * weights).sum() for p in range(lang_cnn._STRIDE)))
    logits = np.maximum(np.array(pooled) + net.bias, 0) @ net.dense + net.offset
    want = logits - np.log(np.exp(logits).sum())
    assert np.allclose(net.log_probabilities(window[None])[0], want, atol=1e-3)


def _edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        yield d, t, t[:len(t) - len(t) // 3] + after[:len(t) // 3], after


@pytest.mark.parametrize("parts", ["3", "40"])
def test_fingerprints_against_brute_force(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in queries.op8_fingerprints(spark, SF_SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    assert got.keys() == {d for d, _ in rows}
    for d, t, edited, after in _edits(rows):
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(t) and r.edited_fingerprint == merkle.fingerprint(edited)
        assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(after))
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.98


def test_fingerprints_odd_rows(spark):
    got = merkle.neighbour_edits(odd_documents(spark)).collect()
    want = [(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in _edits([(r[0], r[1] or "") for r in odd_rows()])]
    key = lambda r: (r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    assert merkle.neighbour_edits(empty_documents(spark)).count() == 0
    one = merkle.neighbour_edits(spark.createDataFrame([row(5, "abcdef")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0


def test_tree_locates_edits():
    lines = [f"Line {i} has some words that are its own, number {i * 7}." for i in range(40)]
    a = merkle.fingerprint("\n".join(lines))
    lines[17] = lines[17].replace("words", "letters")
    b = merkle.fingerprint("\n".join(lines))
    where = merkle.differing(b, a)
    assert len(where) == 1 and merkle.differing(a, a) == [] and 0.98 < merkle.likeness(a, b) < 1
    # The section and paragraph that are named are those of the edited line.
    paragraphs = [(i, j) for i, (_, ps) in enumerate(merkle.tree(b)[1]) for j in range(len(ps))]
    assert paragraphs.index(where[0][:2]) == 17
    assert merkle.likeness(a, merkle.fingerprint("\n".join(["quite new", *lines]))) > 0.85
    assert merkle.fingerprint("a  b") != merkle.fingerprint("a b") and merkle.likeness(merkle.fingerprint(""), a) == 0


def test_tree_locates_white_space():
    text = "one two three\nfour five six\n\nseven eight nine ten"
    a = merkle.fingerprint(text)
    for edited, place in ((text.replace("two three", "two  three"), 0), (text.replace("six\n\n", "six\n \n"), 2), (text + " ", 3),
                          (text.replace("four", "\tfour"), 1)):
        b = merkle.fingerprint(edited)
        paragraphs = [(i, j) for i, (_, ps) in enumerate(merkle.tree(b)[1]) for j in range(len(ps))]
        assert [paragraphs.index(w[:2]) for w in merkle.differing(b, a)] == [place] and 0 < merkle.likeness(a, b) < 1
        assert [w[2] for w in merkle.differing(b, a)] == [-1]
    assert merkle.fingerprint(text + "\n").partition("|")[0] != a.partition("|")[0]
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("\n")) == 0 and merkle.likeness(a, a) == 1.0


def test_nodes_are_hashes_of_their_children():
    text = "\n".join(f"paragraph {i} " + "word " * (i % 9) for i in range(60)) + "\n\nlast"
    root, sections = merkle.tree(merkle.fingerprint(text))
    lines, at, nodes = text.split("\n"), 0, []
    for node, paragraphs in sections:
        below = [merkle._node(b"p", line.encode()) for line in lines[at:at + len(paragraphs)]]
        assert [p for p, _ in paragraphs] == [b.hex()[:merkle.NODE] for b in below]
        nodes.append(merkle._node(b"s", b"".join(below)))
        assert node == nodes[-1].hex()[:merkle.NODE]
        at += len(paragraphs)
    assert at == len(lines) and root == merkle._node(b"r", b"".join(nodes)).hex() and len(sections) > 3


def test_secrets_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.op9_secret_scan(spark, SF_ORACLE).collect()}
    rows = documents(spark, SF_ORACLE).collect()
    assert len(got) == len(rows)
    for r in rows:
        want = base_secrets(r.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [g.n_assign, g.n_access, g.n_hex] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        assert set(joined.split(",")) - {""} <= set(g.spans.split(","))


TRICKY = ["secret=token:abcdefgh", "token=token=abcdef password='short' passwd: \"longer_value\"", "API_KEY = AKIA" + "A" * 16 + " x",
          "AKIAAKIA" + "B" * 12, "😀 secret := deadbeefdeadbeefdeadbeef00 tail", "ab" * 11, "ab" * 12 + "g" + "cd" * 12, "﷐token=abcdef﷑",
          "-----BEGIN RSA PRIVATE KEY-----", "apikey:" + "x" * 5, "token==abcd9 token = 'q'", " ".join(f"token=abcdef{i}" for i in range(3000))]


def test_secrets_tricky_texts(spark):
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(TRICKY)], SCHEMA)
    versions, ledger, _ = secret_scan.scan(docs)
    found = {r.path: r.spans for r in secret_scan.findings(versions, ledger).collect()}
    for i, t in enumerate(TRICKY):
        base = [(secret_scan.RULES[s.rank].kind, s.start, s.end) for s in found[i] if secret_scan.RULES[s.rank].base]
        assert base == base_secrets(t), t[:60]
    assert [secret_scan.RULES[s.rank].kind for s in found[8]] == ["pem"]


def test_ledger_scans_only_what_is_unseen(spark):
    first = spark.createDataFrame([row(1, "token=abcdef1"), row(2, "clean"), row(3, "token=abcdef1")], SCHEMA)
    _, ledger, new = secret_scan.scan(first)
    assert new.count() == 2 * len(secret_scan.RULES)                       # blobs, not rows
    more = spark.createDataFrame([row(1, "token=abcdef1"), row(2, "changed secret=abcdef2"), row(4, "clean")], SCHEMA)
    versions, ledger, new = secret_scan.scan(more, ledger)
    assert new.count() == len(secret_scan.RULES)
    assert {r.path: len(r.spans) for r in secret_scan.findings(versions, ledger).collect()} == {1: 1, 2: 1, 4: 0}
    newer = (*secret_scan.RULES[:-1], secret_scan.Rule("pem", 2, r"()(-----BEGIN [A-Z ]{0,40}KEY-----)", 1, base=False))
    _, _, new = secret_scan.scan(more, ledger, newer)
    assert {r.rule for r in new.collect()} == {"pem@2"} and new.count() == 3


def test_private_keys_are_redacted_whole(spark):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    lines = [(f"k{i}Q/+" + "Zx9" * 30)[:64] for i in range(30)]
    lines[3], lines[7] = "AKIA" + "B" * 60, "ab" * 32                     # other rules match inside the body
    body, armor = "\n".join([*lines, "Zm9v="]), "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011AABB\n\n"
    blocks = [f"{begin}\n{body}\n{end}", f"{begin}\r\n{armor}{body}\n{end}", f"{begin}\\n" + body.replace("\n", "\\n") + f"\\n{end}",
              f"{begin} {body.replace(chr(10), ' ')} {end}", f"{begin}\n{body}", f"{begin}\n{armor}{body}", f"{begin}\nc2hvcnQ="]
    rows = [row(i, f"head line\nsecret: {b}\nthe tail stays") for i, b in enumerate(blocks)]
    rows += [row(90, f"{blocks[4]}\n{blocks[0]}\nthe tail stays"), row(91, f"{begin} is the header of a key"),
             row(92, f"{begin}\n" + "Zx9+" * 100_000 + f"\n{end}")]
    got = {r.doc_id: r.text for r in secret_scan.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(len(blocks)):
        assert got[i] == "head line\nsecret: [REDACTED]\nthe tail stays", i
    assert got[90] == "[REDACTED]\n[REDACTED]\nthe tail stays" and got[91] == "[REDACTED] is the header of a key"
    assert got[92] == "[REDACTED]"


def test_secrets_odd_rows_and_redaction(spark):
    found = secret_scan.findings(*secret_scan.scan(odd_documents(spark))[:2]).collect()
    assert len(found) == len(odd_rows()) and {r.path for r in found if r.spans} == {12}
    clean = secret_scan.redact(odd_documents(spark))
    assert clean.columns == odd_documents(spark).columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert "hunter2" not in texts[12] and "password = [REDACTED]" in texts[12] and texts[3] is None and texts[10] == odd_rows()[10][1]
    versions, ledger, _ = secret_scan.scan(empty_documents(spark))
    assert secret_scan.findings(versions, ledger).count() == 0


def test_no_python_in_secret_scan(spark):
    plan = queries.op9_secret_scan(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
