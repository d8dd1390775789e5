"""Main text of web pages by consensus host paths.

Each page's containers are scored by the share of its readable text that they hold. A
container's path is its chain of tags and classes, digits removed, so that pages made from one
template share it. Spark sums the shares per host and path; the host's winning paths are those
that hold most of the text of the pages that have them, semantic containers and deeper ones first. A host
may have many templates: each has its winners. The page and its body hold everything and are no candidates. Every
page is then extracted again with the first of its host's winning paths that it has, or, where it lacks all of
them, with its own best container. Votes are pre-aggregated in the tasks, so that a host with a
third of all pages sends a few rows per task. A winner is on ``LEAST_PAGES`` of its host's pages at least (and on two
of several), so a host has at most ``1 / LEAST_PAGES`` winners per level of nesting.

Defined results: a null or empty html, or one without readable text (a page that is all menu or notice),
gives the empty text; a null or malformed url belongs to the host ''; rows that repeat vote as often as they come and
each get a result; ties go to the path first in alphabetical order; a very long page is read whole, in one task; an empty table gives an
empty result; extra columns are ignored; unclosed and crossed tags are closed as browsers do in
the common cases, and a truncated page keeps what it has.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm.common import keep_table, map_arrow

LEAST_SHARE = 0.6        # of the text of the pages that have a path, so that it can win
LEAST_PAGES = 0.005      # of the host's pages that a winning path is on
_ROWS = 256              # pages that Python holds as strings at a time
_FLUSH = 50_000          # (host, path) sums that a task holds

# HTML elements by their role.
_CONTAINERS = frozenset("body main article section div td center blockquote".split())
_BLOCKS = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("""head nav footer aside form button select option textarea menu dialog svg math canvas object
    audio video map datalist fieldset""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ENDS_P = _BLOCKS - {"body", "html"}
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "body": ("head",)}
_SCOPES = frozenset("ul ol dl table div section article body main td blockquote".split())
# Words of class, id and role names that say what is not the article.
_NOT_ARTICLE = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion
    banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice
    alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments commentlist disqus reply replies respond discussion widget toolbar pagination pager
    search skip copyright legal contentinfo complementary dialog alertdialog teaser""".split())
_HEADER = frozenset(["header"])
# Words that may stand beside those and say only where or in what.
_PLACES = frozenset("""site page main top left right bottom upper lower side post blog article story entry text content primary
    secondary global sub mobile desktop fixed sticky inline box container wrapper wrap holder list area slot unit block section
    bar inner outer link links form item items panel module region col column row group icon icons button buttons title the div
    js id c cc fb twitter facebook google dfp yui""".split())
_CONTENT = frozenset("content article post entry story text body main articlebody".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|noscript|title|textarea|xmp|iframe|template)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<[!?][^>]*>
    |<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attr>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
    |<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attr2>[^>]*)(?:>|\Z)""", re.S | re.I | re.X)
# A name and its value; values are taken whole, so that nothing inside one is taken for a name.
_ATTR = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_READ = frozenset("class id role hidden aria-hidden style".split())
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")


def _attributes(text: str) -> dict[str, str]:
    """The attributes that are read; of a name that repeats the first one, as browsers take it."""
    out: dict[str, str] = {}
    if text.strip():
        for m in _ATTR.finditer(text):
            name = m[1].lower()
            if name in _READ:
                out.setdefault(name, unescape(m[2] or m[3] or m[4] or ""))
    return out


def _named(attrs: dict[str, str], words: frozenset) -> bool:
    """Whether a class, id or role is one of ``words``, alone or with words for places beside it only."""
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower().split():
        parts = _WORDS.findall(name)
        if any(p in words for p in parts) and all(p in words or p in _PLACES for p in parts):
            return True
    return False


def _hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


def blocks(html: str) -> list[tuple[str, int, tuple[str, ...]]]:
    """(text, characters in links, container paths from the outermost) of each readable block, in
    page order, without elements whose class, id or role says they are no article."""
    out: list[tuple[str, int, tuple[str, ...]]] = []
    # Of each open element: tag, 0 readable / 1 headings only / 2 skipped, container paths.
    stack: list[tuple[str, int, tuple[str, ...]]] = [("", 0, ("page",))]
    buffer: list[str] = []
    linked, in_link, heading = 0, 0, 0

    def end_block() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                out.append((text, min(linked, len(text)), stack[-1][2]))
            buffer.clear()
            linked = 0

    def close(to: int) -> None:
        nonlocal in_link, heading
        while len(stack) > to:
            tag = stack[-1][0]
            if tag in _BLOCKS:
                end_block()
            in_link -= tag == "a"
            heading -= tag in _HEADINGS
            stack.pop()

    def add(text: str) -> None:
        nonlocal linked
        state = stack[-1][1]
        if state == 0 or state == 1 and heading:
            buffer.append(text)
            if in_link:
                linked += len(text)

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in _VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                end_block()
            continue
        if tag in _ENDS_P or tag in _SIBLINGS:
            ends = _SIBLINGS.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                name = stack[i][0]
                if name in ends or name == "p" and tag in _ENDS_P:
                    close(i)
                    if name != "p":
                        break
                elif name in _SCOPES:
                    break
        if tag in _BLOCKS:
            end_block()
        _, state, paths = stack[-1]
        text = m["attr"] or m["attr2"] or ""
        attrs = _attributes(text)
        if tag in _SKIPPED or attrs and _hidden(attrs):
            state = 2
        elif attrs and tag not in ("html", "body", "article", "main") and _named(attrs, _NOT_ARTICLE):
            state = 2
        elif state == 0 and (tag == "header" or attrs and tag not in _HEADINGS and _named(attrs, _HEADER)):
            # A header inside an article has the article's headings; any other is the page's.
            state = 1 if any(p.rpartition(">")[2].startswith(("article", "main")) for p in paths) else 2
        if tag in _CONTAINERS:
            classes = sorted(set(_DIGITS.sub("", attrs.get("class", "").lower()).split()))
            paths = (*paths, f"{paths[-1]}>{'.'.join([tag, *classes])}")
        in_link += tag == "a"
        heading += tag in _HEADINGS
        if not text.endswith("/") or tag in _BLOCKS:
            stack.append((tag, state, paths))
        else:
            in_link -= tag == "a"
    if at < len(html):
        add(html[at:])
    close(1)
    end_block()
    return out


def _everything(path: str) -> bool:
    """Whether a path is the page's or its body's, which hold all text whatever it is."""
    return path == "page" or path.startswith("page>body") and path.count(">") == 1


def shares(page: list[tuple[str, int, tuple[str, ...]]]) -> dict[str, float]:
    """Share of the page's text outside links that each container path holds."""
    total = sum(len(text) - linked for text, linked, _ in page) or 1
    out: dict[str, float] = defaultdict(float)
    for text, linked, paths in page:
        for path in set(paths):
            out[path] += (len(text) - linked) / total
    return out


def preference(path: str, share: float) -> float:
    """Semantic containers first, then those named as content, then deeper ones."""
    tag, *classes = path.rpartition(">")[2].split(".")
    words = {w for c in classes for w in _WORDS.findall(c)}
    hint = 0.4 if tag == "article" else 0.3 if tag == "main" else 0.2 if words & _CONTENT else 0.0
    return min(share, 1.0) + hint + 0.01 * min(path.count(">"), 9)


def own_path(page: list[tuple[str, int, tuple[str, ...]]]) -> str | None:
    """The best container of one page by itself; None if none but the page and its body holds most of the text."""
    held = shares(page)
    most = max(held.values(), default=0)
    able = [p for p, s in held.items() if s >= LEAST_SHARE * most and not _everything(p)]
    return min(able, key=lambda p: (-preference(p, held[p]), p)) if able else None


def text_of(page: list[tuple[str, int, tuple[str, ...]]], paths: list[str]) -> str:
    """The blocks inside the first of ``paths`` that the page has, else inside its own best container."""
    has = {path for _, _, chain in page for path in chain}
    best = next((p for p in paths if p in has), None) or own_path(page)
    return "\n\n".join(text for text, _, chain in page if best is None or best in chain)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0])

    def out() -> pa.RecordBatch:
        keys, values = list(sums), list(sums.values())
        sums.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([v[0] for v in values], pa.float64()), pa.array([v[1] for v in values], pa.int64())],
            ["host", "path", "share", "pages"])

    for batch in batches:
        for i in range(0, len(batch), _ROWS):
            part = batch.slice(i, _ROWS)
            for host, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                page = blocks(html)
                if page:
                    # The empty path counts the host's pages that have text.
                    for path, share in [("", 1.0), *shares(page).items()]:
                        held = sums[host, path]
                        held[0] += share
                        held[1] += 1
            if len(sums) >= _FLUSH:
                yield out()
    yield out()


def _host(url: str):
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, paths): the winning container paths of each host, best first."""
    rows = pages.select(_host(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    votes = map_arrow(rows, _votes, "host string, path string, share double, pages long") \
        .groupBy("host", "path").agg(F.sum("share").alias("share"), F.sum("pages").alias("pages"))
    votes = keep_table(votes, "path-votes")
    totals = votes.where("path = ''").select("host", F.col("pages").alias("of"))
    enough = F.col("pages") >= F.greatest(F.least(F.lit(2), F.col("of")), LEAST_PAGES * F.col("of"))
    mean = votes.where("path != '' AND NOT path RLIKE '^page(>body[^>]*)?$'").join(totals, "host").where(enough) \
        .select("host", "path", (F.col("share") / F.col("pages")).alias("share"))
    last = F.element_at(F.split("path", ">"), -1)
    tag, words = F.element_at(F.split(last, r"\."), 1), F.split(last, r"[^a-z]+")
    hint = F.when(tag == "article", 0.4).when(tag == "main", 0.3) \
        .when(F.arrays_overlap(F.slice(words, 2, 1000), F.array(*[F.lit(w) for w in sorted(_CONTENT)])), 0.2).otherwise(0.0)
    depth = F.least(F.size(F.split("path", ">")) - 1, F.lit(9))
    value = F.least("share", F.lit(1.0)) + hint + 0.01 * depth
    able = mean.where(F.col("share") >= LEAST_SHARE).groupBy("host", "path").agg(F.max(value).alias("value"))
    # At most 1 / LEAST_PAGES paths per level of nesting.
    best = able.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "path"))).alias("best"))
    return keep_table(best.select("host", F.transform("best", lambda b: b["path"]).alias("paths")), "host-paths")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), _ROWS):
                part = batch.slice(i, _ROWS)
                texts = [text_of(blocks(h), paths or []) if h else ""
                         for h, paths in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    winners = host_paths(pages, url, html).withColumnRenamed("host", "w_host")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"), _host(url).alias("host"))
    joined = rows.join(winners, F.col("host") == F.col("w_host"), "left").select("page_id", "url", "html", "paths")
    return map_arrow(joined, run, "page_id long, url string, text string, n_chars long")
