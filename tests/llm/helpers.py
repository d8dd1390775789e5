"""Small inputs and brute-force versions shared by the tests of the training-data operators."""

from __future__ import annotations

import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, body string, id long, rank int, "
          "spans string, _gone long, _path long, _dirty boolean, host string, keep_id long, shingles string")
LOWER = {c: c + 32 for c in range(65, 91)}


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 1, 2, "y", 3, 4, True, "h", 5, "z")


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    words = " ".join(f"w{i} the of and" for i in range(60))
    long = " ".join(f"long{i % 977} word{i}" for i in range(30_000))
    return [row(1, words), row(2, words), row(3, None), row(4, ""), row(5, "  \n\t "), row(6, "one"), row(7, "one two three"),
            row(8, words + " tail"), row(8, words + " tail"), row(9, "x" * 5000), row(10, long), row(11, "12 34 %%"),
            row(12, "a▁b  c\r\n\n<s> 日本 \U0001F44D password = hunter2hunter2"), row(13, "first line\nsecond line", None),
            row(14, "A WORD", "fr", None), (None, "no id", "en", "s", None, None, None, None, None, None, None, None, None, None, None)]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(rows, k, percent=80):
    """doc_id -> (size of the shingle set, smallest doc_id reachable), by all pairs that share a shingle."""
    sets, holders, parent = {}, {}, {}
    for d, t in rows:
        sets[d] = shingles(t, k)
        parent[d] = d

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, s in sets.items():
        seen = {}
        for g in s:
            for other in holders.get(g, ()):
                seen[other] = seen.get(other, 0) + 1
            holders.setdefault(g, []).append(d)
        for other, n in seen.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = root(d), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]
