"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.llm import (exact_dedup, html_extract, infill, lang_cnn, line_dedup, merkle, near_dedup, packing, piece_codec, quality_lm,
                          ranked_search, secret_scan, token_files)
from logscope.llm.common import keep_folder, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the consensus paths of its host."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a Kneser-Ney model of trusted text, and whether it is kept."""
    return quality_lm.classify(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), read(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids, lexical neighbours together."""
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and the text they decode to."""
    return piece_codec.digests(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progressive exact dedup of every document."""
    return exact_dedup.memberships(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that an earlier document has."""
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a byte CNN fitted on the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    net = lang_cnn.fit(docs.where(~lang_cnn.held_out() & F.col("text").isNotNull()).select("lang", "text"))
    return lang_cnn.predict(docs.select("doc_id", "text"), net) \
        .select("doc_id", lang_cnn.held_out().alias("held_out"), "lang_pred", "score")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text."""
    return merkle.neighbour_edits(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _plus_one_if(rank: int):
    return lambda n, x: n + (x == rank).cast("long")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by the blob ledger."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    versions, ledger, _ = secret_scan.scan(docs)
    found = secret_scan.findings(versions, ledger)
    base = {i: r.kind for i, r in enumerate(secret_scan.RULES) if r.base}
    ranks = F.transform("spans", lambda s: s["rank"])
    count = {kind: F.aggregate(ranks, F.lit(0).cast("long"), _plus_one_if(i)) for i, kind in base.items()}
    only_base = F.filter("spans", lambda s: s["rank"].isin(list(base)))
    return found.select(F.col("path").alias("doc_id"), *[c.alias(f"n_{k}") for k, c in count.items()],
                        F.sha2(secret_scan.span_text(only_base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of every document: four-word shingles, similarity of 0.8 or more."""
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=80)


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.m = e.a),
c AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to flat files in ascending doc_id order and read back from them."""
    folder = keep_folder(spark, "token-files")
    token_files.write(read(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return token_files.checksums(spark, folder)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-the-middle form, and the text rebuilt from that form."""
    coded = infill.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return infill.restore(coded).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
d AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
         ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT doc_id, n, form, body, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid,
         array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = ranked_search.build(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return ranked_search.search(index, read(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
g AS (SELECT count(*)::BIGINT AS N_docs, sum(n)::BIGINT AS L FROM len),
m AS (SELECT doc_id, 100 - 75 + (75 * n * N_docs) // L AS m FROM len, g),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
qt AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM qt) GROUP BY 1),
wt AS (SELECT term, floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, g),
s AS (SELECT qt.item_id, tf.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM qt JOIN wt ON wt.term = qt.term JOIN tf ON tf.term = qt.term JOIN m ON m.doc_id = tf.doc_id GROUP BY 1, 2),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_piece_codec": op4_piece_codec,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_language_id": op7_language_id,
    "op8_fingerprints": op8_fingerprints,
    "op9_secret_scan": op9_secret_scan,
    "op10_near_dedup": op10_near_dedup,
    "op11_token_files": op11_token_files,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE_SQL: dict[str, str] = {"op5_exact_dedup": OP5_SQL, "op10_near_dedup": OP10_SQL,
                              "op12_fill_in_middle": OP12_SQL, "op13_ranked_search": OP13_SQL}
