"""Secret scanning with an incremental, content-addressed blob ledger.

Every text is a blob named by its SHA-256. The ledger records which (blob, rule version)
pairs were scanned and what was found. A scan reads the text of one representative row per
blob that has an unseen pair, appends the new pairs, and joins findings back to every row
(path) that holds the blob. Only built-in SQL functions run: a match is wrapped in marker
characters, the marked text is split, and spans are running sums of the parts' lengths.

Defined results: a null text counts as empty; empty texts and texts without secrets have no
spans; rows with equal texts get equal findings; rows that repeat a path are versions of it, each with its own blob and findings; of
spans that begin at one place the rule that is listed first comes first; a very long text is one blob, scanned whole in one task; an empty table gives an
empty result; extra columns pass through ``redact``, whatever they are called, and are ignored elsewhere;
positions are code points, end exclusive. The three marker characters are the Unicode
non-characters U+FDD0 to U+FDD2; where a text holds one itself, it is read as U+FDD3.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logscope.llm.common import fresh, keep_table, whole_text

_A, _B, _C, _OTHER = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"


@dataclass(frozen=True)
class Rule:
    """Group 1 is what leads to the secret (or empty), group 2 the secret itself."""

    kind: str
    version: int
    pattern: str
    least: int          # shorter secrets are dropped after matching
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# A PEM block: header, body and END marker. Without one it ends with the last line of base64, or the
# last of the long runs of a body on one line. All loops are possessive, which Java runs without recursion.
_PEM = "-----%s [A-Z ]{0,40}PRIVATE KEY-----"
_GAP, _BASE64 = r"""(?:[\s>#*|"',]|\\[nrt])""", "[A-Za-z0-9+/=]"
_TO_END = rf"[^-]*+(?:-{{1,4}}+(?!-)[^-]*+)*+{_PEM % 'END'}"
_NO_END = rf"""(?:{_GAP}*+(?:Proc-Type|DEK-Info):[^\n]*+)*+(?:{_GAP}*+(?:{_BASE64}{{40,}}+|(?<=[\n>#*|"'\x20\t]|\\[nrt]){_BASE64}++(?=[\x20\t"',]*+(?:[\r\n]|\\[nr]|\z))))*+"""

# The patterns of the three base rules, and one that this method adds.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 6),
    Rule("access", 1, r"()(AKIA[A-Z0-9]{16,})", 20),
    Rule("hex", 1, r"()([0-9a-f]{24,})", 24),
    Rule("pem", 3, f"()({_PEM % 'BEGIN'}(?:{_TO_END}|{_NO_END}))", 1, base=False),
)
_SPANS = "array<struct<start:int,rank:int,end:int>>"


def _parts(text: Column, rule: Rule) -> Column:
    """outside, lead, secret, outside, lead, secret, ..., outside."""
    safe = F.translate(text, _A + _B + _C, _OTHER * 3)
    return F.split(F.regexp_replace(safe, rule.pattern, f"{_A}$1{_B}$2{_C}"), f"[{_A}{_B}{_C}]", -1)


def _blob(text: str) -> Column:
    return F.unhex(F.sha2(whole_text(text).cast("binary"), 256))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], f"blob_id binary, rule string, spans {_SPANS}")


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         path: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan what the ledger has not seen.

    Returns ``(versions, ledger, scanned)``: versions (path, blob_id) of every row, the ledger
    with the new (blob_id, rule, spans) rows, and the new rows alone. Spans are sorted by
    start; ``rank`` is the rule's place in ``rules``.
    """
    ledger = empty_ledger(docs.sparkSession) if ledger is None else ledger
    every = F.array(*[F.lit(r.key) for r in rules])
    versions = keep_table(docs.select(F.col(path).alias("path"), _blob(text).alias("blob_id")), "blob-versions")
    blobs = versions.groupBy("blob_id").agg(F.min("path").alias("path"))
    known = ledger.groupBy("blob_id").agg(F.collect_set("rule").alias("known"))
    unseen = blobs.join(known, "blob_id", "left") \
        .withColumn("todo", F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))) \
        .where(F.size("todo") > 0).select("blob_id", "path", "todo")
    unseen = keep_table(unseen, "blob-unseen")
    # Rows that repeat one path with equal text give equal lengths; the set below unites them.
    bodies = docs.select(F.col(path).alias("path"), whole_text(text).alias("body"), _blob(text).alias("blob_id"))
    todo = unseen.select(F.col("path").alias("u_path"), F.col("blob_id").alias("u_blob"), "todo")
    reps = bodies.join(todo, (F.col("blob_id") == F.col("u_blob")) & F.col("path").eqNullSafe(F.col("u_path")))
    lengths = [F.when(F.array_contains("todo", r.key) & F.col("body").rlike(r.pattern),
                      F.struct(F.lit(i).alias("rank"), F.transform(_parts(F.col("body"), r), F.char_length).alias("lens")))
               for i, r in enumerate(rules)]
    hits = reps.select("blob_id", F.explode(F.filter(F.array(*lengths), lambda x: x.isNotNull())).alias("hit")) \
               .select("blob_id", "hit.rank", "hit.lens").distinct()
    each = hits.select("blob_id", "rank", F.posexplode("lens").alias("pos", "len"))
    order = W.partitionBy("blob_id", "rank").orderBy("pos")
    placed = each.withColumn("end", F.sum("len").over(order).cast("int")) \
                 .withColumn("lead", F.lag("len", 1, 0).over(order)).where("pos % 3 = 2")
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rank") + 1)
    rule = F.element_at(every, F.col("rank") + 1)
    found = placed.where(F.col("len") >= least) \
        .groupBy("blob_id", "rank") \
        .agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("len") - F.col("lead")).alias("start"),
                                                  F.col("rank"), F.col("end")))).alias("spans")) \
        .select("blob_id", rule.alias("rule"), F.col("spans").cast(_SPANS).alias("spans"))
    pairs = unseen.select("blob_id", F.explode("todo").alias("rule"))
    scanned = keep_table(pairs.join(found, ["blob_id", "rule"], "left").select(
        "blob_id", "rule", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")), "blob-ledger")
    return versions, ledger.unionByName(scanned), scanned


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, spans): every row of ``versions`` with the sorted spans of its blob under ``rules``."""
    current = ledger.where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    by_blob = current.groupBy("blob_id").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    by_blob = keep_table(by_blob, "blob-findings")
    return versions.join(by_blob, "blob_id", "left").select(
        "path", "blob_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _marked(least: int, mark: str):
    return lambda part, i: F.when((i % 3 == 2) & (F.char_length(part) >= least), F.lit(mark)).otherwise(part)


def redact(docs: DataFrame, path: str = "doc_id", text: str = "text", mark: str = "[REDACTED]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret found by ``scan`` replaced by ``mark``; other rows are unchanged."""
    versions, ledger, _ = scan(docs, None, rules, path, text)
    key, flag = fresh(docs, "_path"), fresh(docs, "_dirty")
    dirty = keep_table(findings(versions, ledger, rules).where(F.size("spans") > 0)
                       .select(F.col("path").alias(key), F.lit(True).alias(flag)).distinct(), "blob-dirty")
    clean = whole_text(text)
    # Added rules first: they match whole blocks, which a mark set inside by a base rule would break.
    for r in sorted(rules, key=lambda r: r.base):
        clean = F.array_join(F.transform(_parts(clean, r), _marked(r.least, mark)), "")
    joined = docs.join(dirty, docs[path].eqNullSafe(F.col(key)), "left")
    return joined.withColumn(text, F.when(F.col(flag), clean).otherwise(F.col(text))).select(*docs.columns)
