"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only built-in SQL functions run. Two cheap keys (length in bytes, hash of the first
``PREFIX`` characters) are grouped first; the full content hash is computed only for rows
whose (length, prefix) pair occurs more than once. Every grouping is an aggregate with
map-side combining, so a group that holds a third of all rows ships one partial row per task.

Defined results: a null text counts as empty; empty texts are equal to each other; equal rows with
one doc_id share one decision, rows with one doc_id and different texts are decided each by its text; a null doc_id never wins over
another id, and rows without an id stay where no row with an id has their text; a very long text is hashed whole, nothing of it is kept; the smallest
doc_id is the only rule, so nothing is left to chance where texts tie; an empty table gives an empty result; columns that are not named are ignored
(``drop_duplicates`` passes them through, whatever they are called).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.llm.common import keep_table, text_digest, whole_text, without_rows

WHITE_SPACE = r"[\x20\x09-\x0D]+"
PREFIX = 256


def normalised(text: str = "text") -> Column:
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(whole_text(text), WHITE_SPACE, " ")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text_sha256, keep_id, group_size): one row per text that more than one row has."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(text).alias("body"))
    keyed = rows.select("doc_id", "body", F.octet_length("body").alias("n_bytes"),
                        F.xxhash64(F.substring("body", 1, PREFIX)).alias("prefix_hash"))
    keys = keep_table(keyed.groupBy("n_bytes", "prefix_hash").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
    lengths = keys.groupBy("n_bytes").agg(F.sum("n").alias("rows")).where("rows > 1").select("n_bytes")
    again = keep_table(keys.join(lengths, "n_bytes", "left_semi").where("n > 1").select("n_bytes", "prefix_hash"),
                       "dedup-survivors")
    full = keyed.join(again, ["n_bytes", "prefix_hash"], "left_semi") \
                .select("doc_id", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"))
    groups = full.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return keep_table(groups.where("group_size > 1"), "dedup-groups")


def _decided(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    digests = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_digest(text).alias("text_digest"),
                          F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256"))
    out = digests.join(duplicate_groups(docs, doc_id, text), "text_sha256", "left")
    keep = F.coalesce("keep_id", "doc_id")
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256", "text_digest")


def memberships(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per input row."""
    return _decided(docs, doc_id, text).drop("text_digest")


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts, those with the smallest doc_id."""
    return without_rows(docs, doc_id, text, _decided(docs, doc_id, text).where("NOT kept").select("doc_id", "text_digest"))
