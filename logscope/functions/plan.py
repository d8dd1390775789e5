"""Plan-shaping helpers (pure DataFrame API)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logscope.session import scratch_dir


def fence(df: DataFrame) -> DataFrame:
    """Evaluate df's columns once per row and stop the optimizer from inlining them.

    Filters above a Project are pushed below it by substituting the projected
    expressions, so a filter over parsed fields would re-run every split/regex
    (and the JIT gives up on the resulting huge method). A one-element
    ``inline`` is a Generate node: predicates on its output stay above it and
    projections are not collapsed through it, so each expression runs once.
    """
    return df.selectExpr("inline(array(struct(*)))")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch space and reread: later passes read only the
    columns they use, and a lost executor loses nothing. ``session.drop_scratch`` removes it."""
    path = f"{scratch_dir(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
