"""Named-query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from logscope.plans.oracle_sql import with_ctes

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    sql: str | None        # full DuckDB statement (CTEs included); None = rows-only check
    summary: str


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        doc = (fn.__doc__ or "").strip().splitlines()
        REGISTRY[name] = QuerySpec(name, fn, with_ctes(sql) if sql else None,
                                   doc[0] if doc else "")
        return fn
    return deco
