"""logscope — web-server access-log analytics expressed as Spark DataFrame jobs.

Layers:
  sources/    table readers, the access-log fixture, text / Kafka sources
  functions/  Column expressions (parsing, keys, canonicalisation) — JVM-side only
  operators/  DataFrame -> DataFrame operators (reports, windows, joins, ML, sinks)
  streaming/  Structured Streaming jobs (running totals, windows, ETL, dedup)
  plans/      the named query catalogue and its DuckDB oracle SQL
"""

from logscope.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
