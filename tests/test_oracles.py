"""Every registered query against its DuckDB oracle (or rows-only) on sf0.001."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from logscope.plans.catalog import all_queries
from logscope.plans.compare import compare

CATALOG = all_queries()
ORACLE = sorted(n for n, s in CATALOG.items() if s.sql)
ROWS_ONLY = sorted(n for n, s in CATALOG.items() if not s.sql)


def test_registry_matches_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.queries()) >= set(CATALOG)
    assert set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", ORACLE)
def test_oracle(spark, duck_small, name):
    spec = CATALOG[name]
    out = compare(name, spec.build(spark, SF_SMALL), duck_small, spec.sql)
    assert out.ok, out.detail


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    df = CATALOG[name].build(spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["request_url", "hits"]
    assert df.count() == 295      # FIXTURES.md: distinct URLs at sf0.001


ZONE_SENSITIVE = ["parse_time_ms", "hits_by_hour", "ip_activity_snapshot", "etl_access_rows",
                  "stream_hourly_windows"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, duck_small, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spec = CATALOG[name]
        out = compare(name, spec.build(spark, SF_SMALL), duck_small, spec.sql)
        assert out.ok, out.detail
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
