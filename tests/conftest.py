from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from logscope.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app_name="logscope-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from logscope.plans.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="session")
def duck_oracle():
    from logscope.plans.compare import duckdb_connection

    return duckdb_connection(SF_ORACLE)


def lines_df(spark, lines: list[str]):
    """Literal log lines -> (event_id, line) for golden micro-cases."""
    return spark.createDataFrame(list(enumerate(lines)), "event_id BIGINT, line STRING")
