"""Golden micro-cases: literal lines through the split parser, regex parser and helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import lines_df
from logscope.functions import parse as P
from logscope.operators import parsing

VALID = ('1.2.3.4 - - [22/Jan/2019:03:56:16 +0330] "GET /product/31 HTTP/1.1" 200 5667 '
         '"https://example.com/a" "Mozilla/5.0 (Windows NT 6.1) Chrome/66.0.3359.117 Safari/537.36"')
TRAILING = VALID + ' "-"'
SHORT = "bad line"
NO_QUOTES = "- - broken request without any quotes"
BAD_STATUS = '1.2.3.4 - - [22/Jan/2019:03:56:16 +0000] "GET / HTTP/1.1" abc 12 "-" "x"'
REGEX_URL = ('5.6.7.8 - - [01/Feb/2020:23:00:01 +0000] "POST /filter/27|?(a HTTP/2.0" 404 0 '
             '"" "AhrefsBot/6.1"')


def _access(spark, lines):
    return {r["event_id"]: r for r in parsing.access_table(lines_df(spark, lines)).collect()}


def test_split_parse_fields(spark):
    rows = _access(spark, [VALID, TRAILING, REGEX_URL])
    r = rows[0]
    assert r["remote_addr"] == "1.2.3.4"
    assert r["remote_user"] == "- -"
    assert r["time_local"] == "22/Jan/2019:03:56:16"
    assert r["tz_offset"] == "+0330"
    assert (r["request_method"], r["request_url"], r["http_version"]) == ("GET", "/product/31", "HTTP/1.1")
    assert (r["status"], r["body_bytes_send"]) == (200, 5667)
    assert r["http_referer"] == "https://example.com/a"
    assert r["http_user_agent"].startswith("Mozilla/5.0")
    assert r["hour"] == "03"
    # +0330: 03:56:16 local = 00:26:16 UTC
    assert r["epoch_ms"] == 1548116776000
    assert rows[1]["http_user_agent"] == r["http_user_agent"]      # trailing "-" field ignored
    assert rows[2]["request_url"] == "/filter/27|?(a"
    assert rows[2]["http_referer"] == ""


def test_quarantine_reasons(spark):
    q = parsing.quarantine(lines_df(spark, [VALID, SHORT, NO_QUOTES, BAD_STATUS]))
    got = {r["event_id"]: r["reason"] for r in q.collect()}
    assert got == {1: "too_short", 2: "no_request", 3: "bad_status"}


# One odd field each; every one is an ordinary line of a web server.
HEAD = '1.2.3.4 - - [22/Jan/2019:03:56:16 +0000] '
ODD = [HEAD + '"GET /a HTTP/1.1" 304 - "-" "agent"', HEAD + '"-" 408 0 "-" "-"', HEAD + '"GET /a b c HTTP/1.1" 404 9 "-" "agent"',
       HEAD + '"GET /big HTTP/1.1" 200 3000000000 "-" "agent"', HEAD + '"GET /plain HTTP/1.0" 200 12',
       HEAD + '"GET /old" 200 12 "-" "agent"', '1.2.3.4 - - [broken +0000] "GET /t HTTP/1.1" 200 1 "-" "agent"',
       '- - - [22/Jan/2019:03:56:16 +0000] "GET /h HTTP/1.1" 200 1 "-" "agent"',
       'web7.example.net - - [22/Jan/2019:03:56:16 +0000] "GET /n HTTP/1.1" 200 1 "-" "agent"',
       '2001:db8::7f - - [22/Jan/2019:03:56:16 +0000] "GET /6 HTTP/1.1" 200 1 "-" "agent"']


def test_one_bad_field_costs_only_its_own_reports(spark):
    df = lines_df(spark, ODD)

    def values(field):
        return [r[0] for r in parsing.report_rows(df, field).collect()]

    assert values("status") == [304, 408, 404, 200, 200, 200, 200, 200, 200, 200]
    assert values("request_url") == ["/a", "/a b c", "/big", "/plain", "/old", "/t", "/h", "/n", "/6"]
    assert values("http_version") == ["HTTP/1.1", "HTTP/1.1", "HTTP/1.1", "HTTP/1.0", "HTTP/1.1", "HTTP/1.1", "HTTP/1.1", "HTTP/1.1"]
    assert values("request_method") == ["GET"] * 9
    assert values("remote_addr") == ["1.2.3.4"] * 7 + ["web7.example.net", "2001:db8::7f"]
    assert len(values("epoch_ms")) == len(values("hour")) == 9
    assert len(values("http_user_agent")) == 9 and len(values("http_referer")) == 9
    got = {r["event_id"]: r for r in parsing.access_table(df).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 8, 9}
    assert got[0]["body_bytes_send"] is None and got[3]["body_bytes_send"] == 3_000_000_000
    assert got[4]["http_referer"] is None and got[1]["request_url"] is None
    assert {r["event_id"]: r["reason"] for r in parsing.quarantine(df).collect()} == {6: "bad_time", 7: "bad_address"}


def test_a_report_parses_only_its_fields(spark):
    plan = parsing.report_rows(lines_df(spark, ODD), "remote_addr")._jdf.queryExecution().executedPlan().toString()
    assert "http_referer" not in plan and "http_user_agent" not in plan and "try_to_timestamp" not in plan
    assert plan.count("split(") <= 2 and 'split(line#' in plan


def test_parsed_plus_quarantined_is_everything(spark):
    lines = [VALID, TRAILING, SHORT, NO_QUOTES, BAD_STATUS, REGEX_URL]
    df = lines_df(spark, lines)
    assert parsing.access_table(df).count() + parsing.quarantine(df).count() == len(lines)


def test_strict_regex_and_agent_normalisation(spark):
    out = {r["event_id"]: r for r in parsing.strict_parse_normalised(
        lines_df(spark, [VALID, TRAILING, SHORT, BAD_STATUS])).collect()}
    assert set(out) == {0, 1}
    assert out[0]["time"] == "22/Jan/2019:03:56:16 +0330"
    assert out[1]["user_agent"].endswith('" "-')          # the lazy group swallows the tail
    assert out[1]["user_agent_norm"] == out[0]["user_agent"]


def test_find_ips_includes_lookalikes(spark):
    df = lines_df(spark, [VALID]).select(P.find_ips("line").alias("ips"))
    ips = df.first()["ips"]
    assert ips == ["1.2.3.4", "66.0.3359.117"]
    v = spark.createDataFrame([(i,) for i in ips], "ip STRING").select(
        "ip", P.ip_is_valid("ip").alias("ok"), P.ip_to_long("ip").alias("n")).collect()
    assert [(r["ok"], r["n"]) for r in v] == [(True, 16909060), (False, None)]


def test_row_key_is_deterministic_and_distinguishes_offsets(spark):
    df = lines_df(spark, [VALID, VALID])
    keys = parsing.access_table(df).select(
        P.row_key("remote_addr", "time_local", "line", F.lit("t/0"), "event_id").alias("k")).collect()
    assert len({r["k"] for r in keys}) == 2
    assert all(r["k"].startswith("1.2.3.4_22/Jan/2019:03:56:16_") for r in keys)


def test_row_key_needs_a_whole_identity(spark):
    df = parsing.access_table(lines_df(spark, [VALID]))
    key = lambda source, offset: df.select(P.row_key("remote_addr", "time_local", "line", source, offset)).first()[0]
    assert key(F.lit("t/0"), F.lit(5)) != key(F.lit("t/1"), F.lit(5))
    for source, offset in ((F.lit(None), F.lit(5)), (F.lit("t/0"), F.lit(None))):
        with pytest.raises(Exception, match="no source or position"):
            key(source, offset)


def test_canonical_region(spark):
    df = spark.createDataFrame([("北京",), ("广东省",), ("新疆",), (None,)], "pro STRING")
    got = [r["r"] for r in df.select(P.canonical_region("pro").alias("r")).collect()]
    assert got == ["北京市", "广东省", "新疆维吾尔自治区", None]


def test_space_split_tokens(spark):
    df = parsing.space_split(parsing.filter_min_length(lines_df(spark, [VALID, SHORT])))
    r = df.collect()
    assert len(r) == 1
    assert (r[0]["remote_addr"], r[0]["time_token"], r[0]["bytes_token"]) == (
        "1.2.3.4", "[22/Jan/2019:03:56:16", "5667")


def test_parse_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = parsing.access_table(lines_df(spark, [VALID])).first()
        assert r["epoch_ms"] == 1548116776000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_no_python_udfs_in_parse_plan(spark):
    df = parsing.access_table(lines_df(spark, [VALID]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert df.select(F.col("status")).first()[0] == 200
