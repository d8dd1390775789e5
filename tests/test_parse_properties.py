"""Property tests: random well-formed log lines round-trip through both parsers."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logscope.functions.parse import ACCESS_COLUMNS
from logscope.operators import parsing

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
URL_CHARS = "abcxyz0123456789/?|()&=%._-"
TEXT_CHARS = "abcXYZ019 ;:/().,-_"

record = st.fixed_dictionaries({
    "ip": st.tuples(*[st.integers(0, 255)] * 4),
    "ts": st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31)),
    "offset_min": st.sampled_from([0, -480, 330, 210, 60, -150]),
    "method": st.sampled_from(["GET", "POST", "HEAD", "PUT", "DELETE"]),
    "url": st.text(URL_CHARS, min_size=1, max_size=30).map(lambda u: "/" + u),
    "version": st.sampled_from(["HTTP/1.0", "HTTP/1.1", "HTTP/2.0"]),
    "status": st.integers(100, 599),
    "bytes": st.integers(0, 10**7),
    "referer": st.one_of(st.just("-"), st.text(URL_CHARS, min_size=0, max_size=20)),
    "agent": st.text(TEXT_CHARS, min_size=1, max_size=40).filter(lambda a: a.strip() == a and a),
    "tail": st.booleans(),
})


def _offset_text(minutes: int) -> str:
    sign = "+" if minutes >= 0 else "-"
    m = abs(minutes)
    return f"{sign}{m // 60:02d}{m % 60:02d}"


def _line(r: dict) -> str:
    ts = r["ts"].replace(microsecond=0)
    t = f"{ts.day:02d}/{MONTHS[ts.month - 1]}/{ts.year}:{ts:%H:%M:%S}"
    ip = ".".join(map(str, r["ip"]))
    return (f'{ip} - - [{t} {_offset_text(r["offset_min"])}] "{r["method"]} {r["url"]} {r["version"]}" '
            f'{r["status"]} {r["bytes"]} "{r["referer"]}" "{r["agent"]}"' + (' "-"' if r["tail"] else ""))


def _epoch_ms(r: dict) -> int:
    ts = r["ts"].replace(microsecond=0)
    tz = dt.timezone(dt.timedelta(minutes=r["offset_min"]))
    return int(ts.replace(tzinfo=tz).timestamp() * 1000)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=20, max_size=80))
def test_split_parser_recovers_every_field(spark, records):
    df = spark.createDataFrame([(i, _line(r)) for i, r in enumerate(records)], "event_id BIGINT, line STRING")
    got = {row["event_id"]: row for row in parsing.access_table(df).collect()}
    assert len(got) == len(records)
    for i, r in enumerate(records):
        row = got[i]
        ts = r["ts"]
        assert row["remote_addr"] == ".".join(map(str, r["ip"]))
        assert row["time_local"] == f"{ts.day:02d}/{MONTHS[ts.month - 1]}/{ts.year}:{ts:%H:%M:%S}"
        assert row["tz_offset"] == _offset_text(r["offset_min"])
        assert (row["request_method"], row["request_url"], row["http_version"]) == (
            r["method"], r["url"], r["version"])
        assert (row["status"], row["body_bytes_send"]) == (r["status"], r["bytes"])
        assert (row["http_referer"], row["http_user_agent"]) == (r["referer"], r["agent"])
        assert row["epoch_ms"] == _epoch_ms(r)
        assert row["hour"] == f"{ts:%H}"
    assert set(ACCESS_COLUMNS) <= set(parsing.access_table(df).columns)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=20, max_size=60))
def test_strict_parser_agrees_with_split_parser(spark, records):
    df = spark.createDataFrame([(i, _line(r)) for i, r in enumerate(records)], "event_id BIGINT, line STRING")
    strict = {row["event_id"]: row for row in parsing.strict_parse_normalised(df).collect()}
    split = {row["event_id"]: row for row in parsing.access_table(df).collect()}
    for i, r in enumerate(records):
        if " " in r["referer"]:
            continue                      # the strict grammar wants a referer without spaces
        s = strict[i]
        assert s["ip"] == split[i]["remote_addr"]
        assert (s["request_method"], s["url"], s["protocol"]) == (r["method"], r["url"], r["version"])
        assert (int(s["status"]), int(s["bytes_sent"])) == (r["status"], r["bytes"])
        assert s["referer"] == r["referer"]
        assert s["user_agent_norm"] == r["agent"]
        assert s["user_agent"] == (r["agent"] + '" "-' if r["tail"] else r["agent"])
