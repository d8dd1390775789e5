"""Address keys, blocks and the range join against the standard library's addresses."""

from __future__ import annotations

import ipaddress
import random

from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import geo


def _key(text):
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return f"{(0xffff << 32 | int(a)) if a.version == 4 else int(a):032x}"


GOOD = ["0.0.0.0", "255.255.255.255", "10.1.2.3", "::", "::1", "1::", "2001:db8::7f", "2001:DB8:0:0:8:800:200C:417A", "fe80::1:2:3:4",
        "::ffff:10.1.2.3", "64:ff9b::192.0.2.33", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4"]
BAD = ["", "host", "1.2.3", "1.2.3.256", "1.2.3.4.5", "1::2::3", ":::", "1:::2", ":1::2", "1::2:", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
       "1:2:3:4::5:6:7:8", "12345::", "g::", "::1.2.3.256", "1:2", ":", "fe80::1%eth0", "-", "a:b"]


def test_address_keys(spark):
    df = spark.createDataFrame([(t,) for t in GOOD + BAD] + [(None,)], "ip STRING")
    got = {r["ip"]: r["k"] for r in df.select("ip", F.expr(P.address_key_sql("ip")).alias("k")).collect()}
    assert {t: got[t] for t in GOOD} == {t: _key(t) for t in GOOD}
    assert all(got[t] is None for t in [*BAD, None])


def _text(n, family):
    return str(ipaddress.IPv4Address(n) if family == 4 else ipaddress.IPv6Address(n))


def test_blocks_cover_their_range_and_nothing_else(spark):
    rng, rows = random.Random(4), []
    for i in range(60):
        family, bits = (4, 32) if i % 2 else (6, 128)
        low = rng.randrange(1 << bits)
        width = rng.choice([0, 1, 15, 16, 255, 256, 1 << (bits // 2), rng.randrange(1 << rng.randrange(1, bits))])
        if i % 3 == 0:
            low &= ~width
        rows.append((family, low, min(low + width, (1 << bits) - 1), f"r{i}"))
    rows += [(6, 0, (1 << 128) - 1, "all"), (6, 1, (1 << 128) - 1, "all but one"), (4, 0, (1 << 32) - 1, "v4"), (4, 5, 4, "wrong")]
    for family, low, high, name in rows:
        table = spark.createDataFrame([(_text(low, family), _text(high, family), name, "c")], "lo STRING, hi STRING, pro STRING, city STRING")
        keyed = geo.keyed_ranges(table)
        found = sorted(r["prefix"] for r in geo.blocks(keyed).collect()) if name in ("all", "all but one", "wrong", "v4") or int(name[1:]) < 12 else None
        if found is None:
            continue
        if low > high:
            assert found == []
            continue
        base = (0xffff << 32) if family == 4 else 0
        spans = sorted((int(p.ljust(32, "0"), 16), int(p.ljust(32, "f"), 16)) for p in found)
        assert spans[0][0] == base + low and spans[-1][1] == base + high
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


def test_lookup_finds_the_innermost_range_once(spark):
    rng, ranges = random.Random(9), []

    def nest(low, high, depth, name):
        ranges.append((low, high, name))
        if depth and high - low > 8:
            cuts = sorted(rng.sample(range(low, high), 4))
            nest(cuts[0], cuts[1], depth - 1, name + "a")
            nest(cuts[2], cuts[3], depth - 1, name + "b")
            if rng.random() < 0.5:
                nest(low, cuts[0] - 1, depth - 1, name + "c") if cuts[0] > low else None
    nest(10 << 24, (14 << 24) - 1, 4, "x")
    six = 0x20010DB8 << 96
    v6 = [(six, six + (1 << 96) - 1, "six"), (six + 5, six + (1 << 70), "inner"), (six + 77, six + 77, "one")]
    table = [(_text(a, 4), _text(b, 4), n, "c") for a, b, n in ranges] + [(_text(a, 6), _text(b, 6), n, "c") for a, b, n in v6]
    ips = [_text(rng.randrange(9 << 24, 15 << 24), 4) for _ in range(600)] + [_text(a + d, 4) for a, b, _ in ranges for d in (0, b - a)]
    ips += [_text(six + d, 6) for d in (0, 4, 5, 77, 78, 1 << 70, (1 << 70) + 1, 1 << 95)] + ["2001:db9::1", "host", "::1"]
    want = {}
    for t in set(ips):
        k = _key(t)
        n = None if k is None else int(k, 16)
        near = [(b - a, name) for a, b, name in [((0xffff << 32) + a, (0xffff << 32) + b, m) for a, b, m in ranges] + v6 if n is not None and a <= n <= b]
        want[t] = min(near)[1] if near else None
    addresses = spark.createDataFrame([(t,) for t in sorted(set(ips))], "ip STRING")
    made = spark.createDataFrame(table, "lo STRING, hi STRING, pro STRING, city STRING")
    for shuffle in (False, True):
        rows = geo.lookup(addresses, made, shuffle=shuffle).collect()
        assert len(rows) == len(want) and {r["ip"]: r["pro"] for r in rows} == want
    assert geo.lookup(addresses, made.limit(0)).where("pro IS NULL").count() == len(want)


def test_numeric_ranges_and_repeated_rows(spark):
    ranges = spark.createDataFrame([(16777216, 33554431, None, "c"), (16777216, 33554431, "b", "c")], "lo BIGINT, hi BIGINT, pro STRING, city STRING")
    ips = spark.createDataFrame([("1.2.3.4",), ("1.2.3.4",), ("2.0.0.0",)], "ip STRING")
    got = sorted((r["ip"], r["ip_num"], r["pro"] or "") for r in geo.lookup(ips, ranges).collect())
    assert got == [("1.2.3.4", 16909060, "b")] * 2 + [("2.0.0.0", 33554432, "")]
