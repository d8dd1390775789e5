"""IP -> region range join and the geographic distribution report.

A plain ``ip BETWEEN lo AND hi`` join has no equi-key, so Spark can only plan a nested-loop join (every IP
against every range). Instead both sides are written as strings of hexadecimal digits (``parse.address_key_sql``, IPv4 and
IPv6 alike), and each range is cut into the blocks that begin with some digits and hold all that can follow, like
a word list's prefixes: at most 30 per digit, and mostly one. An address lies in a range exactly if one of its own prefixes is such a
block, so the join is one of equal prefixes, of the few lengths that the range table has.

Ranges may be nested: the longest block is that of the innermost range. Blocks are made unique before the join, so an
address finds at most one per length and takes the longest: one row per address, always.

The big side is pre-aggregated to one row per distinct IP *before* the join, so a hot IP (a third of all rows)
is one row at join time; a block that many addresses lie in is one row on the other side, and Spark splits such a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.functions.plan import written

_DIGITS = "0123456789abcdef"
_KEY = 32                         # digits of an address


def keyed_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges (lo, hi, pro, city) -> with ``lo`` and ``hi`` as address keys; numbers are IPv4, texts are addresses of any form.

    A range whose ends are no addresses, or the wrong way round, holds nothing.
    """
    def key(c: str):
        if dict(ranges.dtypes)[c] == "string":
            return F.expr(P.address_key_sql(c))
        return F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.lower(F.hex(F.col(c).cast("bigint"))), 8, "0"))
    return ranges.select(key("lo").alias("lo"), key("hi").alias("hi"), "pro", "city").where("lo <= hi")


def blocks(ranges: DataFrame) -> DataFrame:
    """(prefix, pro, city): the blocks of all keyed ranges, each once, with the region of the innermost range that has it.

    Of ranges that share a block the one with the greater ``lo`` is the inner one, then that with the smaller ``hi``.
    """
    digit = f"array({', '.join(repr(d) for d in _DIGITS)})"
    same = f"coalesce(get(filter(sequence(1, {_KEY}), p -> substring(lo, p, 1) <> substring(hi, p, 1)), 0) - 1, {_KEY})"
    cut = ranges.selectExpr("*", f"{same} AS _same", "length(trim(TRAILING '0' FROM lo)) AS _lo",
                                "length(trim(TRAILING 'f' FROM hi)) AS _hi") \
                .selectExpr("*", "greatest(_lo, _same + 1) AS _left", "greatest(_hi, _same + 1) AS _right")
    # Between the two ends where they part; above the lower end and below the upper one at each later digit; the ends.
    between = f"transform(filter({digit}, d -> d > substring(lo, _same + 1, 1) AND d < substring(hi, _same + 1, 1)), d -> left(lo, _same) || d)"
    after = "filter(sequence(1, {n}), p -> p > _same + 1 AND p <= {end})"
    above = (f"flatten(transform({after.format(n=_KEY, end='_left')}, p -> transform(filter({digit}, d -> d > substring(lo, p, 1)), "
             "d -> left(lo, p - 1) || d)))")
    below = (f"flatten(transform({after.format(n=_KEY, end='_right')}, p -> transform(filter({digit}, d -> d < substring(hi, p, 1)), "
             "d -> left(hi, p - 1) || d)))")
    whole = "_lo <= _same AND _hi <= _same"
    pieces = cut.selectExpr("lo", "hi", "pro", "city", f"""explode(CASE WHEN {whole} THEN array(left(lo, _same))
        ELSE concat({between}, {above}, {below}, array(left(lo, _left), left(hi, _right))) END) AS prefix""")
    inner = F.struct("lo", F.translate("hi", _DIGITS, _DIGITS[::-1]), F.coalesce("pro", F.lit("")), F.coalesce("city", F.lit("")))
    return pieces.groupBy("prefix").agg(F.max_by(F.struct("pro", "city"), inner).alias("_r")).select("prefix", "_r.pro", "_r.city")


def lookup(ips: DataFrame, ranges: DataFrame, ip_col: str = "ip", shuffle: bool = False) -> DataFrame:
    """Left range join: each row of ``ips`` gets (pro, city) of the innermost range that holds it, and ``ip_num`` (IPv4).

    Spark chooses between broadcast and shuffle by bytes at run time; ``shuffle`` asks for the
    sort-merge form. What is no address meets no range.
    """
    table = written(blocks(keyed_ranges(ranges)), "geo-blocks")
    lengths = sorted(r[0] for r in table.select(F.length("prefix")).distinct().collect())          # at most 33 numbers
    left = ips.select("*", P.ip_to_long(ip_col).alias("ip_num"))
    if not lengths:
        return left.withColumn("pro", F.lit(None).cast("string")).withColumn("city", F.lit(None).cast("string"))
    keyed = left.select(ip_col, F.expr(P.address_key_sql(ip_col)).alias("_key")).where("_key IS NOT NULL").distinct()
    prefixes = keyed.select(ip_col, F.explode(F.expr(f"transform(array({', '.join(map(str, lengths))}), n -> left(_key, n))")).alias("prefix"))
    right = table.hint("merge") if shuffle else table
    found = prefixes.join(right, "prefix").groupBy(F.col(ip_col).alias("_ip")) \
        .agg(F.max_by(F.struct("pro", "city"), F.length("prefix")).alias("_r"))
    found = found.select("_ip", "_r.pro", "_r.city")
    return left.join(found.hint("merge") if shuffle else found, F.col(ip_col) == F.col("_ip"), "left").drop("_ip")


def ip_occurrences(lines: DataFrame, line: str = "line") -> DataFrame:
    """Every dotted-quad in every line (look-alikes included), with its position."""
    return lines.select("event_id", F.posexplode(P.find_ips(line)).alias("pos", "ip"))


def ips_by_region(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """IP occurrences per province: pre-aggregate per IP, look up distinct IPs,
    drop rows with a missing province/city/ip or an empty province, count.
    Grouped by the province as resolved; the canonical name is attached after."""
    per_ip = (lines.select(F.explode(P.find_ips("line")).alias("ip"))
              .groupBy("ip").agg(F.count(F.lit(1)).alias("n")))
    geo = lookup(per_ip, ranges)
    kept = geo.dropna(subset=["pro", "city", "ip"]).filter(F.col("pro") != "")
    return (kept.groupBy("pro").agg(F.sum("n").alias("ips"))
            .select("pro", P.canonical_region("pro").alias("region"), "ips"))


def first_n_ips(lines: DataFrame, ranges: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` IP occurrences in log order, resolved — a top-k, not a full sort."""
    occ = ip_occurrences(lines).orderBy("event_id", "pos").limit(n)
    return lookup(occ, ranges)


# The fields of a geo service's reply that are used.
REPLY_SCHEMA = "pro STRING, city STRING, ip STRING"


def parse_replies(lines: DataFrame, line: str = "line") -> DataFrame:
    """JSON replies, one per line -> (pro, city, ip, bad): ``bad`` holds a reply that is no JSON object.

    The service escapes characters that JSON does not know; a backslash counts as a space.
    """
    text = F.translate(F.col(line), "\\", " ")
    reply = F.from_json(text, REPLY_SCHEMA + ", _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select(reply.alias("r"), F.col(line).alias("_text")).select(
        "r.pro", "r.city", "r.ip", F.when(F.col("r").isNull() | F.col("r._bad").isNotNull(), F.col("_text")).alias("bad"))


def replies_by_region(replies: DataFrame) -> DataFrame:
    """Replies per province, official names attached; those without province, city or ip are dropped."""
    kept = replies.where("bad IS NULL").dropna(subset=["pro", "city", "ip"]).where("pro <> ''")
    return kept.groupBy("pro").agg(F.count(F.lit(1)).alias("ips")).select("pro", P.canonical_region("pro").alias("region"), "ips")
