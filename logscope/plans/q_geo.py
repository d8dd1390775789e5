"""Geography: range join, distribution per province, first-N lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.operators import geo
from logscope.plans.inputs import fields, geo_ranges, lines
from logscope.plans.oracle_sql import having
from logscope.plans.q_parse import _CANON_SQL
from logscope.plans.registry import register
from logscope.sources import fixture

_IP_NUM_SQL = r"""
CASE WHEN len(string_split(ip, '.')) = 4 AND list_bool_and(list_transform(string_split(ip, '.'),
          lambda x: length(x) <= 3 AND TRY_CAST(x AS INTEGER) <= 255))
     THEN CAST(string_split(ip, '.')[1] AS BIGINT) * 16777216 + CAST(string_split(ip, '.')[2] AS BIGINT) * 65536
        + CAST(string_split(ip, '.')[3] AS BIGINT) * 256 + CAST(string_split(ip, '.')[4] AS BIGINT) END"""

_FOUND = r"regexp_extract_all(line, '(\d+\.\d+\.\d+\.\d+)', 1)"

_LOOKUP_SQL = f"""
WITH ips AS (SELECT DISTINCT unnest({_FOUND}) AS ip FROM access_log),
ipn AS (SELECT ip, {_IP_NUM_SQL} AS ip_num FROM ips)
SELECT ip, ip_num, pro, city FROM ipn LEFT JOIN geo_ranges ON ip_num BETWEEN lo AND hi"""

_BY_REGION_SQL = f"""
WITH occ AS (SELECT unnest({_FOUND}) AS ip FROM access_log),
ipn AS (SELECT ip, {_IP_NUM_SQL} AS ip_num FROM occ),
geo AS (SELECT ip, pro, city FROM ipn LEFT JOIN geo_ranges ON ip_num BETWEEN lo AND hi),
by_pro AS (SELECT pro, count(*) AS ips FROM geo
           WHERE pro IS NOT NULL AND city IS NOT NULL AND ip IS NOT NULL AND pro <> '' GROUP BY pro)"""


def _distinct_ips(spark, sf):
    return lines(spark, sf).select(F.explode(P.find_ips("line")).alias("ip")).distinct()


@register("geo_lookup", _LOOKUP_SQL)
def geo_lookup(spark, sf):
    """Distinct found IPs -> (province, city) by bucketed range join (broadcast or shuffle as Spark decides)."""
    return geo.lookup(_distinct_ips(spark, sf), geo_ranges(spark, sf)).select(
        "ip", "ip_num", "pro", "city")


@register("geo_lookup_bucketed", _LOOKUP_SQL)
def geo_lookup_bucketed(spark, sf):
    """Same range join in its shuffle form (sort-merge on the /16 bucket key)."""
    return geo.lookup(_distinct_ips(spark, sf), geo_ranges(spark, sf), shuffle=True).select(
        "ip", "ip_num", "pro", "city")


@register("geo_client_lookup", f"""
WITH c AS (SELECT DISTINCT remote_addr AS ip FROM {having("remote_addr")}),
n AS (SELECT ip, CASE WHEN starts_with(ip, '2001:db8::') THEN 6 WHEN regexp_full_match(ip, '[0-9.]+') THEN 4 END AS family,
             CASE WHEN starts_with(ip, '2001:db8::') THEN CAST('0x' || substring(ip, 11) AS BIGINT) ELSE {_IP_NUM_SQL} END AS num FROM c),
r AS (SELECT ip, pro, city, row_number() OVER (PARTITION BY ip ORDER BY hi - lo) AS nth
      FROM n LEFT JOIN geo_blocks g ON n.family = g.family AND num BETWEEN lo AND hi)
SELECT ip AS client, pro, city FROM r WHERE nth = 1""")
def geo_client_lookup(spark, sf):
    """Clients of any form -> (province, city) of the innermost of nested IPv4 and IPv6 ranges; one row per client."""
    clients = fields(spark, sf, "remote_addr").select(F.col("remote_addr").alias("client")).distinct()
    return geo.lookup(clients, fixture.read_geo_blocks(spark, sf), "client").select("client", "pro", "city")


@register("ips_by_region", _BY_REGION_SQL + f"""
SELECT pro, {_CANON_SQL} AS region, ips FROM by_pro""")
def ips_by_region(spark, sf):
    """IP occurrences per province (pivot count), canonical province name attached."""
    return geo.ips_by_region(lines(spark, sf), geo_ranges(spark, sf))


@register("ips_by_region_max", _BY_REGION_SQL + """
SELECT max(ips) AS max_ips FROM by_pro""")
def ips_by_region_max(spark, sf):
    """Scale maximum of the per-province distribution."""
    return geo.ips_by_region(lines(spark, sf), geo_ranges(spark, sf)).agg(
        F.max("ips").alias("max_ips"))


@register("first_n_ips", f"""
WITH occ AS (SELECT event_id, unnest(range(len(arr))) AS pos, unnest(arr) AS ip
             FROM (SELECT event_id, {_FOUND} AS arr FROM access_log)),
firstn AS (SELECT * FROM occ ORDER BY event_id, pos LIMIT 1000),
ipn AS (SELECT event_id, pos, ip, {_IP_NUM_SQL} AS ip_num FROM firstn)
SELECT event_id, pos, ip, ip_num, pro, city FROM ipn LEFT JOIN geo_ranges ON ip_num BETWEEN lo AND hi""")
def first_n_ips(spark, sf):
    """The first 1000 IP occurrences in log order, resolved to a region."""
    out = geo.first_n_ips(lines(spark, sf), geo_ranges(spark, sf), 1000)
    return out.select("event_id", F.col("pos").cast("bigint").alias("pos"), "ip", "ip_num",
                      "pro", "city")


def _replies(spark, sf):
    """One reply per found IP of a known province; some are broken, some lack the province."""
    found = geo.lookup(_distinct_ips(spark, sf), geo_ranges(spark, sf)).where("city IS NOT NULL")
    good = F.to_json(F.struct("pro", "city", "ip"))
    return found.select(F.when(F.col("ip").endswith("7"), F.concat(F.lit("{broken "), "ip")).otherwise(good).alias("line"))


@register("geo_replies", f"""
WITH ips AS (SELECT DISTINCT unnest({_FOUND}) AS ip FROM access_log),
ipn AS (SELECT ip, {_IP_NUM_SQL} AS ip_num FROM ips),
geo AS (SELECT ip, pro, city FROM ipn JOIN geo_ranges ON ip_num BETWEEN lo AND hi)
SELECT pro, {_CANON_SQL} AS region, count(*) AS ips FROM geo
WHERE pro IS NOT NULL AND pro <> '' AND ip NOT LIKE '%7' GROUP BY pro""")
def geo_replies(spark, sf):
    """JSON replies of a geo service, one per line, counted per province; broken ones are set aside."""
    return geo.replies_by_region(geo.parse_replies(_replies(spark, sf)))
