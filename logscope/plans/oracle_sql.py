"""DuckDB SQL building blocks for the oracle side of every query.

Only the raw driver tables are registered as views, so each oracle statement is
prefixed with the CTEs below (``with_ctes``). The CTEs restate, in SQL, the same
semantics the Spark operators implement: the fixture lines, the split parser,
the strict regex parser and the geo range table.
"""

from __future__ import annotations

from logscope.functions.parse import STRICT_LOG_REGEX

_STRICT_GROUPS = ["ip", "time", "request_method", "url", "protocol", "status",
                  "bytes_sent", "referer", "user_agent"]

ACCESS_LOG_CTE = """
access_log AS (
SELECT event_id, ts, user_id,
  CASE WHEN event_id % 97 = 0 THEN 'bad line'
       WHEN event_id % 101 = 0 THEN '- - broken request without any quotes'
       ELSE concat(
  CASE WHEN user_id % 11 = 3 THEN concat('2001:db8::', lower(to_hex(user_id)))
       WHEN user_id % 13 = 5 THEN concat('host', CAST(user_id AS STRING), '.example.net') ELSE concat(
  CAST(10 + user_id % 25 AS STRING), '.', CAST((user_id*7) % 256 AS STRING), '.',
  CAST((user_id*13) % 256 AS STRING), '.', CAST(1 + user_id % 254 AS STRING)) END,
  ' - - [', strftime(ts,'%d/%b/%Y:%H:%M:%S'), ' +0000] "', CASE WHEN event_id % 23 = 0 THEN '-' ELSE concat(
  CASE WHEN event_id % 13 = 0 THEN 'HEAD' WHEN event_type IN ('purchase','signup') THEN 'POST' ELSE 'GET' END, ' ',
  CASE WHEN event_id % 29 = 0 THEN '/search?q=two words ' ELSE '' END,
  CASE event_type WHEN 'purchase' THEN concat('/cart?item=', json_extract_string(props,'$.k')) WHEN 'signup' THEN '/signup'
       WHEN 'error' THEN concat('/filter/27|', json_extract_string(props,'$.k')) ELSE concat('/product/', json_extract_string(props,'$.k')) END, ' ',
  CASE WHEN event_id % 10 = 0 THEN 'HTTP/1.0' WHEN event_id % 7 = 0 THEN 'HTTP/2.0' ELSE 'HTTP/1.1' END) END, '" ',
  CASE WHEN event_id % 23 = 0 THEN '408' WHEN event_id % 19 = 0 THEN '304' WHEN event_type = 'error' AND event_id % 2 = 0 THEN '500' WHEN event_type = 'error' THEN '404'
       WHEN event_id % 17 = 0 THEN '302' ELSE '200' END, ' ',
  CASE WHEN event_id % 19 = 0 THEN '-' WHEN event_id % 31 = 0 THEN '3000000000' ELSE CAST((event_id * 37) % 50000 AS STRING) END,
  CASE WHEN event_id % 37 = 0 THEN '' ELSE concat(' "', CASE WHEN event_id % 3 = 0 THEN '-' ELSE concat('https://www.example.com/ref/', CAST(user_id % 12 AS STRING)) END, '" "',
  CASE user_id % 5 WHEN 0 THEN 'Mozilla/5.0 (Windows NT 6.1) Chrome/66.0.3359.117 Safari/537.36'
     WHEN 1 THEN 'Mozilla/5.0 (Linux; Android 6.0) Chrome/71.0.3578.99 Mobile'
     WHEN 2 THEN 'Mozilla/5.0 (compatible; bingbot/2.0)' WHEN 3 THEN 'AhrefsBot/6.1' ELSE '-' END, '"',
  CASE WHEN event_id % 2 = 0 THEN ' "-"' ELSE '' END) END) END AS line
FROM events)"""

# One column per field, each by its own rule; reports name what they need (``having``).
FIELDS_CTE = r"""
pieces AS (
  SELECT event_id, line, string_split(line, ' ') AS tok, string_split(line, '"') AS q FROM access_log),
pieces2 AS (
  SELECT *, string_split(q[2], ' ') AS req, string_split(trim(q[3]), ' ') AS sb,
         CASE WHEN starts_with(tok[4], '[') THEN substring(tok[4], 2) END AS time_local,
         regexp_replace(tok[5], '\]$', '') AS tz_offset FROM pieces),
fields AS (
  SELECT event_id, line, time_local, tz_offset, len(tok) AS tokens, len(q) AS fragments, '- -' AS remote_user,
    CASE WHEN len(q) > 1 AND tok[1] NOT IN ('', '-') THEN tok[1] END AS remote_addr,
    CASE WHEN regexp_matches(time_local, '^[0-9]{2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{2}:') THEN substring(time_local, 13, 2) END AS hour,
    CASE WHEN regexp_matches(time_local, '^[0-9]{2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{2}:')
         THEN TRY_CAST(substring(time_local, 1, 2) AS INTEGER) END AS day,
    epoch_ms(try_strptime(time_local || ' ' || tz_offset, '%d/%b/%Y:%H:%M:%S %z')) AS epoch_ms,
    CASE WHEN regexp_full_match(req[1], '[A-Za-z]+') THEN req[1] END AS request_method,
    CASE WHEN starts_with(req[len(req)], 'HTTP/') THEN nullif(array_to_string(req[2:len(req) - 1], ' '), '')
         ELSE nullif(array_to_string(req[2:], ' '), '') END AS request_url,
    CASE WHEN starts_with(req[len(req)], 'HTTP/') THEN req[len(req)] END AS http_version,
    TRY_CAST(sb[1] AS INTEGER) AS status, TRY_CAST(sb[2] AS BIGINT) AS body_bytes_send,
    q[4] AS http_referer, q[6] AS http_user_agent
  FROM pieces2),
access_all AS (
  SELECT *, CASE WHEN length(line) <= 10 THEN 'too_short' WHEN fragments < 3 THEN 'no_request'
                 WHEN remote_addr IS NULL THEN 'bad_address' WHEN status IS NULL THEN 'bad_status'
                 WHEN epoch_ms IS NULL THEN 'bad_time' END AS reject FROM fields),
access AS (SELECT * FROM access_all WHERE reject IS NULL)"""


def having(*names: str) -> str:
    """The rows of a report that needs these fields."""
    return "(SELECT * FROM fields WHERE length(line) > 10 AND " + " AND ".join(f"{n} IS NOT NULL" for n in names) + ")"


def hourly(*names: str) -> str:
    return "(SELECT * FROM " + having("hour", *names) + " WHERE tokens > 10)"


def _strict_cte() -> str:
    re_lit = STRICT_LOG_REGEX.replace("'", "''")
    groups = ",\n    ".join(
        f"regexp_extract(line, '{re_lit}', {i + 1}) AS {g}" for i, g in enumerate(_STRICT_GROUPS))
    return f"""
strict AS (
  SELECT event_id, line,
    {groups}
  FROM access_log WHERE regexp_matches(line, '{re_lit}'))"""


GEO_CTE = """
geo_ranges AS (
  SELECT (10 + k) * CAST(16777216 AS BIGINT) AS lo, (11 + k) * CAST(16777216 AS BIGINT) - 1 AS hi,
         pro, concat('city_', CAST(k AS STRING)) AS city
  FROM nation JOIN (VALUES (0,'新疆'),(1,'广西'),(2,'宁夏'),(3,'内蒙古'),(4,'西藏'),(5,'北京'),(6,'天津'),
    (7,'重庆'),(8,'上海'),(9,'香港'),(10,'澳门'),(11,'广东省'),(12,'江苏省'),(13,'浙江省'),(14,'山东省'),
    (15,'河南省'),(16,'四川省'),(17,'湖北省'),(18,'湖南省'),(19,'福建省'),(20,'安徽省'),(21,'河北省'),
    (22,'陕西省'),(23,''),(24,CAST(NULL AS STRING))) AS t(k, pro) ON n_nationkey = k),
geo_blocks AS (
  SELECT 4 AS family, lo, hi, pro, city FROM geo_ranges
  UNION ALL SELECT 4, lo, lo + 128 * 65536 - 1, pro, replace(city, 'city', 'half') FROM geo_ranges
  UNION ALL SELECT 4, lo + 64 * 65536 + 10 * 256 + 5, lo + 100 * 65536 + 200 * 256 + 17, pro, replace(city, 'city', 'odd') FROM geo_ranges
  UNION ALL SELECT 6, 16 * (lo // 16777216 - 10), 16 * (lo // 16777216 - 10) + 11, pro, replace(city, 'city', 'six') FROM geo_ranges
  UNION ALL SELECT 6, 0, 4611686018427387904, '文档', 'six')"""

ALL_CTES = ",".join([ACCESS_LOG_CTE, FIELDS_CTE, _strict_cte(), GEO_CTE])


def with_ctes(body: str) -> str:
    """Prefix the shared CTEs; a body with its own WITH list is merged into it."""
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ALL_CTES + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return "WITH " + ALL_CTES + ",\n" + body[5:]
    return "WITH " + ALL_CTES + "\n" + body
