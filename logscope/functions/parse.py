"""Column expressions over raw access-log lines.

Everything here is a built-in Spark expression (no Python row functions), so it
stays inside whole-stage codegen. Untrusted text is handled with the ANSI-safe
forms: ``get`` instead of ``arr[i]``, ``try_cast``, ``try_to_timestamp``.

Each expression is produced as Spark SQL text (``*_sql``) and wrapped with
``F.expr`` for Column users: one driver call per expression instead of one per
operator node — building a query over the full parser stays cheap.

Line grammar:
  ip - - [dd/MMM/yyyy:HH:mm:ss +zzzz] "METHOD URL HTTP/x.y" status bytes "referer" "agent"[ "-"]

Splits keep trailing empty strings (Spark never drops them); ``get`` returns
NULL for a missing position, so short lines yield NULL fields instead of errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict combined-log regex (Java and RE2 read it the same
# way). Groups: ip, time, request_method, url, protocol, status, bytes_sent,
# referer, user_agent. Anchored at both ends (``\z`` = end of input).
STRICT_LOG_REGEX = (
    r'^(\d+\.\d+\.\d+\.\d+)\s+-\s+-\s+\[(.+?)\]\s+"(\w+)\s+(\S+)\s+(HTTP/\d\.\d)"\s+'
    r'(\d+)\s+(\d+)\s+"(\S*)"\s+"(.+?)"\s*\z'
)
STRICT_LOG_GROUPS = ["ip", "time", "request_method", "url", "protocol", "status",
                     "bytes_sent", "referer", "user_agent"]

# Dotted-quad pattern of the IP find-all.
IP_FIND_REGEX = r"(\d+\.\d+\.\d+\.\d+)"

# Timestamp layout of the log (with the numeric offset appended).
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# What the beginning of a usable time looks like.
TIME_REGEX = r"^[0-9]{2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{2}:"

MIN_LINE_LENGTH = 10   # keep lines strictly longer than this
MIN_LINE_TOKENS = 10   # keep lines with strictly more space tokens than this

# The columns of the access table.
ACCESS_COLUMNS = ["remote_addr", "remote_user", "time_local", "status", "body_bytes_send",
                  "request_method", "request_url", "http_version", "http_referer",
                  "http_user_agent"]


def sql_str(s: str) -> str:
    """A Spark SQL string literal holding exactly ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- split parser

def split_fields_sql(line: str = "line") -> dict[str, str]:
    """Every field of a line, each by its own rule: NULL when that field is unusable, whatever the others are.

    Whole-line space tokens 0, 3, 4 = address, time, offset; quote-split fragments 1 = request,
    2 = status and bytes, 3 = referer, 5 = agent. A URL may hold spaces: it is all between the
    method and the version. A size of ``-`` is NULL. The address is whatever names the client: IPv4, IPv6
    or a host name, of any line that has a quoted request; ``-`` and nothing are NULL. Whether it
    is an IPv4 address matters to geography alone (``ip_to_long``).
    """
    q, tok = f"split({line}, '\"', -1)", f"split({line}, ' ', -1)"
    req, sb = f"split(get({q}, 1), ' ', -1)", f"split(trim(get({q}, 2)), ' ', -1)"
    addr, last = f"get({tok}, 0)", f"get({req}, size({req}) - 1)"
    time_local = f"if(startswith(get({tok}, 3), '['), substring(get({tok}, 3), 2), NULL)"
    version = f"if(startswith({last}, 'HTTP/'), {last}, NULL)"
    n_url = f"size({req}) - if(startswith({last}, 'HTTP/'), 2, 1)"
    return {
        "remote_addr": f"if(contains({line}, '\"') AND {addr} NOT IN ('', '-'), {addr}, NULL)",
        "remote_user": "'- -'",
        "time_local": time_local,
        "tz_offset": _strip_bracket(f"get({tok}, 4)"),
        "hour": f"if({time_local} RLIKE {sql_str(TIME_REGEX)}, substring({time_local}, 13, 2), NULL)",
        "day": f"if({time_local} RLIKE {sql_str(TIME_REGEX)}, try_cast(substring({time_local}, 1, 2) AS INT), NULL)",
        "request_method": f"if(get({req}, 0) RLIKE '^[A-Za-z]+$', get({req}, 0), NULL)",
        "request_url": f"if({n_url} > 0, nullif(array_join(slice({req}, 2, {n_url}), ' '), ''), NULL)",
        "http_version": version,
        "status": f"try_cast(get({sb}, 0) AS INT)",
        "body_bytes_send": f"try_cast(get({sb}, 1) AS BIGINT)",
        "http_referer": f"get({q}, 3)",
        "http_user_agent": f"get({q}, 5)",
        "tokens": f"size({tok})",
        "_fragments": f"size({q})",
    }


def _strip_bracket(x: str) -> str:
    """Drop one trailing ']' (no regex)."""
    return f"if(endswith({x}, ']'), left({x}, length({x}) - 1), {x})"


def event_time_sql(time_local: str = "time_local", tz_offset: str = "tz_offset") -> str:
    """Instant of the request; honours the line's own offset, never the session zone.

    (A hand-built ISO-8601 cast was measured as well: cheaper alone, but slower
    inside the full parser projection, so the formatter stays.)
    """
    return (f"try_to_timestamp(concat_ws(' ', {time_local}, {tz_offset}), "
            f"{sql_str(LOG_TIME_FORMAT)})")


def reject_sql(line: str = "line", event_time: str | None = None) -> str:
    """First reason why a line is no use to the log table (NULL = usable), over the field columns.

    Only what every record must have counts: an address, a time and a status. A missing size,
    request, referer or agent is a NULL field of a good record.
    """
    event_time = event_time or event_time_sql()
    return f"""CASE WHEN length({line}) <= {MIN_LINE_LENGTH} THEN 'too_short'
  WHEN _fragments < 3 THEN 'no_request'
  WHEN remote_addr IS NULL THEN 'bad_address'
  WHEN status IS NULL THEN 'bad_status'
  WHEN {event_time} IS NULL THEN 'bad_time' END"""


def hour_sql(time_text: str = "time_local") -> str:
    """Two characters after the first ':' — the local wall-clock hour (STRING)."""
    return f"substring({time_text}, instr({time_text}, ':') + 1, 2)"


def split_fields(line: str = "line") -> dict[str, Column]:
    return {k: F.expr(v) for k, v in split_fields_sql(line).items()}


def event_time(time_local: str = "time_local", tz_offset: str = "tz_offset") -> Column:
    return F.expr(event_time_sql(time_local, tz_offset))


def epoch_ms(time_local: str = "time_local", tz_offset: str = "tz_offset") -> Column:
    return F.expr(f"unix_millis({event_time_sql(time_local, tz_offset)})")


def space_tokens(line) -> Column:
    return F.split(_c(line), " ", -1)


# --------------------------------------------------------------- regex parser

def strict_packed_sql(line: str = "line") -> str:
    """All nine regex groups from ONE regex evaluation, newline-joined behind a leading newline.

    A matching line starts with a digit, so the packed text differs from the
    line exactly when the regex matched. No group can contain a newline
    (every group pattern excludes it), so splitting on newline is exact.
    """
    repl = "".join("\n$%d" % i for i in range(1, len(STRICT_LOG_GROUPS) + 1))
    return f"regexp_replace({line}, {sql_str(STRICT_LOG_REGEX)}, {sql_str(repl)})"


def strict_fields_sql(packed: str = "_packed") -> dict[str, str]:
    parts = f"split({packed}, '\\n', -1)"
    return {name: f"get({parts}, {i + 1})" for i, name in enumerate(STRICT_LOG_GROUPS)}


def normalised_agent(agent) -> Column:
    """Agent text up to its closing quote: drops a trailing '" "-' the lazy group swallows."""
    return F.regexp_extract(_c(agent), r'^([^"]*)', 1)


# --------------------------------------------------------------- keys and IPs

def row_key(ip, time_local, line, source, position) -> Column:
    """Deterministic, replay-safe key: ip_time_sha256(source:position:line).

    Source and position name the record (topic and partition with the offset, or a file with
    the place in it), so equal lines of different records differ and a replay repeats its key.
    A record without them raises: a key made of less would merge records.
    """
    def named(c) -> Column:
        c = _c(c).cast("string")
        return F.when(c.isNull(), F.raise_error(F.lit("a record has no source or position")).cast("string")).otherwise(c)
    digest = F.sha2(F.concat(named(source), F.lit(":"), named(position), F.lit(":"), _c(line)), 256)
    return F.concat_ws("_", _c(ip), _c(time_local), digest)


def log_date(time_local="time_local") -> Column:
    """The date of the record's own clock. It is part of the key, so that a redelivery has it again."""
    return F.try_to_date(F.substring(_c(time_local), 1, 11), "dd/MMM/yyyy")


def find_ips(line) -> Column:
    """Every dotted-quad substring, look-alikes such as 66.0.3359.117 included."""
    return F.regexp_extract_all(_c(line), F.lit(IP_FIND_REGEX), 1)


def ip_valid_sql(ip: str = "ip") -> str:
    o = f"split({ip}, '[.]', -1)"
    return f"(size({o}) = 4 AND forall({o}, x -> length(x) <= 3 AND try_cast(x AS INT) <= 255))"


def ip_is_valid(ip: str = "ip") -> Column:
    return F.expr(ip_valid_sql(ip))


def ip_to_long(ip: str = "ip") -> Column:
    """Numeric IPv4 value; NULL unless every octet is 0..255."""
    o = f"split({ip}, '[.]', -1)"
    parts = " + ".join(f"try_cast(get({o}, {i}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
    return F.expr(f"CASE WHEN {ip_valid_sql(ip)} THEN {parts} END")


_MAPPED = "0" * 20 + "ffff"          # what stands before an IPv4 address among the IPv6 addresses


def address_key_sql(ip: str = "ip") -> str:
    """An address as 32 hexadecimal digits, which sort as the addresses do; NULL for what is none.

    IPv4 addresses are those mapped into IPv6. ``::`` stands for zeros, a dotted tail for two groups; a zone is no
    part of an address.
    """
    def number(x: str) -> str:
        o = f"split({x}, '[.]', -1)"
        return "(" + " + ".join(f"try_cast(get({o}, {i}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)) + ")"
    tail = f"substring_index({ip}, ':', -1)"
    v4 = f"concat('{_MAPPED}', lpad(lower(hex({number(ip)})), 8, '0'))"
    plain = (f"if(contains({tail}, '.'), if({ip_valid_sql(tail)}, concat(left({ip}, length({ip}) - length({tail})), "
             f"hex({number(tail)} DIV 65536), ':', hex({number(tail)} % 65536)), NULL), {ip})")
    halves = [f"filter(split(split_part(s.p, '::', {i}), ':', -1), x -> x <> '')" for i in (1, 2)]
    short = "concat(s.a, array_repeat('0', greatest(1, 8 - size(s.a) - size(s.b))), s.b)"
    wrong = ("length(s.p) - length(replace(s.p, '::', '')) > 2 OR contains(s.p, ':::') OR s.p RLIKE '^:[^:]' OR s.p RLIKE '[^:]:$'")
    cut = f"transform(array(named_struct('p', {plain})), s -> named_struct('p', s.p, 'a', {halves[0]}, 'b', {halves[1]}))"
    listed = f"get(transform({cut}, s -> if({wrong}, NULL, if(contains(s.p, '::'), {short}, split(s.p, ':', -1)))), 0)"
    good = "size(g) = 8 AND forall(g, x -> x RLIKE '^[0-9a-fA-F]{1,4}$')"
    joined = "array_join(transform(g, x -> lpad(lower(x), 4, '0')), '')"
    v6 = f"get(transform(array({listed}), g -> if({good}, {joined}, NULL)), 0)"
    return f"CASE WHEN contains({ip}, ':') THEN {v6} WHEN {ip_valid_sql(ip)} THEN {v4} END"


# Short province names and the official form a map expects.
# Three named autonomous regions, Inner Mongolia and Tibet, four
# municipalities and two special administrative regions.
REGION_CANONICAL = {
    "新疆": "新疆维吾尔自治区",
    "广西": "广西壮族自治区",
    "宁夏": "宁夏回族自治区",
    "内蒙古": "内蒙古自治区",
    "西藏": "西藏自治区",
    "北京": "北京市",
    "天津": "天津市",
    "重庆": "重庆市",
    "上海": "上海市",
    "香港": "香港特别行政区",
    "澳门": "澳门特别行政区",
}


def canonical_region_sql(name: str = "pro") -> str:
    whens = " ".join(f"WHEN {name} = {sql_str(k)} THEN {sql_str(v)}"
                     for k, v in REGION_CANONICAL.items())
    return f"CASE {whens} ELSE {name} END"


def canonical_region(name: str = "pro") -> Column:
    return F.expr(canonical_region_sql(name))
