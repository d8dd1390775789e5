"""Line -> typed access table, filters and quarantine (DataFrame level).

The split parser is the default (cheap string splits, codegen-friendly); the
strict regex parser is used where the offline jobs need its exactness. Rows a
parser rejects are not lost: ``quarantine`` returns them with a reason.

Parsed fields are computed in one projection and then fenced (see
``functions.plan.fence``), so the validity filter reads the computed columns
instead of re-running every split and the regex inside the filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import parse as P
from logscope.functions.plan import fence

ACCESS_COLUMNS = P.ACCESS_COLUMNS


def _keep(df: DataFrame, keep) -> list[str]:
    return [k for k in keep if k in df.columns]


def filter_min_length(df: DataFrame, line: str = "line") -> DataFrame:
    return df.filter(F.length(line) > P.MIN_LINE_LENGTH)


def filter_min_tokens(df: DataFrame, line: str = "line") -> DataFrame:
    return df.filter(F.size(P.space_tokens(line)) > P.MIN_LINE_TOKENS)


def space_split(df: DataFrame, line: str = "line") -> DataFrame:
    """Whole-line space split: tokens 0 (ip), 3 (time with '['), 9 (bytes)."""
    t = f"split({line}, ' ', -1)"
    return df.selectExpr("*", f"get({t}, 0) AS remote_addr", f"get({t}, 3) AS time_token",
                         f"get({t}, 9) AS bytes_token")


def report_fields(df: DataFrame, needed: list[str], wanted: list[str] = (), line: str = "line", keep=(),
                  all_lines: bool = False) -> DataFrame:
    """``needed`` and ``wanted`` fields of the lines that have all needed ones; a wanted one may be NULL.

    ``all_lines`` keeps lines below the minimum length, too, all fields NULL.
    """
    kept, sql = _keep(df, keep), P.split_fields_sql(line)
    sql["epoch_ms"] = f"unix_millis({P.event_time_sql(sql['time_local'], sql['tz_offset'])})"
    names = list(dict.fromkeys([*needed, *wanted]))
    long_enough = f"length({line}) > {P.MIN_LINE_LENGTH}"
    each = [f"if({long_enough}, {sql[f]}, NULL) AS {f}" if all_lines else f"{sql[f]} AS {f}" for f in names]
    parsed = fence((df if all_lines else filter_min_length(df, line)).selectExpr(*kept, *each))
    return parsed.dropna(subset=list(needed)) if needed else parsed


def report_rows(df: DataFrame, *fields: str, line: str = "line", keep=()) -> DataFrame:
    """Lines that have all of ``fields``, each parsed by its own rule; nothing else is parsed.

    A line longer than the minimum counts in a report as soon as it has what the report names,
    whatever is wrong with its other fields. ``epoch_ms`` stands for a usable time.
    """
    return report_fields(df, list(fields), (), line, keep)


def hourly_rows(df: DataFrame, *fields: str, line: str = "line", keep=()) -> DataFrame:
    """``report_rows`` with the hour, of lines with more than the least number of tokens."""
    rows = report_rows(df, "hour", "tokens", *fields, line=line, keep=keep)
    return rows.where(F.col("tokens") > P.MIN_LINE_TOKENS).drop("tokens")


def split_parse(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """All fields plus ``reject`` (NULL when the line is a record of the log table), fenced."""
    kept = _keep(df, keep)
    fields = P.split_fields_sql(line)
    parsed = fence(df.selectExpr(*kept, line, *[f"{sql} AS {name}" for name, sql in fields.items()]))
    timed = parsed.selectExpr("*", f"{P.event_time_sql()} AS _event_time")
    return timed.selectExpr(*kept, line, *ACCESS_COLUMNS, "tz_offset", "hour", "_event_time",
                            f"{P.reject_sql(line, '_event_time')} AS reject")


def access_table(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """Records of the log table: the ten access columns + tz_offset, event_time, epoch_ms and hour."""
    kept = _keep(df, keep)
    parsed = fence(split_parse(df, line, keep)).filter("reject IS NULL")
    return parsed.selectExpr(*kept, line, *ACCESS_COLUMNS, "tz_offset",
                             "_event_time AS event_time", "unix_millis(_event_time) AS epoch_ms", "hour")


def quarantine(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """Rejected lines with the first rule they break."""
    parsed = fence(split_parse(df, line, keep))
    return parsed.filter("reject IS NOT NULL").selectExpr(*_keep(df, keep), line, "reject AS reason")


def strict_parse(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """Strict-regex records (no-match lines dropped, as the offline jobs do)."""
    kept = _keep(df, keep)
    base = fence(df.selectExpr(*kept, line, f"{P.strict_packed_sql(line)} AS _packed"))
    fields = P.strict_fields_sql("_packed")
    return (base.filter(f"_packed <> {line}")
            .selectExpr(*kept, line, *[f"{sql} AS {name}" for name, sql in fields.items()]))


def strict_parse_normalised(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    out = strict_parse(df, line, keep)
    return out.withColumn("user_agent_norm", P.normalised_agent("user_agent"))
