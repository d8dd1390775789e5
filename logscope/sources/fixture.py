"""Raw access-log lines and the geo range table, derived from the driver's tables.

``access_log`` turns every ``events`` row into one combined-log-format line
(see FIXTURES.md §3), so all log operators run over data that grows with the
input. It is a narrow projection: no shuffle, and only the five columns it
needs are read from parquet.

The timestamp text is assembled from field extractors on the TIMESTAMP_NTZ
column (day, month, hour, ...), which never consult the session time zone.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions.plan import fence
from logscope.sources.tables import read_table

# English month abbreviations used by the log time format.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                       "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# User agents of the fixture, by user_id % 5 (4 = "-").
FIXTURE_AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1) Chrome/66.0.3359.117 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 6.0) Chrome/71.0.3578.99 Mobile",
    "Mozilla/5.0 (compatible; bingbot/2.0)",
    "AhrefsBot/6.1",
    "-",
]

# Province names of the geo fixture, one per nation key 0..24.
# The first eleven are the short names that need canonicalising; 23 is empty
# and 24 is null on purpose (drop rules of the geographic report).
GEO_PROVINCES = [
    "新疆", "广西", "宁夏", "内蒙古", "西藏", "北京", "天津", "重庆", "上海", "香港", "澳门",
    "广东省", "江苏省", "浙江省", "山东省", "河南省", "四川省", "湖北省", "湖南省", "福建省",
    "安徽省", "河北省", "陕西省", "", None,
]


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def log_time_sql(ts: str) -> str:
    """``dd/MMM/yyyy:HH:mm:ss`` from a TIMESTAMP_NTZ column, independent of the session zone."""
    two = "lpad(CAST({}({}) AS STRING), 2, '0')"
    return (f"concat({two.format('day', ts)}, '/', element_at(array({_sql_list(MONTH_ABBREVIATIONS)}), "
            f"month({ts})), '/', CAST(year({ts}) AS STRING), ':', {two.format('hour', ts)}, ':', "
            f"{two.format('minute', ts)}, ':', {two.format('second', ts)})")


def line_sql() -> str:
    """Spark SQL text of the fixture line (FIXTURES.md §3), one expression.

    Written as SQL text so the driver builds it with one call instead of
    hundreds of Column round trips; Catalyst sees the same expression tree.
    """
    k = "get_json_object(props, '$.k')"
    return f"""CASE WHEN event_id % 97 = 0 THEN 'bad line'
  WHEN event_id % 101 = 0 THEN '- - broken request without any quotes'
  ELSE concat(
    CASE WHEN user_id % 11 = 3 THEN concat('2001:db8::', lower(hex(user_id)))
         WHEN user_id % 13 = 5 THEN concat('host', CAST(user_id AS STRING), '.example.net') ELSE concat(
    CAST(10 + user_id % 25 AS STRING), '.', CAST((user_id * 7) % 256 AS STRING), '.',
    CAST((user_id * 13) % 256 AS STRING), '.', CAST(1 + user_id % 254 AS STRING)) END,
    ' - - [', {log_time_sql('ts')}, ' +0000] "', CASE WHEN event_id % 23 = 0 THEN '-' ELSE concat(
    CASE WHEN event_id % 13 = 0 THEN 'HEAD' WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END, ' ',
    CASE WHEN event_id % 29 = 0 THEN '/search?q=two words ' ELSE '' END,
    CASE event_type WHEN 'purchase' THEN concat('/cart?item=', {k}) WHEN 'signup' THEN '/signup'
         WHEN 'error' THEN concat('/filter/27|', {k}) ELSE concat('/product/', {k}) END, ' ',
    CASE WHEN event_id % 10 = 0 THEN 'HTTP/1.0' WHEN event_id % 7 = 0 THEN 'HTTP/2.0' ELSE 'HTTP/1.1' END) END, '" ',
    CASE WHEN event_id % 23 = 0 THEN '408' WHEN event_id % 19 = 0 THEN '304' WHEN event_type = 'error' AND event_id % 2 = 0 THEN '500' WHEN event_type = 'error' THEN '404'
         WHEN event_id % 17 = 0 THEN '302' ELSE '200' END, ' ',
    CASE WHEN event_id % 19 = 0 THEN '-' WHEN event_id % 31 = 0 THEN '3000000000' ELSE CAST((event_id * 37) % 50000 AS STRING) END,
    CASE WHEN event_id % 37 = 0 THEN '' ELSE concat(' "', CASE WHEN event_id % 3 = 0 THEN '-' ELSE concat('https://www.example.com/ref/', CAST(user_id % 12 AS STRING)) END,
    '" "', element_at(array({_sql_list(FIXTURE_AGENTS)}), CAST(user_id % 5 + 1 AS INT)), '"',
    CASE WHEN event_id % 2 = 0 THEN ' "-"' ELSE '' END) END)
END"""


def access_log(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, user_id, line); the line is built once per row (fence)."""
    return fence(events.select("event_id", "ts", "user_id", F.expr(line_sql()).alias("line")))


def read_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    return access_log(events)


def geo_ranges(nation: DataFrame) -> DataFrame:
    """One /8 block per nation key: (lo, hi, pro, city). Bounded by the nation table."""
    spark = nation.sparkSession
    names = spark.createDataFrame(list(enumerate(GEO_PROVINCES)), "k INT, pro STRING")
    block = F.lit(16777216).cast("bigint")
    k = F.col("n_nationkey").cast("bigint")
    return (nation.select("n_nationkey").join(names, F.col("n_nationkey") == F.col("k"))
            .select(((k + 10) * block).alias("lo"), ((k + 11) * block - 1).alias("hi"),
                    "pro", F.concat(F.lit("city_"), k.cast("string")).alias("city")))


def read_geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_ranges(read_table(spark, sf_dir, "nation", "n_nationkey"))


def geo_blocks(nation: DataFrame) -> DataFrame:
    """Nested ranges of both address families as texts (lo, hi, pro, city): per nation a /8 block, its lower half, a
    piece inside that with odd ends, and twelve IPv6 addresses inside one /32 block."""
    spark = nation.sparkSession
    names = spark.createDataFrame(list(enumerate(GEO_PROVINCES)), "k INT, pro STRING")
    each = nation.select("n_nationkey").join(names, F.col("n_nationkey") == F.col("k"))
    rows = each.selectExpr("""inline(array(
        named_struct('lo', concat(10 + k, '.0.0.0'), 'hi', concat(10 + k, '.255.255.255'), 'pro', pro, 'city', concat('city_', k)),
        named_struct('lo', concat(10 + k, '.0.0.0'), 'hi', concat(10 + k, '.127.255.255'), 'pro', pro, 'city', concat('half_', k)),
        named_struct('lo', concat(10 + k, '.64.10.5'), 'hi', concat(10 + k, '.100.200.17'), 'pro', pro, 'city', concat('odd_', k)),
        named_struct('lo', concat('2001:db8::', lower(hex(16 * k))), 'hi', concat('2001:DB8:0::', hex(16 * k + 11)), 'pro', pro,
                     'city', concat('six_', k))))""")
    return rows.unionByName(spark.createDataFrame([("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "文档", "six")], rows.schema))


def read_geo_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_blocks(read_table(spark, sf_dir, "nation", "n_nationkey"))


# ------------------------------------------------------------- replay of the log as a stream

REPLAY_FILES = 5
LATE_EVERY, LATE_REST = 50, 7        # one record in so many comes with the last file only
SLICE_RECORDS = 50_000               # about so many records lie in one file; larger tables have several for each range


def replay_span(offsets: DataFrame) -> tuple[int, int, int]:
    """The least and the greatest offset, and how many rows there are."""
    return tuple(offsets.agg(F.min("offset"), F.max("offset"), F.count(F.lit(1))).first())


def replay_slices(span: tuple[int, int, int]) -> int:
    """How many files each range of a replay is dealt over."""
    return max(1, -(-span[2] // (REPLAY_FILES * SLICE_RECORDS)))


def write_replay(records: DataFrame, path: str, redeliver: bool = False, disorder: bool = False,
                 span: tuple[int, int, int] | None = None) -> int:
    """Write (source, offset, value) as ``REPLAY_FILES`` equal offset ranges, each in ``replay_slices`` files; returns the number of files.

    The file source takes files by modification time, which is set in the ranges' order, so with so many files per
    trigger range i is micro-batch i. ``span`` is that of the records, if it is known already. ``redeliver`` delivers every record again with the next range (at least
    once); ``disorder`` delivers some records of all ranges with the last range, far too late.
    """
    span = span or replay_span(records)
    (lo, hi, _), slices = span, replay_slices(span)
    width = max(1, -(-(hi - lo + 1) // REPLAY_FILES))
    file = F.floor((F.col("offset") - lo) / width).cast("int")
    if disorder:
        file = F.when(F.col("offset") % LATE_EVERY == LATE_REST, REPLAY_FILES - 1).otherwise(file)
    rows = records.select("source", "offset", "value", file.alias("file"))
    if redeliver:
        rows = rows.unionByName(rows.withColumn("file", F.least(F.col("file") + 1, F.lit(REPLAY_FILES - 1))))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("offset", "value"), F.lit(slices)))
    rows.repartition(REPLAY_FILES * slices, "file", "slice").write.partitionBy("file", "slice").parquet(path)
    return _stamp_in_order(records.sparkSession, path, slices)


def _stamp_in_order(spark: SparkSession, path: str, slices: int = 1) -> int:
    """Sets the files' times in the ranges' order; a range with fewer than ``slices`` files gets empty ones."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(f"{path}/file=*/{{part-*,slice=*/part-*}}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = files.getFileSystem(conf)
    ranges: dict[str, list] = {}
    for st in fs.globStatus(files):
        name = st.getPath().toString()
        ranges.setdefault(name[:name.index("/", name.rindex("/file=") + 1)], []).append(st.getPath())
    if any(len(found) < slices for found in ranges.values()):
        blank = f"{path}-blank"
        spark.createDataFrame([], "source STRING, offset BIGINT, value STRING").write.mode("overwrite").parquet(blank)
        one = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{blank}/part-*"))[0].getPath()
        for name, found in ranges.items():
            for i in range(len(found), slices):
                found.append(jvm.org.apache.hadoop.fs.Path(f"{name}/slice=blank/part-{i}.parquet"))
                jvm.org.apache.hadoop.fs.FileUtil.copy(fs, one, fs, found[-1], False, conf)
    now = int(time.time() * 1000)
    for i, name in enumerate(sorted(ranges)):
        for found in ranges[name]:
            fs.setTimes(found, now + i * 1000, -1)
    return sum(len(found) for found in ranges.values())


def replay_records(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema("source STRING, offset BIGINT, value STRING")
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).parquet(path))
