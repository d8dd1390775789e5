"""Feature engineering: per-IP behaviour counts, frequency indexing, scaling.

``frequency_index`` is the distributed form of a frequency-ordered
StringIndexer (index 0 = most frequent, ties alphabetical). StringIndexer keeps
every label on the driver; here the label table stays distributed:

1. (column, value) counts — partial aggregate;
2. range-partition + sort by (column, count desc, value) — a total order;
3. per-partition row counts (one row per partition), prefix-summed into
   offsets — bounded by the partition count, so broadcasting it is safe;
4. index = offset of the partition + position inside it, minus the first
   index of the column.

The sorted table is written to the shared folder, partition ids and positions
included, before it is consumed twice (a recomputed range partitioner could
draw different bounds).
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.functions.plan import written


def ip_features(requests: DataFrame, ip: str = "ip") -> DataFrame:
    """Distinct urls, methods and agents per IP — one aggregate (Expand x3)."""
    return requests.groupBy(ip).agg(
        F.countDistinct("url").alias("distinct_urls"),
        F.countDistinct("request_method").alias("distinct_methods"),
        F.countDistinct("user_agent").alias("distinct_user_agents"))


def global_index(df: DataFrame, order: list, name: str = "gidx") -> DataFrame:
    """Dense 0-based position of every row in ``order`` (which must be a total order)."""
    tagged = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_pid", F.spark_partition_id())
                     .withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_offset"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + local)
            .drop("_pid", "_mid", "_offset"))


def frequency_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, hits, freq_index) for every distinct value of every column."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("hits"))
    order = [F.col("column").asc(), F.col("hits").desc(), F.col("value").asc_nulls_first()]
    ranked = global_index(counts, order)
    base = ranked.groupBy("column").agg(F.min("gidx").alias("_base"))
    return (ranked.join(F.broadcast(base), "column")
            .select("column", "value", "hits", (F.col("gidx") - F.col("_base")).alias("freq_index")))


HEAVY = 1000    # a value with more than 1 / HEAVY of all rows is heavy: at most HEAVY values of a column are


def apply_index(df: DataFrame, index: DataFrame, columns: list[str], suffix: str = "_index") -> DataFrame:
    """Attach ``<col>_index`` (DOUBLE, as ML expects) for each indexed column.

    The few heavy values of a column, by the counts that the index has already, are joined from
    a broadcast of at most ``HEAVY`` rows; all others by a plain equi-join, whose largest key
    then holds no more than 1 / ``HEAVY`` of the rows. Rows that are done get a key that matches
    nothing, spread by their hash.
    """
    totals = index.groupBy("column").agg(F.sum("hits").alias("_all"))                 # one row per column
    tagged = index.join(F.broadcast(totals), "column").withColumn("_heavy", F.col("hits") * HEAVY > F.col("_all"))
    tagged = written(tagged.select("column", "value", F.col("freq_index").cast("double").alias("freq_index"), "_heavy"), "index")
    out = df
    for c in columns:
        own = tagged.where(F.col("column") == c)
        heavy = own.where("_heavy").select(F.col("value").alias("_hv"), F.col("freq_index").alias("_hi"))
        light = own.where("NOT _heavy").select(F.col("value").alias("_lv"), F.col("freq_index").alias("_li"))
        out = out.join(F.broadcast(heavy), out[c].cast("string") == F.col("_hv"), "left")
        apart = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16)).cast("string"))
        out = out.withColumn("_key", F.when(F.col("_hv").isNull() & F.col(c).isNotNull(), F.col(c).cast("string")).otherwise(apart))
        out = out.join(light, F.col("_key") == F.col("_lv"), "left") \
                 .withColumn(c + suffix, F.coalesce("_hi", "_li")).drop("_hv", "_hi", "_lv", "_li", "_key")
    return out


def assemble(df: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep").transform(df)


def standardise(df: DataFrame, input_col: str = "features", output: str = "scaledFeatures"):
    """Unit sample standard deviation, no centring (constant column -> 0)."""
    model = StandardScaler(inputCol=input_col, outputCol=output, withMean=False,
                           withStd=True).fit(df)
    return model.transform(df)


def vector_columns(df: DataFrame, vec: str, names: list[str], digits: int | None = 6) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    cols = []
    for i, n in enumerate(names):
        v = arr[i]
        cols.append((F.round(v, digits) if digits is not None else v).alias(n))
    return df.select(*[c for c in df.columns if c != vec], *cols)
