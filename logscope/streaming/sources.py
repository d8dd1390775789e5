"""Streaming sources: Kafka and tailed log files, in one shape.

``source STRING, offset BIGINT, value STRING``: source and offset name a record for good. For
Kafka they are topic/partition and the offset in it; for a file its path, and the offset is
filled in by ``with_positions`` where a job needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "source STRING, offset BIGINT, value STRING"
PART = 1000          # equal lines that are numbered together


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a Kafka subscription: string payloads, earliest offsets, commits via checkpoint."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets.strip(),
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_shape(raw: DataFrame) -> DataFrame:
    """Columns of the Kafka source -> records."""
    return raw.select(F.concat_ws("/", "topic", F.col("partition").cast("string")).alias("source"), "offset",
                      F.col("value").cast("string").alias("value"))


def kafka_records(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """Kafka topic -> records. Needs the spark-sql-kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(bootstrap_servers, topic, **kw).items():
        reader = reader.option(k, v)
    return kafka_shape(reader.load())


def text_records(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Tail a directory of plain log files (one line per row)."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select(F.col("_metadata.file_path").alias("source"), F.lit(None).cast("bigint").alias("offset"), "value")


def with_positions(batch: DataFrame) -> DataFrame:
    """Fills in missing offsets: the how-manieth of its equal lines in its file a line is.

    For a batch, not a stream: a file is read in one micro-batch, so the numbers repeat in a
    replay. Equal lines of a file are interchangeable, so they are counted, in each task first, and the counts are
    written out again as numbers, in parts that are dealt over the tasks: a line that a file repeats a million times
    comes together nowhere.
    """
    alike = [c for c in batch.columns if c != "offset"]
    known, missing = batch.where("offset IS NOT NULL"), batch.where("offset IS NULL")
    counts = missing.groupBy(*alike).agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(PART).cast("bigint"))).alias("_first"))
    last = F.least(F.col("_first") + PART - 1, F.col("_n"))
    numbered = parts.hint("rebalance").select(*alike, F.explode(F.sequence("_first", last)).alias("offset"))
    return known.unionByName(numbered.select(*batch.columns))
