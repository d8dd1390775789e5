"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.session import drop_scratch, scratch_dir

_shipped: set[str] = set()
_kept: dict[str, list[str]] = {}          # application -> folders that keep_folder named


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_digest(text: str = "text") -> Column:
    """Tells the texts of rows with one id apart."""
    return F.xxhash64(whole_text(text))


def without_rows(docs: DataFrame, doc_id: str, text: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not in ``gone``, a table of (id, ``text_digest``).

    Rows go by id and text together: another text under the same id, or under no id, stays.
    """
    name, digest = fresh(docs, "_gone"), fresh(docs, "_gone_text")
    named = docs[doc_id].cast("long").eqNullSafe(F.col(name))
    return docs.join(gone.toDF(name, digest).distinct(), named & (text_digest(text) == F.col(digest)), "left_anti")


def keep_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder under the shared one, which ``release`` can delete."""
    folder = scratch_dir(spark, label)
    _kept.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def keep_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and reread it: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = keep_folder(spark, label)
    df.write.option("compression", "zstd").parquet(f"{folder}/table")
    return spark.read.schema(df.schema).parquet(f"{folder}/table")


def kept_tables(spark: SparkSession) -> list[str]:
    """Folders that ``keep_folder`` named and ``release`` has not deleted, oldest first."""
    return list(_kept.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, folders: list[str]) -> None:
    """Delete kept tables that no DataFrame in use reads any more."""
    for folder in folders:
        drop_scratch(spark, folder)
        _kept[spark.sparkContext.applicationId].remove(folder)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application (as --py-files would)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, out = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    path = f"{scratch_dir(spark, 'code')}/{root.name}.zip"
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at)
    stream.write(bytearray(out.getvalue()))
    stream.close()
    sc.addPyFile(path if "://" in path or path.startswith("file:") else f"file://{path}")
    _shipped.add(sc.applicationId)


BATCH_BYTES = 8 << 20


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` by a function of this package, in batches of at most ``BATCH_BYTES``.

    The session's bound on Arrow batches is lowered to that, never raised: rows here are whole
    texts and sets, and a batch is held by the JVM and by Python at once.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    ship_package(spark)
    return df.mapInArrow(function, schema)
