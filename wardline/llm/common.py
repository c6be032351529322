"""Scratch tables, input projection and small numeric helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Texts and shards are wide rows, so batches are kept short.
BATCH_ROWS = 128

#: Where this library lies; Python workers of a local session look there, a cluster gets --py-files.
LIBRARY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A table of one narrow row per task or per block of the input is broadcast up to this many rows.
SMALL_ROWS = 100_000

#: Spark's setting to remove the shuffle files of a query when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package: short Arrow batches, skew handling of joins."""
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    spark.sparkContext.environment.setdefault("PYTHONPATH", LIBRARY)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor and the driver see: ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session must have it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """Tables of one run in the shared folder. Writing one cuts the lineage, so it survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = prepare(spark)
        self.path = f"{shared_folder(spark)}/wardline-{name}-{uuid.uuid4().hex[:12]}"

    def table(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write ``df`` as Parquet and read it back; shuffle files of the write are removed with its end."""
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.options(**{"compression": "zstd"} | options).parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Remove the whole folder, once what was computed from it has been written."""
        self.drop("")

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` long and ``body`` binary (UTF-8; null: empty); all other columns are left behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a broadcast side if ``rows``, its counted size, is small; else as it is."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def offsets(totals: DataFrame, key: str, amount: str) -> DataFrame:
    """Exclusive prefix sums of ``amount`` in the order of ``key``, as column ``base``.

    ``totals`` has one narrow row per task of the pass before, so one sorted window over it is small.
    """
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("long").alias("base"))


def words_pattern() -> str:
    """White space that separates words: blank, tab, line feed, vertical tab, form feed, return."""
    return r"[\x20\x09-\x0D]+"


def any_of(columns: list[Column]) -> Column:
    out = F.lit(False)
    for column in columns:
        out = out | column
    return out
