"""Base tables stored so that the pivots need no shuffle.

Observations and encounters are bucketed and sorted by `encounter_id`: every step that groups or
joins them by encounter finds its rows in place. The other tables are stored as they are.
Read them back with `tables.from_catalog`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from wardline.sources.schemas import SCHEMAS
from wardline.sources.tables import Tables

BUCKETED = {"obs": "encounter_id", "encounter": "encounter_id", "payment": "charges_id", "charges": "charges_id"}


def write_bucketed(
    spark: SparkSession,
    tables: Tables,
    database: str,
    buckets: int,
    keys: Mapping[str, str] = BUCKETED,
    only: tuple[str, ...] = tuple(SCHEMAS),
) -> None:
    """Store the tables in a database of the session catalog; existing ones are replaced.

    Take about as many buckets as `obs` has times 200 MB. Rows are dealt to their bucket
    before they are written, so that a bucket is one file and not one per task. A key with
    very many rows makes a large bucket; Spark still reads it in parallel where the plan needs no order.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in only:
        df = getattr(tables, name)
        if name in keys:
            key = keys[name]
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        writer.format("parquet").mode("overwrite").saveAsTable(f"{database}.{name}")
