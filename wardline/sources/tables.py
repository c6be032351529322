"""The base tables, loaded on first use from parquet, a catalog or a database."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources.schemas import SCHEMAS


class Tables:
    """Attribute access to the base tables: ``tables.obs``, ``tables.encounter``, ...

    A table is loaded when it is first asked for, so a report pays only for the
    tables it reads.
    """

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._loaded: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(f"no base table named {name!r}")
        if name not in self._loaded:
            self._loaded[name] = self._load(name)
        return self._loaded[name]


def from_frames(frames: Mapping[str, DataFrame]) -> Tables:
    """Tables held as DataFrames already, under their base-table names."""
    return Tables(frames.__getitem__)


def replaced(tables: Tables, **frames: DataFrame) -> Tables:
    """The same tables, but some: the new files of a table, say, in place of all."""
    return Tables(lambda name: frames[name] if name in frames else getattr(tables, name))


def without_deleted(tables: Tables) -> Tables:
    """The same tables without soft-deleted rows.

    The reports leave deleted rows out of some tables and not of others; over
    these tables they leave them out everywhere.
    """

    def load(name: str) -> DataFrame:
        df = getattr(tables, name)
        return df.filter(F.col("voided") == 0) if "voided" in SCHEMAS[name].names else df

    return Tables(load)


def ignoring_case(tables: Tables, collation: str = "UTF8_LCASE") -> Tables:
    """The same tables with text that compares without case, as the reports' database does.

    Every text column gets the collation as its type, so filters, joins, groups and orders over these
    tables all follow it, those of the caller too. Joins hash a text by its collation key. Filters on
    numbers and dates still reach the scan; those on text are applied above it. Where spellings are
    equal but for case a report shows one of them; see `plain_text` for its result.
    """
    return Tables(lambda name: _collated(getattr(tables, name), collation))


def plain_text(df: DataFrame) -> DataFrame:
    """Text columns as binary strings again: for a result that others compare byte by byte."""
    return df.select(
        *(
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _collated(df: DataFrame, collation: str) -> DataFrame:
    return df.select(
        *(
            F.collate(f.name, collation).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _typed(df: DataFrame, name: str) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields))


def from_parquet(spark: SparkSession, root: str, names: Mapping[str, str] | None = None) -> Tables:
    """One parquet folder per table under ``root``.

    ``names`` maps a base-table name to the folder that holds it, where they
    differ. The fixed schema spares the footer scan and keeps the scan narrow.
    """
    folders = dict(names or {})

    def load(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{folders.get(name, name)}")

    return Tables(load)


def from_catalog(
    spark: SparkSession, database: str | None = None, names: Mapping[str, str] | None = None
) -> Tables:
    """Tables of the session catalog, cast to the fixed schema."""
    aliases = dict(names or {})
    prefix = f"{database}." if database else ""

    def load(name: str) -> DataFrame:
        return _typed(spark.table(prefix + aliases.get(name, name)), name)

    return Tables(load)


# The integer key each large table is read by, in ranges.
_RANGE_KEY = {
    "encounter": "encounter_id",
    "obs": "obs_id",
    "visit": "visit_id",
    "person": "person_id",
    "person_name": "person_id",
    "patient_identifier": "patient_id",
    "charges": "charges_id",
    "payment": "charges_id",
}


def from_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    key_ranges: Mapping[str, tuple[int, int]],
    partitions: int = 200,
    names: Mapping[str, str] | None = None,
) -> Tables:
    """Tables of a relational database.

    ``options`` goes to the reader as it is (url, driver, user, fetchsize, ...).
    ``key_ranges`` gives the lowest and highest key of every large table, so
    that it is read by ``partitions`` range scans and not through one
    connection; a large table without a range is refused.
    """
    aliases = dict(names or {})

    def load(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(**options)
        reader = reader.option("dbtable", aliases.get(name, name))
        if name in _RANGE_KEY:
            if name not in key_ranges:
                raise ValueError(f"{name} needs a key range to be read in parallel")
            low, high = key_ranges[name]
            reader = (
                reader.option("partitionColumn", _RANGE_KEY[name])
                .option("lowerBound", low)
                .option("upperBound", high)
                .option("numPartitions", partitions)
            )
        return _typed(reader.load(), name)

    return Tables(load)
