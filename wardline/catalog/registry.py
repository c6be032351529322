"""Named queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from wardline.sources.standins import standin_tables
from wardline.sources.tables import Tables

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def _add(name: str, run: Run, sql: str | None) -> None:
    if name in ENTRIES:
        raise ValueError(f"query {name} is registered twice")
    ENTRIES[name] = Entry(run, dedent(sql).strip() if sql else None)


class Source:
    """The parquet tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query over the given tables: ``fn(source) -> DataFrame``."""

    def register(fn: Callable[[Source], DataFrame]):
        _add(name, lambda spark, sf_dir: fn(Source(spark, sf_dir)), sql)
        return fn

    return register


def report(name: str, sql: str | None = None):
    """Register a query over the derived base tables: ``fn(tables) -> DataFrame``."""

    def register(fn: Callable[[Tables], DataFrame]):
        _add(name, lambda spark, sf_dir: fn(standin_tables(spark, sf_dir)), sql)
        return fn

    return register
