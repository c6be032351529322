"""Bucketed tables spare shuffles; run-time filters drop rows before one."""

import datetime as dt
import re

import pytest
from clinic import Clinic
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.operators.aggregates import eav_pivot
from wardline.operators.joins import within
from wardline.plans import financial, parts
from wardline.sources.layout import write_bucketed
from wardline.sources.standins import standin_tables
from wardline.sources.tables import from_catalog

WANTED = ("obs", "encounter", "concept_name", "person_name")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    write_bucketed(spark, t, "bucketed", 8, only=WANTED)
    yield from_catalog(spark, "bucketed")
    spark.sql("DROP DATABASE bucketed CASCADE")


def _pivot(t):
    return eav_pivot(
        t.obs, ["encounter_id"], {"asked": (codes.APPOINTMENT_DATE, "value_datetime"), "noted": (codes.NOTES, "value_text")}
    )


def _above_obs(text: str) -> str:
    """The operators between the scan of observations and the root, innermost last."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and ".obs[" in line)
    depth = lambda line: len(re.match(r"[\s:+*|()0-9-]*", line).group())
    out, limit = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < limit:
            out.append(line)
            limit = depth(line)
    return "\n".join(out)


def test_pivot_and_bookings_do_not_shuffle_observations(spark, stored):
    pivot = plan(_pivot(stored))
    assert "Bucketed: true" in pivot and "Exchange" not in pivot
    above = _above_obs(plan(parts.bookings(stored)))
    assert above.count("Aggregate") == 2 and "Exchange" not in above


def test_stored_tables_give_the_same_rows(spark, sf_dir, stored):
    t = standin_tables(spark, sf_dir)
    assert rows(_pivot(stored)) == rows(_pivot(t))
    assert rows(parts.bookings(stored)) == rows(parts.bookings(t)) and parts.bookings(t).count() > 0


def test_a_stored_table_is_replaced(spark, tmp_path):
    c = Clinic(spark)
    c.patient(1)
    c.booking(10, 1, "2024-01-05 00:00")
    for _ in range(2):
        write_bucketed(spark, c.tables(), "twice", 2, only=("obs", "encounter"))
    assert from_catalog(spark, "twice").encounter.count() == 1
    spark.sql("DROP DATABASE twice CASCADE")


FILTERS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
}


@pytest.fixture
def eager_filters(spark):
    before = {k: spark.conf.get(k, None) for k in FILTERS}
    for k, v in FILTERS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_time_filters_on_observations_and_payments(eager_filters, tmp_path):
    spark = eager_filters
    # Stored tables of their own, so that either side is a plain scan.
    lines = spark.range(20_000).select(F.col("id").alias("encounter_id"), (F.col("id") % 7).cast("int").alias("concept_id"), "id")
    lines.write.parquet(f"{tmp_path}/obs")
    spark.range(20_000).select(F.col("id").alias("encounter_id"), (F.col("id") % 1000).alias("kind")).write.parquet(f"{tmp_path}/encounter")
    obs, asked = spark.read.parquet(f"{tmp_path}/obs"), spark.read.parquet(f"{tmp_path}/encounter").filter("kind = 3")
    restricted = within(obs, "encounter_id", asked).groupBy("encounter_id").agg(F.max("concept_id"))
    text = restricted._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" in text and "bloom_filter_agg" in text
    assert restricted.count() == 20


def test_payments_are_restricted_to_the_charges_of_the_period(eager_filters, sf_dir):
    t = standin_tables(eager_filters, sf_dir)
    report = financial.financial_report(t, dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    text = report._jdf.queryExecution().optimizedPlan().toString()
    # The aggregate of payments stands above a join with the charges.
    pivot = text[text.index("Total_Paid") :]
    assert re.search(r"Aggregate \[charges_id#\d+", text) and "Join Inner, (charges_id" in pivot
