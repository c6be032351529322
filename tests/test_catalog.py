"""Every registered query against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from wardline.catalog.registry import ENTRIES

QUERIES = {name: run for name, run in contract.queries().items() if name in ENTRIES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in ENTRIES}

# These ask for one patient or day that the smallest tables need not hold.
MAY_BE_EMPTY = {
    "report_daily_list_ranked",
    "report_daily_list_linked",
    "report_daily_list_slots",
    "filter_on_day",
    "report_operative_by_patient",
    "report_operative_by_number",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    count, difference = oracle.compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert difference is None
    assert count > 0 or name in MAY_BE_EMPTY


def test_entry_has_rows(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test data")
    assert contract.entry(spark).count() > 0
