"""Results stay right where one key holds a third of the rows."""

import oracle
import pytest
import skew

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()

# By the order the hot lines belong to: an admission, or a neuro visit.
BY_PRIORITY = {
    "2-HIGH": [
        "derived_table",
        "open_items_census",
        "any_none_of",
        "join_inner",
        "join_inner_composite",
        "join_left_residual",
        "join_interval_inner",
        "join_interval_left",
        "join_star_chain",
        "agg_count_col",
        "agg_eav_pivot",
        "agg_payment_pivot",
        "agg_concat_ordered",
        "agg_concat_distinct",
        "agg_list_ends",
        "agg_pick_first",
        "report_daily_list_ranked_every_day",
        "report_financial",
        "report_financial_slots",
        "diagnosis_ranks",
        "diagnosis_slots",
        "report_bookings",
        "report_notes",
        "report_daily_list_linked_every_day",
        "report_daily_list_slots_every_day",
        "report_open_stays",
        "report_payment_summary",
        "report_charges_admission",
    ],
    "1-URGENT": [
        "cohort_family_a",
        "stat_a_seen",
        "stat_a_new",
        "stat_b_seen",
        "stat_b_new",
        "stat_a_followup",
    ],
    "5-LOW": ["report_operative_every_day", "stat_shunt_total", "cohort_a_operations"],
}


@pytest.fixture(scope="module", params=sorted(BY_PRIORITY))
def hot(request, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skewed"))
    return request.param, skew.write_skewed(sf_dir, out, request.param)


def test_hot_key(spark, hot):
    priority, folder = hot
    con = oracle.connect(folder)
    for name in BY_PRIORITY[priority]:
        count, difference = oracle.compare(QUERIES[name](spark, folder), con, SQL[name])
        assert difference is None, name
        assert count > 0, name
