"""Relations that hold on any data, tried on the test tables."""

from functools import reduce

from pyspark.sql import functions as F

import __spark_entry__ as contract
from wardline.functions import codes
from wardline.functions import columns as C
from wardline.operators.aggregates import ordered_concat
from wardline.operators.lists import list_ends
from wardline.plans import cohorts, parts
from wardline.sources.standins import standin_tables

QUERIES = contract.queries()


def test_total_paid_is_at_least_every_mode(spark, sf_dir):
    paid = parts.payment_totals(standin_tables(spark, sf_dir))
    broken = reduce(
        lambda a, b: a | b, (F.col("Total_Paid") < F.col(f"`{m}`") for m in codes.PAYMENT_MODES)
    )
    assert paid.filter(broken).count() == 0
    assert paid.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey"
    ).distinct().count()


def test_left_interval_join_keeps_every_left_row(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    purchases = events.filter(F.col("event_type") == "purchase").count()
    joined = QUERIES["join_interval_left"](spark, sf_dir)
    assert joined.select("purchase_id").distinct().count() == purchases
    matched = QUERIES["join_interval_inner"](spark, sf_dir).count()
    unmatched = joined.filter(F.col("click_id").isNull()).count()
    assert joined.count() == matched + unmatched


def test_half_years_add_up(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    for family in (codes.HYDROCEPHALUS, codes.SPINA_BIFIDA):
        for row in cohorts.visit_statistic(t, family).collect():
            assert row["jan_jun"] + row["jul_dec"] == row["total"]
            assert 0 in (row["jan_jun"], row["jul_dec"])


def test_a_narrower_family_counts_no_more(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    as_of = contract.basics.AS_OF
    totals = [
        cohorts.operation_statistic(t, family, as_of, combine="sum").first()["total"]
        for family in (codes.HYDROCEPHALUS_OPERATIONS, codes.SHUNT_TOTAL, codes.SHUNT_REVISIONS)
    ]
    assert totals == sorted(totals, reverse=True) and totals[-1] > 0


def test_visit_types_split_the_visits(spark, sf_dir):
    t = standin_tables(spark, sf_dir)

    def total(**choice):
        found = cohorts.visit_statistic(
            t, codes.HYDROCEPHALUS, wrap=True, combine="sum", **choice
        )
        return found.first()["total"]

    labels = [*codes.VISIT_TYPE_LABELS.values(), codes.VISIT_TYPE_DEFAULT]
    assert sum(total(visit_type=label) for label in labels) == total()


def test_ends_agree_with_the_tokens_of_the_whole_text(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_linenumber", "l_partkey"]
    text = ordered_concat(
        lines, ["l_orderkey"], "l_partkey", order, F.col("l_linenumber"), "text", "|"
    )
    tokens = text.select(
        "l_orderkey",
        C.nth_token("text", "|", 1).alias("t1"),
        C.nth_token("text", "|", 2).alias("t2"),
        F.when(C.token_count("text", "|") >= 2, F.substring_index("text", "|", -1))
        .otherwise("")
        .alias("t3"),
    )
    ends = list_ends(lines, ["l_orderkey"], "l_partkey", order).select(
        "l_orderkey",
        *(
            F.coalesce(F.col(end).cast("string"), F.lit("")).alias(f"t{i}")
            for i, end in enumerate(("first", "second", "last"), 1)
        ),
    )
    assert ends.exceptAll(tokens).count() == 0 and tokens.exceptAll(ends).count() == 0
