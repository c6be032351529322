"""The plans hold what the design promises."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from wardline.catalog.registry import ENTRIES
from wardline.operators.joins import PIECE_ROWS, WIDE, interval_join, left_join_many, maybe_within
from wardline.operators.lists import list_ends
from wardline.plans import cohorts, financial, parts
from wardline.functions import codes
from wardline.sources.standins import standin_tables
from wardline.sources.tables import from_frames

QUERIES = {name: run for name, run in contract.queries().items() if name in ENTRIES}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when every side is too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_global_sort(no_broadcast, sf_dir, name):
    text = plan(QUERIES[name](no_broadcast, sf_dir))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "rangepartitioning"):
        assert unwanted not in text
    # Only global aggregates come together in one partition, and the months of a census.
    if name not in {"agg_global", "agg_default_zero", "agg_smallest_quarter"} and not name.startswith("census_"):
        assert "SinglePartition" not in text or name.startswith("stat_")


def _pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan(df)))


def test_filters_reach_the_scan(spark, sf_dir):
    assert "EqualTo(o_orderstatus,O)" in _pushed(QUERIES["filter_eq"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in _pushed(QUERIES["filter_on_day"](spark, sf_dir))
    assert "LessThan(o_orderdate" in _pushed(QUERIES["open_items_census"](spark, sf_dir))
    assert "In(p_size" in _pushed(QUERIES["filter_in_list"](spark, sf_dir))


def test_date_bounds_of_a_report_reach_the_charge_scan(spark, sf_dir):
    pushed = _pushed(QUERIES["report_financial"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed


def test_day_of_a_list_reaches_the_encounter_scan(spark, sf_dir):
    pushed = _pushed(QUERIES["report_daily_list_ranked"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1998-03-02" in pushed


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    text = plan(QUERIES["scan_columns"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_a_concept_filter_drops_the_other_branches(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    for concept, scans in (
        (codes.NOTES, 1),
        (codes.DIAGNOSIS, 1),
        (codes.VISIT_TYPE, 2),
        (codes.OPERATION, 2),
        (codes.PREOPERATIVE_DX, 1),
    ):
        text = plan(t.obs.filter(F.col("concept_id") == concept))
        assert text.count("FileScan") == scans, concept
    # Appointments and operations of orders and lines, encounters, names and surgeons.
    assert plan(parts.bookings(t)).count("FileScan") == 4 + 2 + 1 + 2


def test_list_ends_limits_rows_before_the_shuffle(no_broadcast, sf_dir):
    lines = no_broadcast.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(list_ends(lines, ["l_orderkey"], "l_partkey", ["l_linenumber", "l_partkey"]))
    final, partial = text.index(", Final"), text.index(", Partial")
    assert "Exchange hashpartitioning" in text[final:partial]
    assert "collect_list" not in text
    # One shuffle for each half, none to put them together.
    assert text.count("Exchange hashpartitioning") == 2


def test_reports_gather_no_lists_of_rows(no_broadcast, sf_dir):
    """Only names made distinct first are collected."""
    for name in QUERIES:
        if name.startswith(("report", "stat", "cohort", "diagnosis")):
            text = optimized(QUERIES[name](no_broadcast, sf_dir))
            for line in re.findall(r".*collect_list.*", text):
                assert "_slot" in line, name


def test_shuffles_below_list_ends_are_reused(no_broadcast, sf_dir):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    no_broadcast.conf.set(key, "-1")
    try:
        t = standin_tables(no_broadcast, sf_dir)
        df = parts.diagnosis_ranks(t, t.encounter)
        df.collect()
        assert plan(df).split("Initial Plan")[0].count("ReusedExchange") >= 2
    finally:
        no_broadcast.conf.unset(key)


def test_interval_join_hashes_key_and_time(no_broadcast):
    moved = "timestamp_ntz'2024-01-05' + make_dt_interval(int(id))"
    left = no_broadcast.range(5).selectExpr("id AS a", f"{moved} AS t")
    right = no_broadcast.range(5).selectExpr("id AS b", f"{moved} AS u")
    text = plan(interval_join(left, right, [("a", "b")], "t", "u"))
    join = re.search(r"SortMergeJoin \[([^\]]*)\]", text)
    assert "_bucket" in join.group(1) and "a#" in join.group(1)


def test_payments_are_reduced_before_the_join(no_broadcast, sf_dir):
    text = plan(financial.payment_summary(standin_tables(no_broadcast, sf_dir)))
    assert "partial_sum(amount_paid" in text


def test_left_join_of_unpaid_charges_becomes_inner(no_broadcast, sf_dir):
    text = optimized(QUERIES["join_outer_nullrejected"](no_broadcast, sf_dir))
    assert "LeftOuter" not in text


def test_group_filter_is_pushed_below_the_aggregate(spark, sf_dir):
    assert "GreaterThan(o_custkey,100)" in _pushed(QUERIES["having_group_alias"](spark, sf_dir))


def test_family_is_a_set_lookup(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    listed = cohorts.cohort_listing(
        t, codes.NEURO_TYPE_UUID, codes.DIAGNOSIS, codes.HYDROCEPHALUS_DX
    )
    assert "INSET" in optimized(listed)


def _final(df) -> str:
    """The plan that ran."""
    df.collect()
    return plan(df).split("Initial Plan")[0]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_ends_of_few_rows_read_their_table_once(spark, sf_dir, threshold):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, threshold)
    try:
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        asked = spark.range(50).select(F.col("id").alias("l_orderkey"))
        some = lines.join(asked, "l_orderkey")
        df = list_ends(some, ["l_orderkey"], "l_partkey", ["l_linenumber", "l_partkey"], few=True)
        assert _final(df).count("FileScan parquet") == 1
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_a_hot_right_side_of_a_left_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(200, numPartitions=4).select("id", F.lit("x").alias("a"))
        hot = F.when(F.col("n") % 3 == 0, 7).otherwise(F.col("n") % 150)
        right = spark.range(30_000, numPartitions=6).withColumnRenamed("id", "n")
        right = right.select(hot.cast("bigint").alias("id"), F.col("n").alias("b"))
        df = left_join_many(left, right, ["id"])
        assert "skew=true" in _final(df)
        assert df.filter("b is null").count() == left.join(right, "id", "left_anti").count() > 0
        assert df.count() == left.join(right, "id", "left").count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_a_filter_of_keys_loses_no_row(spark, words):
    rows = spark.range(20_000).selectExpr("if(id % 10 = 0, null, id - 5000) AS k", "id AS v")
    ids = spark.sql("SELECT * FROM VALUES (-4999L), (7L), (7L), (14999L), (CAST(NULL AS BIGINT)) AS v(k)")
    kept = maybe_within(rows, "k", ids, words)
    assert kept.columns == ["k", "v"]
    assert kept.join(ids.distinct(), "k").count() == rows.join(ids.distinct(), "k").count() == 3
    # Three of 64 bits at least drop most rows, and rows are not repeated.
    assert kept.count() < 4000 and kept.count() == kept.distinct().count()
    assert maybe_within(rows, "k", ids.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["by_patient", "by_number", "by_second_number", "any_case"])
def test_observations_of_few_encounters_are_filtered_before_they_are_shuffled(no_broadcast, sf_dir, name):
    text = plan(QUERIES[f"report_operative_{name}"](no_broadcast, sf_dir))
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert "bit_or" in text and joins and all("_word" in line for line in joins)


def test_members_of_groups_are_shuffled_without_the_columns_of_their_admission(no_broadcast, sf_dir):
    text = optimized(QUERIES["report_charges_admission"](no_broadcast, sf_dir))
    groups = [line for line in text.splitlines() if "Aggregate [encounter_id" in line and "obs_group_id" in line]
    assert groups and not any("visit_id" in line or "location_id" in line for line in groups)


@pytest.mark.parametrize("name", ["by_number", "by_second_number", "any_case"])
def test_encounters_and_persons_of_a_number_are_filtered_before_they_are_shuffled(no_broadcast, sf_dir, name):
    lines = plan(QUERIES[f"report_operative_{name}"](no_broadcast, sf_dir)).splitlines()
    depth = [re.search(r"[A-Za-z]|$", line).start() for line in lines]
    # Number of scans whose rows reach a shuffle past no filter of bits.
    whole = seen = 0
    for k, line in enumerate(lines):
        if "FileScan" not in line or not re.search(r"[ol]_orderkey|c_mktsegment", line):
            continue
        seen += 1
        above, filtered = depth[k], False
        for j in range(k - 1, -1, -1):
            if depth[j] < above:
                above = depth[j]
                if " Exchange " in lines[j]:
                    break
                filtered |= "BroadcastHashJoin [_word" in lines[j]
        whole += not filtered
    assert seen > 10 and whole == 0


def _shuffled(df) -> list[tuple[str, set[str]]]:
    """The exchanges of the plan before it runs: by what, and the columns they carry."""
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append((node.outputPartitioning().toString(), set(re.findall(r"(\w+)#", node.output().mkString(" ")))))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan().initialPlan())
    return found


def test_costs_of_charges_and_amounts_of_payments_are_shuffled_once(no_broadcast, sf_dir):
    moved = _shuffled(QUERIES["report_charges_admission"](no_broadcast, sf_dir))
    # The account table is small; its join is the one besides the charge's that moves them when nothing may be broadcast.
    wide = [by for by, columns in moved if "stay_cost" in columns and "charge_account_id" not in by]
    assert len(wide) == 2 and sum("(charges_id#" in by for by in wide) == 2, wide
    assert not any("Primary" in columns and "stay_cost" in columns for _, columns in moved)


def test_named_members_are_shuffled_once(no_broadcast, sf_dir):
    t = standin_tables(no_broadcast, sf_dir)
    moved = _shuffled(parts.diagnosis_ranks(t, t.encounter))
    assert moved and not any("obs_group_id" in by or "_slot" in by for by, _ in moved)


def test_a_hot_encounter_is_split_where_its_members_meet_it(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        hot = F.when(n % 3 == 0, 7).otherwise(n % 4000).cast("bigint")
        members = spark.range(40_000, numPartitions=6).select(
            n.alias("obs_id"),
            hot.alias("person_id"),
            F.lit(1).alias("concept_id"),
            hot.alias("encounter_id"),
            (hot * 10_000 + F.when(n % 3 == 0, n % 4000).otherwise(0)).alias("obs_group_id"),
            F.when(n % 2 == 0, 1).otherwise(n % 40).cast("bigint").alias("value_coded"),
        )
        names = spark.range(1, 30).select(
            n.alias("concept_id"),
            F.when(n == 1, "Primary").otherwise(F.concat(F.lit("n"), n)).alias("name"),
            F.lit("FULLY_SPECIFIED").alias("concept_name_type"),
            F.lit("en").alias("locale"),
            F.lit(0).alias("voided"),
        )
        t = from_frames({"obs": members, "concept_name": names})
        encounters = spark.range(4000).select(n.alias("encounter_id"))
        many, few = (parts.diagnosis_ranks(t, encounters, few=few) for few in (False, True))
        assert "skew=true" in _final(many)
        assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_sides_of_an_interval_join_are_shuffled_once(no_broadcast):
    moved = "timestamp_ntz'2024-01-05' + make_dt_interval(int(id))"
    left = no_broadcast.range(5).selectExpr("id AS a", f"{moved} AS t", "id * 2 AS l")
    right = no_broadcast.range(5).selectExpr("id AS b", f"{moved} AS u", "id * 3 AS r")
    moved = _shuffled(interval_join(left, right, [("a", "b")], "t", "u", how="left", piece_rows=PIECE_ROWS))
    assert sorted(c for _, columns in moved for c in columns if c in "lr") == ["l", "r"]


def test_a_wide_filter_of_keys_loses_no_row(spark):
    rows = spark.range(20_000).selectExpr("if(id % 10 = 0, null, id - 5000) AS k", "id AS v")
    ids = spark.range(0, 20_000, 7).selectExpr("if(id % 3 = 0, null, id - 5000) AS k").union(spark.sql("SELECT 7L"))
    for filter_ in (WIDE, {"words": 4, "wide": 3}, {"words": 1, "wide": 8, "marks": 3}):
        kept = maybe_within(rows, "k", ids, **filter_)
        assert kept.columns == ["k", "v"] and kept.count() == kept.distinct().count()
        assert kept.join(ids.distinct(), "k").count() == rows.join(ids.distinct(), "k").count() > 1500
    assert maybe_within(rows, "k", ids, **WIDE).count() < 2200
    assert maybe_within(rows, "k", ids.limit(0), **WIDE).count() == 0
    # A key with more bits is less often taken for another.
    few, more = (maybe_within(rows, "k", ids, words=160, wide=1, marks=marks).count() for marks in (3, 1))
    assert few < more
