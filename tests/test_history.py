"""Counts extended by batches, first operations, children seen, and the census of every day."""

import datetime as dt

import pytest
from clinic import ADMISSION, DISCHARGE, NEURO, SURGERY, Clinic, at, rows
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.plans import cohorts, daily, history
from wardline.sources.standins import standin_tables
from wardline.sources.tables import replaced

A, B = codes.HYDROCEPHALUS, codes.SPINA_BIFIDA
A_DX, B_DX = codes.HYDROCEPHALUS_DX[0], codes.SPINA_BIFIDA_DX[0]
ETV, SHUNT = codes.ETV[0], codes.SHUNT_TOTAL[0]
AS_OF = dt.date(2024, 12, 31)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_base_and_increment_equal_a_full_run(spark, sf_dir, tmp_path):
    t = standin_tables(spark, sf_dir)
    cut = F.lit(dt.datetime(1996, 7, 15)).cast("timestamp_ntz")
    store = history.History(spark, str(tmp_path))
    for name, part in (("base", F.col("encounter_datetime") < cut), ("more", F.col("encounter_datetime") >= cut)):
        store.extend(name, replaced(t, encounter=t.encounter.filter(part)))
    store.extend("more", replaced(t, encounter=t.encounter.filter(F.col("encounter_datetime") >= cut)))  # once more
    visits, operations = store.visits(), store.operations()
    as_of = dt.date(2001, 12, 31)
    for ask in (
        {"seen_with": A, "never_with": B, "wrap": True},
        {"seen_with": A, "never_with": B, "visit_type": "Initial"},
        {"seen_with": A, "never_with": B, "visit_type": "Followup"},
        {"seen_with": B},
        {"seen_with": B, "visit_type": "Initial", "wrap": True, "combine": "sum"},
        {"seen_with": B, "visit_type": "Followup", "year": 1996},
        {"seen_with": A, "max_age": 4},
    ):
        assert same(history.visit_statistic(visits, **ask), cohorts.visit_statistic(t, **ask)), ask
    for family in (codes.HYDROCEPHALUS_OPERATIONS, codes.SHUNT_TOTAL, codes.SHUNT_REVISIONS, codes.ETV):
        for more in ({}, {"combine": "sum"}, {"year": 1997}):
            got = history.operation_statistic(operations, family, as_of, **more)
            assert same(got, cohorts.operation_statistic(t, family, as_of, **more))


def test_an_increment_reads_its_own_encounters_only(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    late = F.col("encounter_datetime") >= F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    counts = history.visit_counts(replaced(t, encounter=t.encounter.filter(late)))
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in text


@pytest.fixture
def operated(spark):
    c = Clinic(spark)
    for patient in (1, 2, 3, 4):
        c.patient(patient)
    c.encounter(10, 1, SURGERY, "2023-05-01 08:00")
    c.obs(10, 1, codes.OPERATION, value_coded=ETV)  # before the period
    c.encounter(11, 1, SURGERY, "2024-02-01 08:00")
    c.obs(11, 1, codes.OPERATION, value_coded=SHUNT)
    c.encounter(20, 2, SURGERY, "2024-03-01 08:00")
    c.obs(20, 2, codes.OPERATION, value_coded=SHUNT)
    c.obs(20, 2, codes.OPERATION, value_coded=ETV)
    c.encounter(21, 2, SURGERY, "2024-09-01 08:00")
    c.obs(21, 2, codes.OPERATION, value_coded=ETV)
    c.encounter(30, 3, SURGERY, "2024-12-31 23:00")
    c.obs(30, 3, codes.OPERATION, value_coded=ETV)
    c.encounter(40, 4, SURGERY, "2024-04-01 08:00")
    c.obs(40, 4, codes.OPERATION, value_coded=9)  # of no family
    return c.tables()


def test_a_first_operation_before_the_period_is_the_first(operated):
    period = dt.date(2024, 1, 1), dt.date(2024, 12, 31)
    listed = rows(cohorts.first_interventions(operated, codes.HYDROCEPHALUS_OPERATIONS, AS_OF, *period))
    assert sorted((r["patient_id"], r["encounter_id"], r["value_coded"]) for r in listed) == [(2, 20, min(ETV, SHUNT)), (3, 30, ETV)]
    counts = rows(cohorts.first_intervention_statistic(operated, codes.HYDROCEPHALUS_OPERATIONS, AS_OF))
    assert {r["year"]: (r["jan_jun"], r["jul_dec"], r["total"]) for r in counts} == {2023: (1, 0, 1), 2024: (1, 1, 2)}


def test_a_first_operation_is_found_with_partial_results(spark, operated):
    text = cohorts.first_interventions(operated, codes.ETV, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(struct" in text and "Window" not in text


def test_children_count_once(spark):
    c = Clinic(spark)
    c.patient(1)
    c.patient(2)
    for n, (patient, when) in enumerate([(1, "2024-01-05"), (1, "2024-03-05"), (1, "2024-08-05"), (2, "2024-02-05"), (2, "2023-02-05")]):
        c.encounter(10 + n, patient, NEURO, f"{when} 08:00")
        c.diagnoses(10 + n, patient, A_DX)
    got = {r["year"]: (r["jan_jun"], r["jul_dec"], r["total"]) for r in rows(cohorts.children_seen(c.tables(), A, never_with=B))}
    assert got == {2024: (2, 1, 2), 2023: (1, 0, 1)}


def test_census_equals_open_stays_day_by_day(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    first = dt.date(1995, 6, 1)
    counted = {r["day"]: r["n_open"] for r in rows(daily.census(t, first, dt.date(1996, 7, 31)))}
    assert len(counted) == 427
    for shift in (0, 29, 200, 426):
        day = first + dt.timedelta(days=shift)
        assert counted[day] == daily.open_stays(t, day, day).count()


def test_census_by_hand(spark):
    c = Clinic(spark)
    for patient in (1, 2, 3):
        c.patient(patient)
    for visit, patient, start, stop, gone in (
        (1, 1, "2024-01-30", None, None),
        (2, 2, "2024-02-01", "2024-02-03", "2024-02-04"),
        (3, 3, "2024-02-02", "2024-02-02", None),
        (4, 1, "2024-02-03", "2024-02-01", "2024-02-02"),  # ends before it starts
    ):
        c.encounter(10 * visit, patient, ADMISSION, f"{start} 10:00", visit=visit)
        c.add("visit", visit_id=visit, date_stopped=at(f"{stop} 12:00") if stop else None)
        if gone:
            c.encounter(10 * visit + 1, patient, DISCHARGE, f"{gone} 09:00", visit=visit)
    t = c.tables()
    days = dt.date(2024, 1, 31), dt.date(2024, 2, 5)
    shown = lambda **more: [r["n_open"] for r in sorted(rows(daily.census(t, *days, **more)), key=lambda r: r["day"])]
    assert shown() == [1, 1, 2, 2, 2, 2]
    assert shown(as_recorded=False) == [1, 2, 3, 3, 2, 2]
