"""Hand-computed answers where a wrong build would give a different one."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clinic import ADMISSION, DISCHARGE, NEURO, SURGERY, Clinic, at, rows
from wardline import without_deleted
from wardline.functions import codes
from wardline.functions import columns as C
from wardline.operators import aggregates as A
from wardline.operators.joins import interval_join, left_join_many, with_frequent_name, with_name
from wardline.operators.lists import comma_text, list_ends
from wardline.plans import cohorts, daily, financial, operative, parts

AS_OF = dt.date(2024, 12, 1)
DAY = dt.date(2024, 1, 5)
A_CODE, B_CODE, OTHER = codes.HYDROCEPHALUS_DX[0], codes.SPINA_BIFIDA_DX[0], 999
MONTH = {1: "01", 2: "04", 3: "07", 4: "10"}


@pytest.fixture
def clinic(spark):
    return Clinic(spark)


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# -- columns ------------------------------------------------------------------


@pytest.mark.parametrize(
    "at_day, birth, age",
    [
        ("2024-01-01", "2010-03-05", 13),
        ("2010-01-01", "2011-03-05", -1),
        ("2010-01-01", "2010-06-01", 0),
        ("2014-01-01", "2010-01-01", 4),
        ("2013-12-31", "2010-01-01", 3),
    ],
)
def test_age_truncates_toward_zero(spark, at_day, birth, age):
    day, born = (F.lit(d).cast("date") for d in (at_day, birth))
    assert _one(spark, C.age_years(day, born)) == age


@pytest.mark.parametrize(
    "diag, primary",
    [
        ("Primary,X", "X"),
        ("X,Primary", "X"),
        ("X,Y,Primary", None),
        ("Primary", "Primary"),
        ("Primary,X, type 2", " type 2"),
    ],
)
def test_ranked_member(spark, diag, primary):
    assert _one(spark, C.ranked_member("Primary", F.lit(diag))) == primary


def test_ranked_member_of_a_null_list(spark):
    assert _one(spark, C.ranked_member("Primary", F.lit(None).cast("string"))) is None


def test_ranked_member_ignoring_case(spark):
    text = F.lit("primary,X")
    assert _one(spark, C.ranked_member("Primary", text)) is None
    assert _one(spark, C.ranked_member("Primary", text, ignore_case=True)) == "X"


def test_concat_with_and_without_nulls(spark):
    values = [F.lit("a"), F.lit(None).cast("string"), F.lit("c")]
    assert _one(spark, F.concat(*values)) is None
    assert _one(spark, F.concat_ws(" ", *values)) == "a c"


@pytest.mark.parametrize("code, label", [(164180, "Initial"), (160530, "Followup"), (7, "None")])
def test_visit_type_labels(spark, code, label):
    found = C.label_code(F.lit(code), codes.VISIT_TYPE_LABELS, codes.VISIT_TYPE_DEFAULT)
    assert _one(spark, found) == label


@pytest.mark.parametrize(
    "labels, for_a, for_b",
    [
        (("A", "", ""), True, False),
        (("A", "B", ""), False, True),
        (("B", "", ""), False, True),
        (("", "", ""), False, False),
    ],
)
def test_any_and_none_of(spark, labels, for_a, for_b):
    slots = [F.lit(x) for x in labels]
    assert _one(spark, C.any_of(slots, "A") & C.none_of(slots, "B")) is for_a
    assert _one(spark, C.any_of(slots, "B")) is for_b


def test_code_families():
    sizes = [
        len(f)
        for f in (
            codes.HYDROCEPHALUS_DX,
            codes.SPINA_BIFIDA_DX,
            codes.HYDROCEPHALUS_OPERATIONS,
            codes.SHUNT_TOTAL,
            codes.SHUNT_REVISIONS,
            codes.ETV,
            codes.MMC_CLOSURES,
        )
    ]
    assert sizes == [19, 33, 46, 44, 15, 1, 6]
    assert not set(codes.HYDROCEPHALUS_DX) & set(codes.SPINA_BIFIDA_DX)
    assert set(codes.SHUNT_REVISIONS) < set(codes.SHUNT_TOTAL)
    assert set(codes.HYDROCEPHALUS_OPERATIONS) - set(codes.SHUNT_TOTAL) == {164049, 164320}


def test_null_code_is_of_no_family(spark):
    assert _one(spark, C.classify(F.lit(None).cast("bigint"), codes.DX_FAMILIES)) == ""


# -- operators ----------------------------------------------------------------


@pytest.mark.parametrize(
    "items, slots",
    [
        ([], (None, None, None)),
        (["a"], ("a", None, None)),
        (["a", "b"], ("a", "b", None)),
        (["a", "b", "c"], ("a", "b", "c")),
        (["a", "b", "c", "d"], ("a", "b", "d")),
        (["a", None, "c", "d"], ("a", "c", "d")),
        ([None, "b"], ("b", None, None)),
    ],
)
def test_list_ends(spark, items, slots):
    data = [(1, i, v) for i, v in enumerate(items)] or [(1, 0, None)]
    df = spark.createDataFrame(data, "k int, i int, v string")
    found = list_ends(df, ["k"], "v", "i").first()
    assert (found["first"], found["second"], found["last"]) == slots


def test_list_ends_descending_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "b"), (1, 2, "a"), (1, 3, None)], "k int, i int, v string"
    )
    found = list_ends(df, ["k"], "v", ["i", "v"], descending=True).first()
    assert (found["first"], found["second"], found["last"]) == ("b", "a", "x")


@pytest.mark.parametrize("size", range(1, 7))
def test_comma_text_parses_like_the_whole_list(spark, size):
    words = ["Primary", "X, type 2", "Y", "Secondary", "Z", "Primary"]
    for start in range(len(words)):
        items = [words[(start + i) % len(words)] for i in range(size)]
        df = spark.createDataFrame([(1, i, v) for i, v in enumerate(items)], "k int, i int, v string")
        short = list_ends(df, ["k"], "v", "i").withColumn("diag", comma_text())
        whole = F.lit(",".join(items))
        for rank in ("Primary", "Secondary"):
            found = short.select(
                C.ranked_member(rank, "diag").alias("s"), C.ranked_member(rank, whole).alias("w")
            ).first()
            assert found["s"] == found["w"], items


def test_pick_first_takes_the_smallest_id(spark):
    df = spark.createDataFrame([(1, 7, "b"), (1, 3, "a")], "k int, id int, v string")
    assert A.pick_first(df, ["k"], "id", {"v": "v"}).first()["v"] == "a"


def test_mode_pivot_compares_numbers(spark):
    df = spark.createDataFrame(
        [(1, 1, Decimal("90.00")), (1, 1, Decimal("1000.00"))], "k int, m int, a decimal(18,2)"
    )
    found = A.mode_pivot(df, "k", "m", "a", {"one": 1, "two": 2}, "total").first()
    assert (found["one"], found["two"], found["total"]) == (
        Decimal("1000.00"),
        None,
        Decimal("1090.00"),
    )


def test_eav_pivot_text_is_empty_and_numbers_null(spark):
    df = spark.createDataFrame(
        [(1, 5, "t", None), (2, 6, None, 9.0), (2, 6, None, 10.0)],
        "k int, concept_id int, s string, n double",
    )
    found = rows(A.eav_pivot(df, ["k"], {"s": (5, "s"), "n": (6, "n")}).orderBy("k"))
    assert found == [{"k": 1, "s": "t", "n": None}, {"k": 2, "s": "", "n": 10.0}]


def test_ordered_concat(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (1, 20, "z"), (1, 2, None), (2, 1, None)],
        "k int, i int, v string",
    )
    chunk = F.floor(F.col("i") / 4)
    for descending, text in ((False, "a|c|z"), (True, "z|c|a")):
        out = A.ordered_concat(df, ["k"], "v", ["i"], chunk, "t", "|", descending)
        assert {r["k"]: r["t"] for r in out.collect()} == {1: text, 2: None}


def test_distinct_concat_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "a", None), (1, "b", None), (2, None, "q")],
        "k int, v string, w string",
    )
    out = A.distinct_concat(df, ["k"], {"v": "v", "w": "w"})
    assert {r["k"]: (r["v"], r["w"]) for r in out.collect()} == {1: ("a, b", None), 2: (None, "q")}


@pytest.mark.parametrize(
    "quarters, smallest, year",
    [
        ({1: 3, 2: 2, 3: 4}, (0, 0, 2), (5, 4, 9)),
        ({1: 3}, (3, 0, 3), (3, 0, 3)),
        ({}, (0, 0, 0), (0, 0, 0)),
    ],
)
def test_half_year_statistic(spark, quarters, smallest, year):
    data = [(q,) for q, n in quarters.items() for _ in range(n)]
    df = spark.createDataFrame(data, "q int")
    counts = A.half_year_counts(df, F.col("q"), F.lit(1))
    assert counts.count() == len(quarters)
    assert tuple(A.one_row_statistic(counts).first()) == smallest
    assert tuple(A.one_row_statistic(counts, "sum").first()) == year


def _interval_sides(spark):
    left = spark.createDataFrame(
        [(1, 7, at("2024-01-05 10:00")), (2, 8, at("2024-01-05 10:00")), (3, 7, None)],
        "id int, patient int, seen timestamp_ntz",
    )
    right = spark.createDataFrame(
        [
            (1, 7, at("2024-01-03 09:59")),
            (2, 7, at("2024-01-03 10:00")),
            (3, 7, at("2024-01-07 10:00")),
            (4, 7, at("2024-01-07 10:01")),
            (5, 9, at("2024-01-05 10:00")),
            (6, 7, None),
        ],
        "b int, who int, booked timestamp_ntz",
    )
    return left, right


def test_interval_join_bounds(spark):
    left, right = _interval_sides(spark)
    on = [("patient", "who")]
    inner = interval_join(left, right, on, "seen", "booked")
    assert sorted((r["id"], r["b"]) for r in inner.collect()) == [(1, 2), (1, 3)]
    outer = interval_join(left, right, on, "seen", "booked", how="left")
    assert sorted((r["id"], r["b"] or 0) for r in outer.collect()) == [
        (1, 2),
        (1, 3),
        (2, 0),
        (3, 0),
    ]


@pytest.mark.parametrize("before, after", [(2, 2), (0, 3), (1, 0), (0, 0), (5, 1)])
def test_interval_join_against_brute_force(spark, before, after):
    times = [at("2024-02-26 00:00") + dt.timedelta(hours=7 * i) for i in range(40)]
    left = spark.createDataFrame(
        [(i, i % 3, t) for i, t in enumerate(times)], "id int, k int, a timestamp_ntz"
    )
    right = spark.createDataFrame(
        [(i, i % 3, t + dt.timedelta(hours=5)) for i, t in enumerate(times)],
        "rid int, rk int, b timestamp_ntz",
    )
    out = interval_join(left, right, [("k", "rk")], "a", "b", before, after)
    expected = {
        (i, j)
        for i, a in enumerate(times)
        for j, b in enumerate(times)
        if i % 3 == j % 3
        and a - dt.timedelta(days=before)
        <= b + dt.timedelta(hours=5)
        <= a + dt.timedelta(days=after)
    }
    found = [(r["id"], r["rid"]) for r in out.collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_left_join_many_keeps_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    out = left_join_many(left, right, ["k"])
    assert sorted((r["k"] or 0, r["v"] or "") for r in out.collect()) == [
        (0, ""),
        (1, "x"),
        (1, "y"),
        (2, ""),
    ]


def test_with_name_keeps_uncoded_rows(spark):
    obs = spark.createDataFrame([(1, 11), (2, None), (3, 99)], "encounter_id int, value_coded long")
    names = spark.createDataFrame([(11, "X")], "concept_id long, name string")
    out = with_name(obs, F.col("value_coded"), names, spread_by="encounter_id")
    assert {r["encounter_id"]: r["name"] for r in out.collect()} == {1: "X", 2: None, 3: None}


# -- daily lists and census ---------------------------------------------------


def _admission(clinic, encounter=1, patient=1, when="2024-01-05 10:00", visit=1, **values):
    clinic.encounter(encounter, patient, ADMISSION, when, visit=visit, **values)


def _ranks(t, **options):
    return parts.diagnosis_ranks(t, t.encounter, **options)


def test_ranked_list_has_one_row_per_encounter(clinic):
    clinic.patient(1)
    clinic.add("patient_identifier", patient_id=1, identifier="KH0", identifier_type=4)
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 11)
    clinic.group(1, 1, 51, 12, 2)
    for day in ("2024-01-04 09:00", "2024-01-08 09:00", "2024-01-06 23:00"):
        clinic.obs(None, 1, codes.OPERATION_DATE, value_datetime=at(day))
    found = rows(daily.daily_list_ranked(clinic.tables(), DAY, AS_OF))
    assert len(found) == 1
    row = found[0]
    assert (row["Primary"], row["Secondary"], row["KH_Number"]) == ("X", "Y", "KH0")
    assert row["DoO"] == dt.date(2024, 1, 6)
    assert row["num_days"] == (AS_OF - dt.date(2024, 1, 6)).days
    assert row["patient_name"] == "Family1 Given1"


def test_ranked_list_without_operation_date(clinic):
    clinic.patient(1)
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 11)
    row = rows(daily.daily_list_ranked(clinic.tables(), DAY, AS_OF))[0]
    assert row["DoO"] is None and row["num_days"] is None


def test_ranked_list_skips_other_days_and_deleted(clinic):
    for patient, when, voided in ((1, "2024-01-06 00:00", 0), (2, "2024-01-05 10:00", 1)):
        clinic.patient(patient)
        _admission(clinic, patient, patient, when, voided=voided)
        clinic.group(patient, patient, patient, 1, 11)
    assert rows(daily.daily_list_ranked(clinic.tables(), DAY, AS_OF)) == []


def test_group_members_that_do_not_count(clinic):
    clinic.patient(1)
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 11)
    clinic.obs(1, 1, codes.GROUP_EXCLUDED, obs_group_id=50, value_coded=12)
    clinic.obs(1, 1, 7, value_coded=12)
    clinic.concept(11, "sx", locale="fr")
    clinic.concept(11, "old", voided=1)
    clinic.concept(11, "short", kind="SHORT")
    found = rows(_ranks(clinic.tables()))
    assert [(r["Primary"], r["Secondary"]) for r in found] == [("X", None)]


def test_group_with_an_unnamed_diagnosis(clinic):
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 777)
    assert rows(_ranks(clinic.tables()))[0]["Primary"] == "Primary"


def test_ranks_by_membership(clinic):
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 13)
    clinic.group(1, 1, 51, 777, 11, 12, 2)
    clinic.group(1, 1, 52, 1)
    t = clinic.tables()
    by_list = rows(_ranks(t))[0]
    assert (by_list["Primary"], by_list["Secondary"]) == (" type 2, Primary", None)
    by_member = rows(_ranks(t, parse="members"))[0]
    assert (by_member["Primary"], by_member["Secondary"]) == ("X, type 2", "X")


def test_encounter_with_several_groups(clinic):
    _admission(clinic)
    clinic.group(1, 1, 50, 2, 12)
    clinic.group(1, 1, 51, 2, 11)
    clinic.group(1, 1, 52, 2, 12)
    assert rows(_ranks(clinic.tables()))[0]["Secondary"] == "X, Y"


def test_linked_list_needs_every_part(clinic):
    clinic.surgeon()
    for patient in (1, 2, 3, 4):
        clinic.patient(patient)
        _admission(clinic, patient, patient)
        if patient != 2:
            clinic.group(patient, patient, patient, 1, 11)
        if patient != 3:
            clinic.obs(patient, patient, codes.NOTES, value_text="n")
        if patient != 4:
            clinic.booking(100 + patient, patient, "2024-01-07 10:00")
            clinic.booking(200 + patient, patient, "2024-01-06 10:00")
    found = rows(daily.daily_list_linked(clinic.tables(), DAY, AS_OF))
    assert [r["patient_id"] for r in found] == [1]
    assert (found[0]["DoO"], found[0]["Surgeon"]) == (dt.date(2024, 1, 6), "Jo Cutter")
    assert found[0]["Operation"] == "Shunt"


def test_slot_list_repeats_rows(clinic):
    clinic.surgeon()
    clinic.patient(1)
    clinic.add("patient_identifier", patient_id=1, identifier="KH1b", identifier_type=4)
    clinic.add("patient_identifier", patient_id=1, identifier="no", identifier_type=4, voided=1)
    clinic.add("patient_identifier", patient_id=1, identifier="no", identifier_type=3)
    _admission(clinic)
    clinic.diagnoses(1, 1, 31, 32, 33, 34)
    found = rows(daily.daily_list_slots(clinic.tables(), DAY, AS_OF))
    assert sorted(r["KH_Number"] for r in found) == ["KH1", "KH1b"]
    assert {(r["primary"], r["secondary"], r["dx3"]) for r in found} == {("a", "b", "d")}
    assert {r["notes"] for r in found} == {None}


def test_slot_list_with_unnamed_diagnosis_and_wrong_person(clinic):
    clinic.surgeon()
    for patient in (1, 2):
        clinic.patient(patient)
        _admission(clinic, patient, patient)
    clinic.diagnoses(1, 1, 777)
    clinic.diagnoses(2, 1, 31)
    found = rows(daily.daily_list_slots(clinic.tables(), DAY, AS_OF))
    assert [(r["patient_id"], r["primary"], r["dx3"]) for r in found] == [(1, "", "")]


def test_open_stays(clinic):
    clinic.surgeon()
    stays = {
        1: (None, "2024-01-06 09:00"),
        2: ("2024-01-06 12:00", None),
        3: ("2024-01-06 12:00", "2024-01-06 09:00"),
    }
    for n, (stopped, discharged) in stays.items():
        clinic.patient(n)
        clinic.add("visit", visit_id=n, date_stopped=stopped and at(stopped))
        _admission(clinic, n, n, visit=n)
        if discharged:
            clinic.encounter(50 + n, n, DISCHARGE, discharged, visit=n)
            clinic.encounter(60 + n, n, DISCHARGE, "2024-01-09 09:00", visit=n)
    clinic.add("patient_identifier", patient_id=1, identifier="KH0", identifier_type=4)
    clinic.booking(101, 1, "2024-01-06 10:00")
    clinic.booking(102, 1, "2024-01-04 10:00", operation=None)
    _admission(clinic, 9, 1, "2024-01-05 20:00", visit=1)
    found = {r["patient_id"]: r for r in rows(daily.open_stays(clinic.tables(), DAY, AS_OF))}
    assert sorted(found) == [1, 2]
    first = found[1]
    assert (first["encounter_id"], first["KH_Number"]) == (1, "KH0")
    assert (first["DoO"], first["operation"]) == (dt.date(2024, 1, 4), "")
    assert first["date_of_discharge"] == dt.date(2024, 1, 6)
    assert first["num_days"] == (AS_OF - dt.date(2024, 1, 4)).days
    assert found[2]["DoO"] is None and found[2]["num_days"] is None


def test_open_stays_leaves_out(clinic):
    clinic.surgeon()
    clinic.patient(1, dead=1)
    clinic.patient(2, voided=1)
    clinic.patient(3)
    clinic.patient(4)
    clinic.patient(5)
    for n in (1, 2, 3, 4, 5):
        clinic.add("visit", visit_id=n, voided=int(n == 3))
    for n in (1, 2, 3):
        _admission(clinic, n, n, visit=n)
    _admission(clinic, 4, 4, visit=None)
    _admission(clinic, 5, 5, "2024-01-06 00:00", visit=5)
    assert rows(daily.open_stays(clinic.tables(), DAY, AS_OF)) == []


def test_deleted_admission_still_counts_as_open_but_has_no_diagnosis(clinic):
    clinic.surgeon()
    clinic.patient(1)
    clinic.add("visit", visit_id=1)
    _admission(clinic, voided=1)
    clinic.group(1, 1, 50, 1, 11)
    found = rows(daily.open_stays(clinic.tables(), DAY, AS_OF))
    assert [(r["patient_id"], r["primary"]) for r in found] == [(1, None)]


def test_without_deleted_rows_everywhere(clinic):
    clinic.surgeon()
    clinic.patient(1)
    clinic.add("visit", visit_id=1)
    _admission(clinic, voided=1)
    t = clinic.tables()
    assert daily.open_stays(t, DAY, AS_OF).count() == 1
    assert daily.open_stays(without_deleted(t), DAY, AS_OF).count() == 0


def test_bookings(clinic):
    clinic.surgeon()
    clinic.add("person_name", person_id=900, given_name="Al", family_name="Cutter", voided=1)
    clinic.booking(101, 1, "2024-01-06 10:00")
    clinic.obs(101, 1, codes.APPOINTMENT_DATE, value_datetime=at("2024-01-07 10:00"))
    clinic.booking(102, 1, "2024-01-06 10:00", operation=777)
    clinic.encounter(103, 1, 14, "2024-01-01 08:00", creator=901)
    clinic.obs(103, 1, codes.APPOINTMENT_DATE, value_datetime=at("2024-01-07 10:00"))
    found = {r["encounter_id"]: r for r in rows(parts.bookings(clinic.tables()))}
    assert sorted(found) == [101, 102]
    assert found[101]["Appointment_Date"] == at("2024-01-07 10:00")
    assert (found[101]["Operation"], found[101]["Surgeon"]) == ("Shunt", "Al Cutter")
    assert found[102]["Operation"] == ""


def test_notes_take_the_first_live_one(clinic):
    clinic.obs(1, 1, codes.NOTES, obs_id=7, value_text="b")
    clinic.obs(1, 1, codes.NOTES, obs_id=3, value_text="a")
    clinic.obs(1, 1, codes.NOTES, obs_id=1, value_text="deleted", voided=1)
    assert rows(parts.notes(clinic.tables())) == [{"encounter_id": 1, "notes": "a"}]


# -- money --------------------------------------------------------------------


def _charged(clinic, when="2024-01-31 00:00"):
    clinic.surgeon()
    clinic.patient(1)
    _admission(clinic)
    clinic.group(1, 1, 50, 1, 11)
    clinic.diagnoses(1, 1, 31)
    clinic.charge(500, 1, 1, when)


JANUARY = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


@pytest.mark.parametrize("admissions", ["ranked", "slots"])
def test_financial_end_day(clinic, admissions):
    _charged(clinic, "2024-01-31 09:00")
    clinic.payment(500, 1, "5.00")
    t = clinic.tables()
    assert financial.financial_report(t, *JANUARY, admissions).count() == 0
    whole = financial.financial_report(t, *JANUARY, admissions, end_inclusive_day=True)
    assert whole.count() == 1


def test_financial_amounts(clinic):
    _charged(clinic)
    clinic.payment(500, 1, "90.00", account=6, when="2024-02-03 09:00")
    clinic.payment(500, 1, "1000.00")
    clinic.payment(500, 7, "1.00")
    row = rows(financial.financial_report(clinic.tables(), *JANUARY))[0]
    assert (row["NHIF"], row["Individual"]) == (Decimal("1000.00"), None)
    assert row["Total_Paid"] == Decimal("1091.00")
    assert (row["charge_account_id"], row["account_name"]) == (5, "Main")
    assert row["payment_date"] == dt.date(2024, 2, 3)
    assert (row["Primary"], row["location"]) == ("X", "Ward")
    assert row["Operation"] is None and row["date_of_discharge"] is None


def test_unpaid_charge_is_dropped(clinic):
    _charged(clinic)
    assert financial.financial_report(clinic.tables(), *JANUARY).count() == 0


def test_discharges_and_bookings_repeat_a_charge(clinic):
    _charged(clinic)
    clinic.payment(500, 2, "5.00")
    for n in (1, 2):
        clinic.encounter(50 + n, 1, DISCHARGE, f"2024-01-0{6 + n} 09:00", visit=1)
        clinic.booking(100 + n, 1, f"2024-01-0{4 + n} 09:00")
    t = clinic.tables()
    assert financial.financial_report(t, *JANUARY).count() == 4
    assert financial.charges_admission(t).count() == 4


def test_slots_take_deleted_admissions_and_ranks_do_not(clinic):
    clinic.surgeon()
    clinic.patient(1)
    _admission(clinic, voided=1)
    clinic.group(1, 1, 50, 1, 11)
    clinic.diagnoses(1, 1, 31)
    clinic.charge(500, 1, 1, "2024-01-10 00:00")
    clinic.payment(500, 1, "5.00")
    t = clinic.tables()
    assert financial.financial_report(t, *JANUARY).count() == 0
    assert financial.financial_report(t, *JANUARY, "slots").count() == 1


def test_payment_lists(clinic):
    _charged(clinic)
    clinic.payment(500, 1, "5.00")
    clinic.payment(500, 7, "6.00")
    clinic.obs(None, 1, codes.HOSPITAL_NUMBER, value_text="K1")
    clinic.obs(None, 1, codes.HOSPITAL_NUMBER, value_text="K2", voided=1)
    t = clinic.tables()
    flat = rows(financial.payments_flat(t))
    assert [(r["amount_paid"], r["mode_of_payment"]) for r in flat] == [(Decimal("5.00"), "NHIF")]
    summary = rows(financial.payment_summary(t))
    assert [(r["KH_Number"], r["Total_Paid"]) for r in summary] == [("K1", Decimal("11.00"))]


def test_carried_columns_are_the_same_with_few_rows_and_with_many(clinic):
    for location in (1, 3, 2):  # an encounter that comes three times
        clinic.encounter(1, 1, ADMISSION, "2024-01-05 10:00", visit=7 if location == 3 else None, voided=location)
    clinic.encounter(2, 2, ADMISSION, "2024-01-06 10:00", visit=8)
    for group, dx in ((1, 11), (2, 12)):
        clinic.group(1, 1, group, 1, dx)
    clinic.group(2, 2, 3, 2, 11)
    t = clinic.tables()
    carry = ["patient_id", "visit_id", "voided"]
    few, many = (
        parts.diagnosis_ranks(t, t.encounter, parse="members", carry=carry, few=few) for few in (True, False)
    )
    assert few.columns == many.columns
    expected = [(1, 1, 1, 7, 3, "X, Y", None), (2, 2, 2, 8, 0, None, "X")]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == expected


def test_repeated_charges_keep_their_rows_and_their_own_visit(clinic):
    for patient in (1, 2):
        clinic.patient(patient)
        clinic.encounter(patient, patient, ADMISSION, f"2024-01-0{patient} 10:00", visit=patient)
        clinic.group(patient, patient, patient, 1, 11)
        clinic.encounter(10 + patient, patient, DISCHARGE, "2024-01-09 10:00", visit=patient)
    clinic.encounter(21, 1, DISCHARGE, "2024-01-20 10:00", visit=1)
    # The same charge of two visits, once twice, of nobody, of another's visit and of none.
    for patient, visit, cost in ((1, 1, 5), (1, 1, 5), (1, 1, 6), (2, 2, 7), (None, 1, 8), (2, 1, 9), (2, None, 10)):
        clinic.add("charges", charges_id=4, patient_id=patient, visit_id=visit, stay_cost=Decimal(cost))
    clinic.add("charges", charges_id=None, patient_id=1, visit_id=1, stay_cost=Decimal(11))
    clinic.add("payment", charges_id=4, charge_account_id=5, mode_of_payment_id=1, amount_paid=Decimal(1))
    found = [
        (r["patient_id"], r["visit_id"], r["stay_cost"], r["date_of_discharge"] and r["date_of_discharge"].day, r["DoA"].day)
        for r in rows(financial.charges_admission(clinic.tables()))
    ]
    twice = [(1, 1, cost, day, 1) for cost in (5, 5, 6) for day in (9, 20)]
    assert sorted(found, key=str) == sorted([*twice, (2, 2, 7, 9, 2), (2, 1, 9, None, 1)], key=str)


@pytest.mark.parametrize("frequent", [0, 1, 64])
def test_frequent_names_are_the_names(spark, monkeypatch, frequent):
    monkeypatch.setattr("wardline.operators.joins._FREQUENT", frequent)
    codes_ = "CASE WHEN id % 5 < 3 THEN 7 WHEN id % 5 = 3 THEN id ELSE NULL END"
    obs = spark.range(300).selectExpr("id", f"CAST({codes_} AS BIGINT) AS value_coded")
    # Two names of one code, codes without a name, a name of nobody.
    names = spark.sql("SELECT * FROM VALUES (7L, 'a'), (7L, 'b'), (3L, 'c'), (8L, 'd'), (13L, CAST(NULL AS STRING)), (-5L, 'e') AS v(concept_id, name)")
    plain, split = (f(obs, F.col("value_coded"), names, spread_by="id") for f in (with_name, with_frequent_name))
    assert plain.columns == split.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert split.count() == 300 + 180


# -- operative report ---------------------------------------------------------


def _surgery(clinic):
    for patient in (1, 2):
        clinic.patient(patient, birthdate="2010-03-05")
        clinic.encounter(patient, patient, SURGERY, "2024-01-05 10:00")
        clinic.obs(patient, patient, codes.OPERATION, value_coded=21)
    clinic.obs(1, 1, codes.SURGEON, value_text="Jo")
    clinic.obs(1, 1, codes.WEIGHT, value_numeric=9.5)
    clinic.obs(1, 1, codes.WEIGHT, value_numeric=10.0)
    clinic.encounter(3, 1, SURGERY, "2024-01-06 10:00")
    clinic.obs(3, 1, 4242, value_text="something else")
    clinic.encounter(4, 1, SURGERY, "2024-01-07 10:00")


def test_operative_report(clinic):
    _surgery(clinic)
    t = clinic.tables()
    for choice in ({"patient": 1}, {"hospital_number": "KH1"}):
        found = rows(operative.operative_report(t, DAY, **choice))
        assert len(found) == 1
        row = found[0]
        assert (row["operation"], row["surgeon"], row["findings"]) == ("Shunt", "Jo", "")
        assert (row["weight"], row["ebl"], row["age"]) == (10.0, None, 13)
        assert row["name"] == "Family1 Given1"


def test_operative_report_needs_an_observation(clinic):
    _surgery(clinic)
    found = rows(operative.operative_report(clinic.tables(), patient=1))
    assert sorted(r["encounter_id"] for r in found) == [1, 3]


# -- cohorts and statistics ---------------------------------------------------


def _visit(clinic, encounter, patient, when, *coded, answer=None):
    clinic.encounter(encounter, patient, NEURO, when)
    clinic.diagnoses(encounter, patient, *coded)
    if answer:
        clinic.obs(encounter, patient, codes.VISIT_TYPE, value_coded=answer)


def test_visit_statistic_counts_visits_per_quarter(clinic):
    clinic.patient(1)
    n = 0
    for quarter, visits in ((1, 3), (2, 2), (3, 4)):
        for _ in range(visits):
            n += 1
            _visit(clinic, n, 1, f"2024-{MONTH[quarter]}-{n + 1:02d} 09:00", A_CODE)
    t = clinic.tables()
    seen = dict(seen_with=codes.HYDROCEPHALUS, never_with=codes.SPINA_BIFIDA)
    assert tuple(cohorts.visit_statistic(t, **seen, wrap=True).first()) == (0, 0, 2)
    assert tuple(cohorts.visit_statistic(t, **seen, wrap=True, combine="sum").first()) == (5, 4, 9)
    assert sorted(tuple(r) for r in cohorts.visit_statistic(t, **seen).collect()) == [
        (0, 4, 4),
        (2, 0, 2),
        (3, 0, 3),
    ]
    assert cohorts.visit_statistic(t, **seen, year=2023).count() == 0


def test_visit_statistic_families(clinic):
    clinic.patient(1)
    visits = [
        (A_CODE,),
        (A_CODE, B_CODE),
        (B_CODE,),
        (OTHER,),
        (OTHER, OTHER, B_CODE, A_CODE),
        (None, A_CODE),
    ]
    for n, coded in enumerate(visits, 1):
        _visit(clinic, n, 1, "2024-01-10 09:00", *coded)
    t = clinic.tables()
    only_a = cohorts.visit_statistic(
        t, codes.HYDROCEPHALUS, never_with=codes.SPINA_BIFIDA, wrap=True
    )
    # The fifth visit hides its family B code behind the last one.
    assert only_a.first()["total"] == 3
    assert cohorts.visit_statistic(t, codes.SPINA_BIFIDA).first()["total"] == 2


def test_visit_statistic_visit_type(clinic):
    clinic.patient(1)
    _visit(clinic, 1, 1, "2024-01-10 09:00", B_CODE, answer=164180)
    _visit(clinic, 2, 1, "2024-01-11 09:00", B_CODE, answer=160530)
    clinic.obs(2, 1, codes.VISIT_TYPE, value_coded=164180)
    _visit(clinic, 3, 1, "2024-01-12 09:00", B_CODE)
    t = clinic.tables()
    for label in ("Initial", "Followup"):
        found = cohorts.visit_statistic(t, codes.SPINA_BIFIDA, visit_type=label)
        assert [r["total"] for r in found.collect()] == [1]


def test_ages_at_visit_and_today(clinic):
    clinic.patient(1, birthdate="2009-06-01")
    _visit(clinic, 1, 1, "2024-01-10 09:00", A_CODE)
    clinic.encounter(2, 1, SURGERY, "2024-01-10 09:00")
    clinic.obs(2, 1, codes.OPERATION, value_coded=codes.ETV[0])
    t = clinic.tables()
    assert cohorts.visit_statistic(t, codes.HYDROCEPHALUS).first()["total"] == 1
    later = cohorts.operation_statistic(t, codes.ETV, AS_OF)
    assert tuple(later.first()) == (0, 0, 0)
    then = cohorts.operation_statistic(t, codes.ETV, dt.date(2024, 1, 10))
    assert tuple(then.first()) == (1, 0, 1)


def test_operations_count_observations(clinic):
    clinic.patient(1)
    clinic.patient(2, voided=1)
    for n in (1, 2):
        clinic.encounter(n, n, SURGERY, "2024-07-10 09:00")
        for code in codes.SHUNT_TOTAL[:2]:
            clinic.obs(n, n, codes.OPERATION, value_coded=code)
    total = cohorts.operation_statistic(clinic.tables(), codes.SHUNT_TOTAL, AS_OF)
    assert tuple(total.first()) == (0, 2, 2)


def test_cohort_listing(clinic):
    clinic.patient(1, birthdate="2010-03-05")
    _visit(clinic, 1, 1, "2024-01-10 09:00", A_CODE, B_CODE, OTHER)
    t = clinic.tables()
    listed = cohorts.cohort_listing(
        t, codes.NEURO_TYPE_UUID, codes.DIAGNOSIS, codes.HYDROCEPHALUS_DX
    )
    assert [r["value_coded"] for r in listed.collect()] == [A_CODE]
    aged = cohorts.cohort_listing(
        t, codes.NEURO_TYPE_UUID, codes.DIAGNOSIS, codes.SPINA_BIFIDA_DX, as_of=dt.date(2024, 1, 1)
    )
    assert [(r["value_coded"], r["age"]) for r in aged.collect()] == [(B_CODE, 13)]
