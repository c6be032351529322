"""Reports over tables whose text compares without case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinic import ADMISSION, SURGERY, Clinic, rows
from wardline import Tables, ignoring_case, plain_text
from wardline.functions import codes
from wardline.operators.aggregates import distinct_concat
from wardline.plans import daily, financial, operative
from wardline.sources.schemas import SCHEMAS

DAY, AS_OF = dt.date(2024, 1, 5), dt.date(2024, 12, 1)

# Keys and words the reports ask for, here in another case.
_KEYS = {"encounter_type": "uuid", "form": "uuid", "concept_name": "locale"}


def respelled(tables: Tables) -> Tables:
    """The tables with their external keys and rank words in upper case."""

    def load(name):
        df = getattr(tables, name)
        if name in _KEYS:
            df = df.withColumn(_KEYS[name], F.upper(_KEYS[name]))
        if name == "concept_name":
            rank = F.col("name").isin("Primary", "Secondary")
            df = df.withColumn("name", F.when(rank, F.upper("name")).otherwise(F.col("name")))
        return df

    return Tables(load)


@pytest.fixture
def clinic(spark):
    made = Clinic(spark)
    made.surgeon()
    for patient in (1, 2):
        made.patient(patient)
        made.encounter(patient, patient, ADMISSION, "2024-01-05 10:00", visit=patient)
        made.group(patient, patient, 50 + patient, 1, 11)
        made.diagnoses(patient, patient, 11, 12)
        made.add("visit", visit_id=patient, patient_id=patient)
        made.booking(20 + patient, patient, "2024-01-06 08:00")
        made.obs(patient, patient, codes.NOTES, value_text="note")
        made.charge(patient, patient, patient, "2024-01-31 00:00")
        made.payment(patient, 1, "10.00")
        made.encounter(30 + patient, patient, SURGERY, "2024-01-05 12:00")
        made.obs(30 + patient, patient, codes.OPERATION, value_coded=21)
    return made


def _period(t, admissions):
    return financial.financial_report(t, dt.date(2024, 1, 1), dt.date(2024, 1, 31), admissions)


REPORTS = {
    "ranked": lambda t: daily.daily_list_ranked(t, DAY, AS_OF),
    "linked": lambda t: daily.daily_list_linked(t, DAY, AS_OF),
    "slots": lambda t: daily.daily_list_slots(t, DAY, AS_OF),
    "open": lambda t: daily.open_stays(t, DAY, AS_OF),
    "financial": lambda t: _period(t, "ranked"),
    "financial_slots": lambda t: _period(t, "slots"),
    "charges": financial.charges_admission,
    "summary": financial.payment_summary,
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_over_other_spellings(clinic, name):
    t = clinic.tables()
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    expected = sorted(rows(REPORTS[name](t)), key=key)
    found = plain_text(REPORTS[name](ignoring_case(respelled(t))))
    assert sorted(rows(found), key=key) == expected
    # Without the collation the keys are not found; the summary asks for none.
    assert name == "summary" or (expected and not rows(REPORTS[name](respelled(t))))


@pytest.mark.parametrize("number", ["KH1", "kh1", "Kh1"])
def test_a_hospital_number_in_any_case(clinic, number):
    t = ignoring_case(clinic.tables())
    found = rows(operative.operative_report(t, DAY, hospital_number=number))
    assert [(r["encounter_id"], r["khNo"], r["operation"]) for r in found] == [(31, "KH1", "Shunt")]


def test_distinct_text_without_case(spark):
    items = [(1, "Flu"), (1, "flu"), (1, "FLU"), (1, "Ache"), (1, None), (2, None), (3, "é"), (3, "É")]
    df = spark.createDataFrame(items, "k int, v string")
    plain = {r.k: r.all for r in distinct_concat(df, ["k"], {"all": "v"}).collect()}
    assert plain == {1: "Ache, FLU, Flu, flu", 2: None, 3: "É, é"}
    folded = df.withColumn("v", F.collate("v", "UTF8_LCASE")).withColumn("w", F.lit("x"))
    found = distinct_concat(folded, ["k"], {"all": "v", "x": "w"}).collect()
    assert {r.k: r.all for r in found} == {1: "Ache, FLU", 2: None, 3: "É"}
    assert {r.x for r in found} == {"x"}


def test_numbers_still_reach_the_scan_and_joins_hash(spark, sf_dir, tmp_path):
    frames = {}
    for name in ("obs", "patient_identifier"):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame([], SCHEMAS[name]).write.parquet(path)
        frames[name] = spark.read.parquet(path)
    t = ignoring_case(Tables(frames.__getitem__))
    notes = t.obs.filter(F.col("concept_id") == codes.NOTES).select("value_text")
    plan = notes._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(concept_id,{codes.NOTES})" in plan
    ids = t.patient_identifier
    joined = ids.alias("a").join(ids.alias("b"), F.col("a.identifier") == F.col("b.identifier"))
    assert "collationkey(identifier" in joined._jdf.queryExecution().executedPlan().toString()
