"""Brief operative report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import age_years, on_day
from wardline.operators.aggregates import eav_pivot
from wardline.operators.joins import maybe_within, with_name, within
from wardline.plans import parts
from wardline.sources.tables import Tables, replaced

_COLUMNS = {
    "operation": (codes.OPERATION, "name"),
    "dx1": (codes.PREOPERATIVE_DX, "name"),
    "dx2": (codes.POSTOPERATIVE_DX, "name"),
    "surgeon": (codes.SURGEON, "value_text"),
    "findings": (codes.FINDINGS, "name"),
    "operativeDetails": (codes.OPERATIVE_DETAILS, "value_text"),
    "weight": (codes.WEIGHT, "value_numeric"),
    "ebl": (codes.BLOOD_LOSS, "value_numeric"),
    "urine": (codes.URINE_OUTPUT, "value_numeric"),
}
_NAMED = [code for code, value in _COLUMNS.values() if value == "name"]


def operative_report(
    t: Tables,
    date_of_operation: dt.date | None = None,
    patient: int | None = None,
    hospital_number: str | None = None,
) -> DataFrame:
    """One row per surgery encounter with at least one observation.

    Day and patient, or day and hospital number, choose the rows; they are
    applied before observations are read. Any live hospital number of a patient
    finds the patient, and the one asked for is shown. Otherwise, and of several
    names, the smallest is shown.
    """
    surgery = parts.live(t.encounter).filter(F.col("encounter_type") == codes.SURGERY_TYPE)
    if date_of_operation is not None:
        surgery = surgery.filter(on_day("encounter_datetime", date_of_operation))
    if patient is not None:
        surgery = surgery.filter(F.col("patient_id") == patient)
    surgery = surgery.select("encounter_id", "patient_id", "encounter_datetime")
    if hospital_number is not None:
        numbered = parts.hospital_numbers(t).filter(F.col("identifier") == hospital_number)
        surgery = maybe_within(surgery, "patient_id", numbered)
        surgery = surgery.join(numbered.distinct(), "patient_id")

    narrow = any(p is not None for p in (date_of_operation, patient, hospital_number))
    patients = surgery.select("patient_id").distinct() if narrow else None
    if narrow:
        persons = surgery.select(F.col("patient_id").alias("person_id"))
        t = replaced(
            t,
            person=maybe_within(t.person, "person_id", persons),
            person_name=maybe_within(t.person_name, "person_id", persons),
            patient_identifier=maybe_within(t.patient_identifier, "patient_id", surgery),
        )
    who = (
        surgery.join(parts.people(t, patients), "patient_id")
        .join(
            parts.one_full_name(t, "full_name", ("family_name", "given_name"), patients),
            "patient_id",
        )
    )
    if hospital_number is None:
        who = who.join(parts.one_hospital_number(t, patients), "patient_id", "left")

    # Spark's guess of the size of a few encounters is far too large, so it would shuffle and sort all
    # observations to join them. The filter leaves those of the asked encounters, and few others; so do
    # those above for encounters and persons.
    asked = maybe_within(t.obs, "encounter_id", surgery) if narrow else t.obs
    obs = within(asked, "encounter_id", who)
    code = F.when(F.col("concept_id").isin(*_NAMED), F.col("value_coded"))
    named = with_name(obs, code, parts.display_names(t), spread_by="encounter_id")
    wide = eav_pivot(named, ["encounter_id"], _COLUMNS)
    return who.join(wide, "encounter_id").select(
        F.col("patient_id").alias("patient"),
        F.col("identifier").alias("khNo"),
        F.col("full_name").alias("name"),
        F.col("birthdate").alias("dob"),
        age_years("encounter_datetime", "birthdate").alias("age"),
        F.col("gender").alias("sex"),
        F.to_date("encounter_datetime").alias("DoO"),
        "encounter_id",
        *_COLUMNS,
    )
