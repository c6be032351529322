"""Charge and payment reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import between_days
from wardline.operators.joins import (
    PIECE_ROWS,
    WIDE,
    interval_join,
    left_join_many,
    maybe_within,
    semi_lookup,
    within,
)
from wardline.plans import parts
from wardline.sources.schemas import COST_COLUMNS
from wardline.sources.tables import Tables

_PAID = (
    "charges_id",
    "payment_date",
    "charge_account_id",
    *codes.PAYMENT_MODES,
    "Total_Paid",
)


def payments_flat(t: Tables) -> DataFrame:
    """Every payment with its charge, mode and account."""
    return (
        t.payment.join(t.charges.select("charges_id", *COST_COLUMNS), "charges_id")
        .join(t.mode_of_payment, "mode_of_payment_id")
        .join(t.charge_account, "charge_account_id")
        .select(
            *COST_COLUMNS, "payment_date", "amount_paid", "nhif", "account_name", "mode_of_payment"
        )
    )


def payment_summary(t: Tables) -> DataFrame:
    """Paid charges by payment mode, with the patient's data and hospital number."""
    cost = (
        t.charges.select("charges_id", "patient_id", *COST_COLUMNS)
        .join(parts.payment_totals(t), "charges_id")
        .join(t.charge_account, "charge_account_id")
    )
    numbers = (
        parts.live(t.obs)
        .filter(F.col("concept_id") == codes.HOSPITAL_NUMBER)
        .select(F.col("person_id").alias("patient_id"), F.col("value_text").alias("KH_Number"))
    )
    called = cost.join(parts.people(t), "patient_id").join(parts.person_names(t), "patient_id")
    return left_join_many(called, numbers, ["patient_id"], among=t.charges).select(
        "KH_Number",
        F.col("family_name").alias("last_name"),
        F.col("given_name").alias("first_name"),
        F.col("birthdate").alias("dob"),
        F.col("gender").alias("sex"),
        "patient_id",
        *COST_COLUMNS,
        "account_name",
        *_PAID,
    )


_ADMISSION = ("encounter_id", "patient_id", "visit_id", "encounter_datetime", "location_id")


def _admitted(t: Tables) -> DataFrame:
    """Admissions to a visit, by type; deleted ones do not count."""
    admitted = parts.live(parts.encounters_by_type_key(t, codes.ADMISSION_TYPE_UUID))
    return admitted.filter(F.col("visit_id").isNotNull()).select(*_ADMISSION)


def _ranked_admissions(t: Tables, charged: DataFrame | None) -> DataFrame:
    """Admissions with ranked diagnoses; ``charged`` limits them to its visits."""
    admitted = _of_charges(_admitted(t), charged)
    carry = [c for c in _ADMISSION if c != "encounter_id"]
    # Those at no known place drop out below, whatever their diagnoses.
    placed = semi_lookup(admitted, "location_id", t.location, "location_id")
    ranked = parts.diagnosis_ranks(t, admitted, carry=carry, few=charged is not None, asked=placed)
    return _located(t, ranked)


def _slotted_admissions(t: Tables, charged: DataFrame | None) -> DataFrame:
    """Admissions by form with diagnosis slots. Deleted ones count too."""
    admitted = parts.encounters_by_form_key(t, codes.ADMISSION_FORM_UUID)
    slots = parts.diagnosis_slots(t, _of_charges(admitted, charged), few=charged is not None)
    return _located(t, slots.withColumnsRenamed({"dx1": "Primary", "dx2": "Secondary"}))


def _of_charges(admitted: DataFrame, charged: DataFrame | None) -> DataFrame:
    admitted = admitted.filter(F.col("visit_id").isNotNull()).select(*_ADMISSION)
    visits = None if charged is None else charged.select("visit_id").distinct()
    return within(admitted, "visit_id", visits)


def _located(t: Tables, admitted: DataFrame) -> DataFrame:
    places = t.location.select("location_id", F.col("name").alias("location"))
    return admitted.join(places, "location_id").select(
        "visit_id",
        "Primary",
        "Secondary",
        F.col("encounter_datetime").alias("DoA"),
        "location",
    )


def _with_booking(
    t: Tables, df: DataFrame, patients: DataFrame | None = None, filtered: bool = False
) -> DataFrame:
    """Add the bookings around an admission."""
    return interval_join(
        df,
        parts.booking_side(parts.bookings(t, patients=patients, filtered=filtered)),
        [("patient_id", "booking_patient")],
        "DoA",
        "Appointment_Date",
        how="left",
        piece_rows=PIECE_ROWS,
        counted=parts.appointments(t),
    )


def _with_discharge(
    t: Tables, df: DataFrame, among: DataFrame, patients: DataFrame | None = None
) -> DataFrame:
    """Add the discharges of a patient's visit."""
    return left_join_many(
        df,
        parts.discharges(t, patients),
        ["patient_id", "visit_id"],
        among=among.filter(F.col("visit_id").isNotNull()),
    )


def _with_person(
    t: Tables, df: DataFrame, among: DataFrame, patients: DataFrame | None = None
) -> DataFrame:
    """Add the patient's data, names and hospital numbers."""
    called = df.join(parts.people(t, patients), "patient_id").join(
        parts.person_names(t, patients), "patient_id"
    )
    return left_join_many(
        called, parts.hospital_numbers(t, patients), ["patient_id"], among=among
    )


def charges_admission(t: Tables) -> DataFrame:
    """Paid charges with the admission they belong to, booking and discharge.

    Amounts are wide, and meet the rest once: all that hangs on patient and visit is joined to
    the keys of the charges, the step that adds least first. A repeated charge has these once.
    """
    keys = ["charges_id", "patient_id", "visit_id"]
    charges = t.charges.select(*keys, *COST_COLUMNS).filter(F.col("patient_id").isNotNull())
    # Most charges without an admission go first, and their payments.
    charges = maybe_within(charges, "visit_id", _admitted(t), **WIDE)
    left = _with_discharge(t, charges.select(*keys).distinct(), charges)
    stays = _with_booking(t, left.join(_ranked_admissions(t, None), "visit_id"), filtered=True)
    stays = _with_person(t, stays, t.charges)
    paid = charges.join(parts.payment_totals(t, maybe=charges), "charges_id").join(
        t.charge_account, "charge_account_id"
    )
    # Bounds and no equal keys: both sides then meet by the charge, as the payments did.
    own = [f"_{c}" for c in keys]
    stays = stays.withColumnsRenamed(dict(zip(keys, own, strict=True)))
    same = paid["charges_id"] == stays["_charges_id"]
    for c in ("patient_id", "visit_id"):
        same &= paid[c].between(stays[f"_{c}"], stays[f"_{c}"])
    return paid.join(stays, same).select(
        F.col("identifier").alias("KH_Number"),
        F.col("family_name").alias("last_name"),
        F.col("given_name").alias("first_name"),
        F.col("birthdate").alias("dob"),
        F.col("gender").alias("sex"),
        "Operation",
        "Surgeon",
        F.col("Appointment_Date").alias("DoO"),
        "date_of_discharge",
        "patient_id",
        "Primary",
        "Secondary",
        "DoA",
        "location",
        "visit_id",
        *COST_COLUMNS,
        "account_name",
        *_PAID,
    )


def financial_report(
    t: Tables,
    start_date: dt.date,
    end_date: dt.date,
    admissions: str = "ranked",
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Charges of a period with payments, admission, booking and discharge.

    ``admissions`` chooses the diagnoses: ``ranked`` from diagnosis groups, or
    ``slots`` from the ordered list of the later form. Charges are kept by date
    before anything is joined, and limit which admissions are read.
    """
    charged = (
        t.charges.filter(between_days("date_created", start_date, end_date, end_inclusive_day))
        .withColumnRenamed("date_created", "date_of_charge")
        .select("charges_id", "patient_id", "visit_id", "date_of_charge", *COST_COLUMNS)
    )
    admitted = {"ranked": _ranked_admissions, "slots": _slotted_admissions}[admissions]
    # A charge without a payment has no account, so the account join drops it.
    cost = (
        charged.join(parts.payment_totals(t, charged), "charges_id", "left")
        .join(t.charge_account, "charge_account_id")
        .join(admitted(t, charged), "visit_id")
    )
    patients = parts.patients_of(charged)
    left = _with_discharge(t, _with_booking(t, cost, patients), charged, patients)
    return _with_person(t, left, charged, patients).select(
        F.col("identifier").alias("kh_number"),
        F.col("family_name").alias("last_name"),
        F.col("given_name").alias("first_name"),
        F.col("birthdate").alias("dob"),
        F.col("gender").alias("sex"),
        "Operation",
        "Surgeon",
        F.col("Appointment_Date").alias("DoO"),
        "date_of_discharge",
        "patient_id",
        "Primary",
        "Secondary",
        "DoA",
        "location",
        "visit_id",
        *COST_COLUMNS,
        "date_of_charge",
        "account_name",
        *_PAID,
    )
