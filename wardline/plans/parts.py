"""Intermediate tables shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import ranked_member
from wardline.operators.aggregates import (
    distinct_concat,
    eav_pivot,
    mode_pivot,
    pick_first,
)
from wardline.operators.joins import (
    WIDE,
    maybe_within,
    semi_lookup,
    with_frequent_name,
    with_name,
    within,
)
from wardline.operators.lists import comma_text, list_ends
from wardline.sources.tables import Tables

# A group lies within one encounter, and both belong to one person.
_GROUP = ("encounter_id", "obs_group_id")


def live(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(F.col("voided") == 0)


def display_names(t: Tables) -> DataFrame:
    """Concept id to its full English name."""
    return (
        live(t.concept_name)
        .filter((F.col("concept_name_type") == "FULLY_SPECIFIED") & (F.col("locale") == "en"))
        .select("concept_id", "name")
    )


def encounters_by_type_key(t: Tables, uuid: str) -> DataFrame:
    """Encounters whose type has an external key."""
    types = t.encounter_type.filter(F.col("uuid") == uuid)
    return semi_lookup(t.encounter, "encounter_type", types, "encounter_type_id")


def encounters_by_form_key(t: Tables, uuid: str) -> DataFrame:
    """Encounters whose type belongs to the form with an external key."""
    forms = t.form.filter(F.col("uuid") == uuid)
    return semi_lookup(t.encounter, "encounter_type", forms, "encounter_type")


def hospital_numbers(t: Tables, patients: DataFrame | None = None) -> DataFrame:
    """patient_id, identifier; a patient may have several."""
    ids = live(t.patient_identifier).filter(
        F.col("identifier_type") == codes.HOSPITAL_NUMBER_TYPE
    )
    return within(ids, "patient_id", patients).select("patient_id", "identifier")


def one_hospital_number(t: Tables, patients: DataFrame | None = None) -> DataFrame:
    """The smallest hospital number of each patient, for reports with a row per encounter."""
    ids = hospital_numbers(t, patients)
    return ids.groupBy("patient_id").agg(F.min("identifier").alias("identifier"))


def people(t: Tables, patients: DataFrame | None = None, alive: bool = False) -> DataFrame:
    """patient_id, birthdate and gender of people on record."""
    found = live(t.person)
    if alive:
        found = found.filter(F.col("dead") == 0)
    found = found.select(F.col("person_id").alias("patient_id"), "birthdate", "gender")
    return within(found, "patient_id", patients)


def person_names(t: Tables, patients: DataFrame | None = None) -> DataFrame:
    """patient_id and name parts; a person may have several names."""
    names = live(t.person_name).select(
        F.col("person_id").alias("patient_id"), "given_name", "middle_name", "family_name"
    )
    return within(names, "patient_id", patients)


def one_full_name(
    t: Tables, alias: str, parts: Sequence[str | Column], patients: DataFrame | None = None
) -> DataFrame:
    """The smallest full name of each person, for reports with a row per encounter."""
    names = person_names(t, patients)
    full = F.concat_ws(" ", *parts)
    return names.groupBy("patient_id").agg(F.min(full).alias(alias))


def with_full_name(
    t: Tables, df: DataFrame, person: str, alias: str, parts: Sequence[str | Column]
) -> DataFrame:
    """Join the smallest full name to few rows, reading the names of their persons only.

    People without a name on record drop out.
    """
    names = person_names(t).select(
        F.col("patient_id").alias(person), F.concat_ws(" ", *parts).alias("_name")
    )
    return df.join(names, person).groupBy(*df.columns).agg(F.min("_name").alias(alias))


def notes(t: Tables, encounters: DataFrame | None = None) -> DataFrame:
    """One note per encounter: the one recorded first."""
    found = live(t.obs).filter(F.col("concept_id") == codes.NOTES)
    found = within(found, "encounter_id", encounters)
    return pick_first(found, ["encounter_id"], "obs_id", {"notes": "value_text"})


def bookings(
    t: Tables,
    booking_encounters: DataFrame | None = None,
    patients: DataFrame | None = None,
    filtered: bool = False,
) -> DataFrame:
    """One row per booking encounter: surgeon, appointment and operation.

    Observations are pivoted before they meet the encounters; where only some
    patients are asked for, just their bookings are read. ``filtered`` drops observations
    of other encounters by a filter of bits before they are shuffled. Of several names of a
    surgeon the smallest is taken.
    """
    if booking_encounters is None:
        booking_encounters = t.encounter.filter(F.col("encounter_type") == codes.BOOKING_TYPE)
    booked = live(booking_encounters).select(
        "encounter_id", "patient_id", "encounter_datetime", "creator"
    )
    booked = within(booked, "patient_id", patients)

    is_operation = F.col("concept_id") == codes.OPERATION
    asked = t.obs.filter((F.col("concept_id") == codes.APPOINTMENT_DATE) | is_operation)
    asked = within(asked, "encounter_id", booked if patients is not None else None)
    if filtered:
        asked = maybe_within(asked, "encounter_id", booked, **WIDE)
    operation_code = F.when(is_operation, F.col("value_coded"))
    name = with_frequent_name if filtered else with_name
    obs = name(asked, operation_code, display_names(t), spread_by="encounter_id")
    wide = eav_pivot(
        obs,
        ["encounter_id"],
        {
            "Appointment_Date": (codes.APPOINTMENT_DATE, "value_datetime"),
            "Operation": (codes.OPERATION, "name"),
        },
    )
    creators = booked.select("creator").distinct() if patients is not None else None
    surgeons = (
        within(t.person_name.withColumnRenamed("person_id", "creator"), "creator", creators)
        .groupBy("creator")
        .agg(F.min(F.concat("given_name", F.lit(" "), "family_name")).alias("Surgeon"))
    )
    return (
        booked.join(wide, "encounter_id")
        .join(surgeons, "creator")
        .select(
            "encounter_id",
            "patient_id",
            "Surgeon",
            "encounter_datetime",
            "Appointment_Date",
            "Operation",
            "creator",
        )
    )


def appointments(t: Tables) -> tuple[DataFrame, list[str], str]:
    """What to count in place of bookings, which have one appointment or more: see `interval_join`."""
    asked = t.obs.filter(F.col("concept_id") == codes.APPOINTMENT_DATE)
    return asked.select("person_id", "value_datetime"), ["person_id"], "value_datetime"


def patients_of(df: DataFrame) -> DataFrame:
    """The distinct patients of a table, to restrict others by."""
    return df.select("patient_id").distinct()


def booking_side(booked: DataFrame) -> DataFrame:
    """Bookings as the right side of an interval join: no name shared with an encounter."""
    return booked.select(
        F.col("encounter_id").alias("booking_id"),
        F.col("patient_id").alias("booking_patient"),
        "Surgeon",
        "Appointment_Date",
        "Operation",
    )


def _rank_groups(named: DataFrame, carry: Sequence[str], few: bool) -> DataFrame:
    """Ranks by parsing each group's comma list, as the reports define it.

    The list runs from the latest observation to the earliest. A rank word
    beyond its second place, or a comma in a name, is parsed as it stands.
    """
    groups = list_ends(
        named, _GROUP, "name", ["obs_id", "name"], descending=True, carry=carry, few=few
    ).withColumn("diag", comma_text())
    return groups.select(
        "encounter_id",
        *carry,
        ranked_member("Primary", "diag").alias("_primary"),
        ranked_member("Secondary", "diag").alias("_secondary"),
    )


def _rank_members(named: DataFrame, carry: Sequence[str], few: bool) -> DataFrame:
    """Ranks by membership: the rank word of a group, and its other member."""
    other = F.min(F.when(~F.col("name").isin("Primary", "Secondary"), F.col("name")))
    groups = named.groupBy(*_GROUP).agg(
        *(F.max(c).alias(c) for c in carry),
        other.alias("_other"),
        *(F.bool_or(F.col("name") == rank).alias(rank) for rank in ("Primary", "Secondary")),
    )
    return groups.select(
        "encounter_id",
        *carry,
        F.when(F.col("Primary"), F.col("_other")).alias("_primary"),
        F.when(F.col("Secondary"), F.col("_other")).alias("_secondary"),
    )


def diagnosis_ranks(
    t: Tables,
    encounters: DataFrame,
    parse: str = "list",
    carry: Sequence[str] = (),
    few: bool = False,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Per encounter, the distinct Primary and Secondary diagnoses of its groups.

    A group holds a diagnosis and a rank word. ``parse`` reads the rank from the
    group's comma ``list``, as the reports do, or from its ``members``, which
    also copes with commas and longer groups. ``few`` as in `list_ends`: few observations
    are restricted to the encounters before they are named. Many pass a filter of bits, are
    named and meet the encounters then, so that the shuffle for that serves all later steps.
    ``carry`` names columns of
    ``encounters`` to keep (of repeated rows, the largest value). They go along with
    few rows; else they are joined to the result, so that they are not shuffled with
    every member. ``asked`` has the encounters whose row is wanted, where that are fewer.
    """
    along = [*carry] if few else []
    members = t.obs.filter(
        F.col("obs_group_id").isNotNull() & (F.col("concept_id") != codes.GROUP_EXCLUDED)
    ).select(*_GROUP, "person_id", "obs_id", "value_coded")
    met = encounters.select("encounter_id", *along)
    if few:
        members = members.join(met, "encounter_id")
    else:
        members = maybe_within(members, "encounter_id", encounters if asked is None else asked, **WIDE)
    name = with_name if few else with_frequent_name
    named = name(members, F.col("value_coded"), display_names(t), spread_by="obs_group_id")
    if not few:
        named = named.join(met, "encounter_id")
    kept = ["person_id", *along]
    ranked = {"list": _rank_groups, "members": _rank_members}[parse](named, kept, few)
    found = distinct_concat(
        ranked,
        ["encounter_id"],
        {"Primary": "_primary", "Secondary": "_secondary"},
        carry=kept,
    )
    if along or not carry:
        return found
    carried = encounters.groupBy("encounter_id").agg(*(F.max(c).alias(c) for c in carry))
    return found.join(carried, "encounter_id").select(
        "encounter_id", "person_id", *carry, "Primary", "Secondary"
    )


def diagnosis_slots(
    t: Tables, encounters: DataFrame, named: bool = True, few: bool = False
) -> DataFrame:
    """The encounters with a diagnosis, and their first, second and last one.

    ``encounters`` has `encounter_id` and `patient_id`, which both must agree
    with the observation, and columns to keep. Diagnoses are names, empty where
    missing; or codes, null where missing. ``few`` as in `list_ends`.
    """
    keys = ["encounter_id", "patient_id"]
    carry = [c for c in encounters.columns if c not in keys]
    found = (
        t.obs.filter(F.col("concept_id") == codes.DIAGNOSIS)
        .select("encounter_id", F.col("person_id").alias("patient_id"), "obs_id", "value_coded")
        .join(encounters, keys)
    )
    if named:
        found = with_name(found, F.col("value_coded"), display_names(t), spread_by="encounter_id")
        ends = list_ends(found, keys, "name", ["obs_id", "name"], carry=carry, few=few)
        slots = [F.coalesce(end, F.lit("")) for end in ("first", "second", "last")]
    else:
        ends = list_ends(
            found, keys, "value_coded", ["obs_id", "value_coded"], carry=carry, few=few
        )
        slots = [F.col(end) for end in ("first", "second", "last")]
    return ends.select(
        *encounters.columns, *(s.alias(f"dx{i}") for i, s in enumerate(slots, 1))
    )


def discharges(t: Tables, patients: DataFrame | None = None) -> DataFrame:
    """Every discharge: patient, visit and day."""
    left = t.encounter.filter(F.col("encounter_type") == codes.DISCHARGE_TYPE)
    left = within(left, "patient_id", patients)
    return left.select(
        "patient_id", "visit_id", F.to_date("encounter_datetime").alias("date_of_discharge")
    )


def payment_totals(
    t: Tables, charged: DataFrame | None = None, maybe: DataFrame | None = None
) -> DataFrame:
    """One row per charge: amounts by payment mode, their sum, and the latest day.

    ``charged`` limits the payments that are read to its charges; ``maybe`` does so by a
    filter of bits, which leaves some others in.
    """
    paid = within(t.payment, "charges_id", charged)
    return mode_pivot(
        paid if maybe is None else maybe_within(paid, "charges_id", maybe, **WIDE),
        "charges_id",
        "mode_of_payment_id",
        "amount_paid",
        codes.PAYMENT_MODES,
        "Total_Paid",
        extra=(
            F.max(F.to_date("payment_date")).alias("payment_date"),
            F.min("charge_account_id").alias("charge_account_id"),
        ),
    )
