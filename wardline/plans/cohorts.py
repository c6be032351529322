"""Cohort listings and half-year statistics by code family."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import (
    age_years,
    any_of,
    classify,
    in_year,
    label_code,
    none_of,
    up_to_day,
)
from wardline.operators.aggregates import half_year_counts, one_row_statistic, pick_first
from wardline.plans import parts
from wardline.sources.tables import Tables

_SLOTS = ("dx1", "dx2", "dx3")


def cohort_listing(
    t: Tables, type_uuid: str, concept: int, family: Sequence[int], as_of: dt.date | None = None
) -> DataFrame:
    """Observations of one concept with a code of the family, at one kind of encounter.

    With ``as_of`` the birth date and the age on that day are added.
    """
    seen = parts.encounters_by_type_key(t, type_uuid).select(
        "patient_id",
        "encounter_id",
        "encounter_type",
        "encounter_datetime",
        "location_id",
    )
    coded = t.obs.filter(
        (F.col("concept_id") == concept) & F.col("value_coded").isin(*family)
    ).select("encounter_id", "concept_id", "value_coded")
    listed = seen.join(coded, "encounter_id").join(
        parts.people(t).select("patient_id", "birthdate"), "patient_id"
    )
    columns = [
        "patient_id",
        "encounter_id",
        "encounter_type",
        "encounter_datetime",
        "location_id",
        "concept_id",
        "value_coded",
    ]
    if as_of is not None:
        columns += ["birthdate", age_years(F.lit(as_of), "birthdate").alias("age")]
    return listed.select(*columns)


def labelled_visits(t: Tables, max_age: int | None = None, year: int | None = None) -> DataFrame:
    """Visits with their diagnosis slots as family labels, and the age at the visit."""
    encounters = parts.encounters_by_type_key(t, codes.NEURO_TYPE_UUID).select(
        "encounter_id", "patient_id", "encounter_datetime"
    )
    if year is not None:
        encounters = encounters.filter(in_year("encounter_datetime", year))
    people = parts.people(t).select("patient_id", "birthdate")
    aged = encounters.join(people, "patient_id").select(
        "encounter_id",
        "patient_id",
        "encounter_datetime",
        age_years("encounter_datetime", "birthdate").alias("age"),
    )
    # Visits of others are dropped before their diagnoses are read.
    if max_age is not None:
        aged = aged.filter(F.col("age") < max_age)
    return parts.diagnosis_slots(t, aged, named=False).select(
        "encounter_id",
        "patient_id",
        "encounter_datetime",
        "age",
        *(classify(slot, codes.DX_FAMILIES).alias(slot) for slot in _SLOTS),
    )


def visit_types(t: Tables) -> DataFrame:
    """encounter_id, patient_id and the label of the first recorded visit type."""
    keys = ["encounter_id", "patient_id"]
    asked = t.obs.filter(F.col("concept_id") == codes.VISIT_TYPE).withColumnRenamed(
        "person_id", "patient_id"
    )
    typed = pick_first(asked, keys, ["obs_id", "value_coded"], {"_answer": "value_coded"})
    label = label_code("_answer", codes.VISIT_TYPE_LABELS, codes.VISIT_TYPE_DEFAULT)
    return typed.select(*keys, label.alias("visit_type"))


def family_visits(
    t: Tables,
    seen_with: str,
    never_with: str | None = None,
    visit_type: str | None = None,
    max_age: int = 15,
    year: int | None = None,
) -> DataFrame:
    """Visits of children with a diagnosis slot of one family and none of another."""
    kept = labelled_visits(t, max_age, year).filter(any_of(_SLOTS, seen_with))
    if never_with is not None:
        kept = kept.filter(none_of(_SLOTS, never_with))
    if visit_type is not None:
        keys = ["encounter_id", "patient_id"]
        typed = visit_types(t).filter(F.col("visit_type") == visit_type)
        kept = kept.join(typed.select(*keys), keys)
    return kept


def visit_statistic(
    t: Tables,
    seen_with: str,
    never_with: str | None = None,
    visit_type: str | None = None,
    max_age: int = 15,
    wrap: bool = False,
    combine: str = "min",
    year: int | None = None,
) -> DataFrame:
    """Visits of children by half-year, one row per quarter of any year.

    A visit counts when one of its diagnosis slots is of the family
    ``seen_with`` and none is of ``never_with``. ``visit_type`` asks for the
    first recorded visit type. ``wrap`` gives one row, combining the quarters
    (see `one_row_statistic`). Age is that at the visit.
    """
    kept = family_visits(t, seen_with, never_with, visit_type, max_age, year)
    quarters = half_year_counts(
        kept, F.quarter("encounter_datetime"), F.lit(1), F.col("patient_id")
    )
    return one_row_statistic(quarters, combine) if wrap else quarters


def children_seen(
    t: Tables,
    seen_with: str,
    never_with: str | None = None,
    visit_type: str | None = None,
    max_age: int = 15,
    year: int | None = None,
) -> DataFrame:
    """Children with a visit as in `visit_statistic`, per year: each counts once per column.

    A child seen in both half-years counts in both and once in the total, so visits are
    reduced to a row per year and child before they are counted.
    """
    kept = family_visits(t, seen_with, never_with, visit_type, max_age, year)
    first_half = F.quarter("encounter_datetime") <= 2
    children = kept.groupBy(F.year("encounter_datetime").alias("year"), "patient_id").agg(
        F.bool_or(first_half).alias("_first"), F.bool_or(~first_half).alias("_second")
    )
    return children.groupBy("year").agg(
        F.count_if("_first").alias("jan_jun"),
        F.count_if("_second").alias("jul_dec"),
        F.count(F.lit(1)).alias("total"),
    )


def first_interventions(
    t: Tables,
    family: Sequence[int],
    as_of: dt.date,
    start_date: dt.date | None = None,
    end_date: dt.date | None = None,
    max_age: int | None = None,
) -> DataFrame:
    """Each patient's first operation of a code family, if it falls into the period.

    The first one is found over all years and only then compared with the period, so that a
    patient operated on before it does not count as new. Per patient one
    operation is held while partial results are merged. Of operations at one time
    the one with the smallest encounter and code is first; operations without a time have no
    place. Age is that on the day ``as_of``.
    """
    coded = t.obs.filter(
        (F.col("concept_id") == codes.OPERATION) & F.col("value_coded").isin(*family)
    )
    operated = parts.encounters_by_type_key(t, codes.SURGERY_TYPE_UUID).filter(
        F.col("encounter_datetime").isNotNull()
    )
    events = operated.select("encounter_id", "patient_id", "encounter_datetime").join(
        coded.groupBy("encounter_id").agg(F.min("value_coded").alias("value_coded")), "encounter_id"
    )
    first = events.groupBy("patient_id").agg(
        F.min(F.struct("encounter_datetime", "encounter_id", "value_coded")).alias("_first")
    )
    listed = first.select("patient_id", "_first.*")
    if start_date is not None:
        listed = listed.filter(F.col("encounter_datetime") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        listed = listed.filter(up_to_day("encounter_datetime", end_date))
    people = parts.people(t).select("patient_id", "birthdate")
    aged = listed.join(people, "patient_id").withColumn("age", age_years(F.lit(as_of), "birthdate"))
    return aged if max_age is None else aged.filter(F.col("age") < max_age)


def first_intervention_statistic(
    t: Tables, family: Sequence[int], as_of: dt.date, max_age: int = 15
) -> DataFrame:
    """Children's first operations of a code family, per year and half-year."""
    listed = first_interventions(t, family, as_of, max_age=max_age)
    first_half = F.quarter("encounter_datetime") <= 2
    return listed.groupBy(F.year("encounter_datetime").alias("year")).agg(
        F.count_if(first_half).alias("jan_jun"),
        F.count_if(~first_half).alias("jul_dec"),
        F.count(F.lit(1)).alias("total"),
    )


def operation_statistic(
    t: Tables,
    family: Sequence[int],
    as_of: dt.date,
    max_age: int = 15,
    combine: str = "min",
    year: int | None = None,
) -> DataFrame:
    """Operations of a code family on children, by half-year, in one row.

    Age is that on the day ``as_of``, not at the operation. Observations are
    counted per encounter before they meet the encounters.
    """
    coded = t.obs.filter(
        (F.col("concept_id") == codes.OPERATION) & F.col("value_coded").isin(*family)
    )
    counts = coded.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("_n"))
    encounters = parts.encounters_by_type_key(t, codes.SURGERY_TYPE_UUID).select(
        "encounter_id", "patient_id", "encounter_datetime"
    )
    if year is not None:
        encounters = encounters.filter(in_year("encounter_datetime", year))
    young = (
        parts.people(t)
        .filter(age_years(F.lit(as_of), "birthdate") < max_age)
        .select("patient_id")
    )
    counted = encounters.join(counts, "encounter_id").join(young, "patient_id")
    quarters = half_year_counts(
        counted, F.quarter("encounter_datetime"), F.col("_n"), F.col("patient_id")
    )
    return one_row_statistic(quarters, combine)
