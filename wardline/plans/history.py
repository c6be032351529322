"""Statistics over all years, kept as partial counts and extended by new files only.

Counts per quarter can be added, so each batch of new encounters is counted once, and its
counts are a folder of their own. Reading all folders and adding them gives what a run over all
encounters would; a batch that is counted again replaces its own folder. Counts keep what later
questions ask about: both diagnosis families, visit type and age of visits; code and birth
date of operations, whose age depends on the day of the report. Their number is bounded by
these values and by the quarters, not by the visits.

A batch must hold all observations of its encounters, and no encounter may be in two batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import age_years, any_of
from wardline.operators.aggregates import half_year_counts, one_row_statistic
from wardline.plans import cohorts, parts
from wardline.sources.tables import Tables

VISIT_KEYS = ("year", "quarter", "hydrocephalus", "spina_bifida", "visit_type", "age")
OPERATION_KEYS = ("year", "quarter", "code", "birthdate")

_FLAG = {codes.HYDROCEPHALUS: "hydrocephalus", codes.SPINA_BIFIDA: "spina_bifida"}
_SLOTS = ("dx1", "dx2", "dx3")


def visit_counts(t: Tables) -> DataFrame:
    """Visits with a diagnosis, counted by `VISIT_KEYS`; the type is null where none is recorded."""
    visits = cohorts.labelled_visits(t)
    typed = visits.join(cohorts.visit_types(t), ["encounter_id", "patient_id"], "left")
    return (
        typed.select(
            F.year("encounter_datetime").alias("year"),
            F.quarter("encounter_datetime").alias("quarter"),
            *(F.coalesce(any_of(_SLOTS, label), F.lit(False)).alias(name) for label, name in _FLAG.items()),
            "visit_type",
            "age",
        )
        .groupBy(*VISIT_KEYS)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def operation_counts(t: Tables) -> DataFrame:
    """Operations, counted by `OPERATION_KEYS`."""
    coded = t.obs.filter((F.col("concept_id") == codes.OPERATION) & F.col("value_coded").isNotNull())
    per_encounter = coded.groupBy("encounter_id", F.col("value_coded").alias("code")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    encounters = parts.encounters_by_type_key(t, codes.SURGERY_TYPE_UUID).select(
        "encounter_id", "patient_id", "encounter_datetime"
    )
    people = parts.people(t).select("patient_id", "birthdate")
    return (
        encounters.join(per_encounter, "encounter_id")
        .join(people, "patient_id")
        .groupBy(
            F.year("encounter_datetime").alias("year"),
            F.quarter("encounter_datetime").alias("quarter"),
            "code",
            "birthdate",
        )
        .agg(F.sum("_n").alias("n"))
    )


def merged(*counts: DataFrame) -> DataFrame:
    """Counts of several batches as one: equal keys are added."""
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return every.groupBy(*(c for c in every.columns if c != "n")).agg(F.sum("n").alias("n"))


class History:
    """Counts of all batches so far, below a folder that all executors share."""

    _KINDS = {"visits": visit_counts, "operations": operation_counts}

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def extend(self, batch: str, t: Tables) -> None:
        """Count the encounters of ``t``, a batch; one of the same name is replaced."""
        for kind, count in self._KINDS.items():
            count(t).write.mode("overwrite").parquet(f"{self._root}/{kind}/batch={batch}")

    def _read(self, kind: str) -> DataFrame:
        return merged(self._spark.read.parquet(f"{self._root}/{kind}").drop("batch"))

    def visits(self) -> DataFrame:
        return self._read("visits")

    def operations(self) -> DataFrame:
        return self._read("operations")


def visit_statistic(
    visits: DataFrame,
    seen_with: str,
    never_with: str | None = None,
    visit_type: str | None = None,
    max_age: int = 15,
    wrap: bool = False,
    combine: str = "min",
    year: int | None = None,
) -> DataFrame:
    """As `cohorts.visit_statistic`, from counts."""
    kept = visits.filter(F.col(_FLAG[seen_with]) & (F.col("age") < max_age))
    if never_with is not None:
        kept = kept.filter(~F.col(_FLAG[never_with]))
    if visit_type is not None:
        kept = kept.filter(F.col("visit_type") == visit_type)
    if year is not None:
        kept = kept.filter(F.col("year") == year)
    quarters = half_year_counts(kept, F.col("quarter"), F.col("n"))
    return one_row_statistic(quarters, combine) if wrap else quarters


def operation_statistic(
    operations: DataFrame,
    family: Sequence[int],
    as_of: dt.date,
    max_age: int = 15,
    combine: str = "min",
    year: int | None = None,
) -> DataFrame:
    """As `cohorts.operation_statistic`, from counts."""
    kept = operations.filter(F.col("code").isin(*family))
    kept = kept.filter(age_years(F.lit(as_of), "birthdate") < max_age)
    if year is not None:
        kept = kept.filter(F.col("year") == year)
    return one_row_statistic(half_year_counts(kept, F.col("quarter"), F.col("n")), combine)


def page(visits: DataFrame, operations: DataFrame, as_of: dt.date, max_age: int = 15) -> DataFrame:
    """The whole statistic, a row per year and quarter that has anything to count."""
    a, b = F.col("hydrocephalus") & ~F.col("spina_bifida"), F.col("spina_bifida")
    child = F.col("age") < max_age

    def visits_with(family, label=None):
        asked = child & family if label is None else child & family & (F.col("visit_type") == label)
        return F.sum(F.when(asked, F.col("n")).otherwise(0))

    figures = {
        "a_seen": visits_with(a),
        "a_new": visits_with(a, "Initial"),
        "a_followup": visits_with(a, "Followup"),
        "b_seen": visits_with(b),
        "b_new": visits_with(b, "Initial"),
        "b_followup": visits_with(b, "Followup"),
    }
    seen = visits.groupBy("year", "quarter").agg(*(f.alias(name) for name, f in figures.items()))
    young = age_years(F.lit(as_of), "birthdate") < max_age
    families = {
        "a_operations": codes.HYDROCEPHALUS_OPERATIONS,
        "shunts": codes.SHUNT_TOTAL,
        "shunt_revisions": codes.SHUNT_REVISIONS,
        "etv": codes.ETV,
    }
    operated = operations.groupBy("year", "quarter").agg(
        *(
            F.sum(F.when(young & F.col("code").isin(*family), F.col("n")).otherwise(0)).alias(name)
            for name, family in families.items()
        )
    )
    both = seen.join(operated, ["year", "quarter"], "full")
    return both.select(
        "year", "quarter", *(F.coalesce(c, F.lit(0)).alias(c) for c in [*figures, *families])
    )
