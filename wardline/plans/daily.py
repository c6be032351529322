"""Daily lists and the open-stay census."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import codes
from wardline.functions.columns import age_years, days_since, on_day, up_to_day
from wardline.operators.joins import PIECE_ROWS, interval_join, left_join_many, within
from wardline.plans import parts
from wardline.sources.tables import Tables

_NAME_PARTS = ("family_name", "middle_name", "given_name")


def _admissions(t: Tables, day: dt.date | None) -> DataFrame:
    """Admission encounters that are not soft-deleted, of one day or of all."""
    found = parts.live(parts.encounters_by_type_key(t, codes.ADMISSION_TYPE_UUID))
    if day is not None:
        found = found.filter(on_day("encounter_datetime", day))
    return found.select("encounter_id", "patient_id", "encounter_datetime")


def _earliest_booking():
    """The booking with the earliest appointment, as one value; null where there is none."""
    return F.min(
        F.when(
            F.col("booking_id").isNotNull(),
            F.struct("Appointment_Date", "booking_id", "Surgeon", "Operation"),
        )
    ).alias("_booking")


def _next_operation(
    t: Tables, day: DataFrame, patients: DataFrame | None, effective_date: dt.date | None
) -> DataFrame:
    """patient_id, _day, DoO: the first operation date on or after each day of admission.

    Days of admission and of operation are made distinct and put on one line per
    patient, so a patient costs at most two rows a day and no pairs are compared.
    """
    operations = parts.live(t.obs).filter(F.col("concept_id") == codes.OPERATION_DATE)
    if effective_date is not None:
        start = F.lit(dt.datetime.combine(effective_date, dt.time())).cast("timestamp_ntz")
        operations = operations.filter(F.col("value_datetime") >= start)
    operations = operations.select(
        F.col("person_id").alias("patient_id"), F.to_date("value_datetime").alias("_day")
    )
    operated = within(operations, "patient_id", patients).distinct()
    admitted = day.select("patient_id", F.to_date("encounter_datetime").alias("_day")).distinct()
    line = operated.withColumn("_operated", F.col("_day")).unionByName(
        admitted.withColumn("_operated", F.lit(None).cast("date"))
    )
    from_here = (
        Window.partitionBy("patient_id")
        .orderBy(F.desc("_day"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    dated = line.withColumn("DoO", F.min("_operated").over(from_here))
    return dated.filter(F.col("_operated").isNull()).select("patient_id", "_day", "DoO")


def daily_list_ranked(t: Tables, effective_date: dt.date | None, as_of: dt.date) -> DataFrame:
    """Admissions of a day with ranked diagnoses and the next date of operation.

    One row per patient and encounter; of several names or hospital numbers the
    smallest is shown. The operation date is the earliest on or after the day of
    admission. Without a date, the admissions of every day.
    """
    day = _admissions(t, effective_date)
    narrow = effective_date is not None
    patients = parts.patients_of(day) if narrow else None
    # The person shown is the one the diagnoses were recorded for.
    diagnoses = parts.diagnosis_ranks(
        t, day, carry=["patient_id", "encounter_datetime"], few=narrow
    )
    persons = parts.people(t).withColumnRenamed("patient_id", "person_id")
    seen = diagnoses.join(persons, "person_id").withColumn("_day", F.to_date("encounter_datetime"))
    return (
        parts.with_full_name(t, seen, "person_id", "patient_name", _NAME_PARTS)
        .join(parts.one_hospital_number(t, patients), "patient_id", "left")
        .join(_next_operation(t, day, patients, effective_date), ["patient_id", "_day"], "left")
        .select(
            "patient_id",
            "encounter_id",
            F.to_date("encounter_datetime").alias("encounterDate"),
            F.col("identifier").alias("KH_Number"),
            "patient_name",
            age_years("encounter_datetime", "birthdate").alias("age"),
            "Primary",
            "Secondary",
            "DoO",
            days_since(as_of, "DoO").alias("num_days"),
        )
    )


def daily_list_linked(t: Tables, effective_date: dt.date | None, as_of: dt.date) -> DataFrame:
    """Admissions that have a diagnosis, a note and a booking within two days.

    One row per patient and encounter, showing the earliest such booking.
    Without a date, the admissions of every day.
    """
    day = _admissions(t, effective_date)
    narrow = effective_date is not None
    patients = parts.patients_of(day) if narrow else None
    booked = parts.booking_side(parts.bookings(t, patients=patients))
    first_booking = (
        interval_join(
            day, booked, [("patient_id", "booking_patient")], "encounter_datetime", "Appointment_Date"
        )
        .groupBy("encounter_id", "patient_id", "encounter_datetime")
        .agg(_earliest_booking())
    )
    persons = parts.people(t).withColumnRenamed("patient_id", "person_id")
    appointment = F.to_date("_booking.Appointment_Date")
    seen = (
        first_booking.join(parts.diagnosis_ranks(t, day, few=narrow), "encounter_id")
        .join(parts.notes(t, day if narrow else None), "encounter_id")
        .join(persons, "person_id")
    )
    return (
        parts.with_full_name(t, seen, "person_id", "patient_name", _NAME_PARTS)
        .join(parts.one_hospital_number(t, patients), "patient_id", "left")
        .select(
            "patient_id",
            "encounter_id",
            F.to_date("encounter_datetime").alias("encounterDate"),
            F.col("identifier").alias("KH_Number"),
            "patient_name",
            age_years("encounter_datetime", "birthdate").alias("age"),
            "Primary",
            "Secondary",
            appointment.alias("DoO"),
            F.col("_booking.Surgeon").alias("Surgeon"),
            F.col("_booking.Operation").alias("Operation"),
            "notes",
            days_since(as_of, appointment).alias("num_days"),
        )
    )


def daily_list_slots(t: Tables, effective_date: dt.date | None, as_of: dt.date) -> DataFrame:
    """Admissions of a day with three diagnosis slots, booking and note.

    Not grouped: several names, hospital numbers or bookings give several rows.
    Without a date, the admissions of every day.
    """
    day = parts.live(parts.encounters_by_form_key(t, codes.ADMISSION_FORM_UUID))
    if effective_date is not None:
        day = day.filter(on_day("encounter_datetime", effective_date))
    day = day.select("encounter_id", "patient_id", "encounter_datetime")
    narrow = effective_date is not None
    patients = parts.patients_of(day) if narrow else None

    booked = parts.bookings(
        t, parts.encounters_by_form_key(t, codes.BOOKING_FORM_UUID), patients=patients
    )
    booked = parts.booking_side(booked)
    linked = interval_join(
        parts.diagnosis_slots(t, day, few=narrow),
        booked,
        [("patient_id", "booking_patient")],
        "encounter_datetime",
        "Appointment_Date",
        how="left",
        piece_rows=PIECE_ROWS,
        counted=parts.appointments(t),
    )
    appointment = F.to_date("Appointment_Date")
    called = linked.join(parts.people(t, patients), "patient_id").join(
        parts.person_names(t, patients), "patient_id"
    )
    numbers = parts.hospital_numbers(t, patients)
    return (
        left_join_many(called, numbers, ["patient_id"], among=day)
        .join(parts.notes(t, day if narrow else None), "encounter_id", "left")
        .select(
            "patient_id",
            "encounter_id",
            F.to_date("encounter_datetime").alias("doa"),
            F.col("identifier").alias("KH_Number"),
            F.concat_ws(" ", *_NAME_PARTS).alias("patient_name"),
            age_years("encounter_datetime", "birthdate").alias("age"),
            F.col("dx1").alias("primary"),
            F.col("dx2").alias("secondary"),
            "dx3",
            appointment.alias("DoO"),
            "Surgeon",
            F.col("Operation").alias("operation"),
            days_since(as_of, appointment).alias("num_days"),
            "notes",
        )
    )


def open_stays(t: Tables, effective_date: dt.date, as_of: dt.date) -> DataFrame:
    """Stays open on a day: not stopped, or without a discharge.

    One row per patient and visit. Of several admissions in a visit the first
    is shown, with the earliest booking of them all.
    """
    admitted = (
        parts.encounters_by_type_key(t, codes.ADMISSION_TYPE_UUID)
        .filter(F.col("visit_id").isNotNull())
        .filter(up_to_day("encounter_datetime", effective_date))
        .select("encounter_id", "patient_id", "visit_id", "encounter_datetime", "voided")
    )
    visits = parts.live(t.visit).select("visit_id", "date_stopped")
    left = (
        parts.discharges(t)
        .groupBy("visit_id", "patient_id")
        .agg(F.min("date_of_discharge").alias("date_of_discharge"))
    )
    still_open = (
        admitted.join(visits, "visit_id")
        .join(left, ["visit_id", "patient_id"], "left")
        .filter(F.col("date_stopped").isNull() | F.col("date_of_discharge").isNull())
    )
    # What the stays do not need is not read: first which they are, then the rest for them.
    shown = still_open.groupBy("patient_id", "visit_id").agg(
        F.min("encounter_id").alias("encounter_id"),
        F.min_by("voided", "encounter_id").alias("voided"),
    )
    patients = parts.patients_of(shown)
    stays = (
        interval_join(
            still_open.drop("voided"),
            parts.booking_side(parts.bookings(t, patients=patients)),
            [("patient_id", "booking_patient")],
            "encounter_datetime",
            "Appointment_Date",
            how="left",
            piece_rows=PIECE_ROWS,
            counted=parts.appointments(t),
        )
        .groupBy("patient_id", "visit_id")
        .agg(
            F.min("encounter_id").alias("encounter_id"),
            F.min_by("encounter_datetime", "encounter_id").alias("encounter_datetime"),
            F.min("date_stopped").alias("date_stopped"),
            F.min("date_of_discharge").alias("date_of_discharge"),
            _earliest_booking(),
        )
    )
    diagnoses = parts.diagnosis_ranks(t, parts.live(shown), few=True).select(
        "encounter_id", "Primary", "Secondary"
    )
    appointment = F.to_date("_booking.Appointment_Date")
    return (
        stays.join(parts.people(t, patients, alive=True), "patient_id")
        .join(parts.one_full_name(t, "patient_name", _NAME_PARTS, patients), "patient_id")
        .join(parts.one_hospital_number(t, patients), "patient_id", "left")
        .join(diagnoses, "encounter_id", "left")
        .join(parts.notes(t, shown), "encounter_id", "left")
        .select(
            "patient_id",
            "encounter_id",
            "visit_id",
            "date_stopped",
            F.to_date("encounter_datetime").alias("doa"),
            F.col("identifier").alias("KH_Number"),
            "patient_name",
            age_years("encounter_datetime", "birthdate").alias("age"),
            F.col("Primary").alias("primary"),
            F.col("Secondary").alias("secondary"),
            appointment.alias("DoO"),
            F.col("_booking.Surgeon").alias("Surgeon"),
            F.col("_booking.Operation").alias("operation"),
            "date_of_discharge",
            "notes",
            days_since(as_of, appointment).alias("num_days"),
        )
    )


def census(t: Tables, first_day: dt.date, last_day: dt.date, as_recorded: bool = True) -> DataFrame:
    """How many stays are open on each day of a period: `open_stays` for every day at once.

    Stays start and end, so a day's figure is the sum of all changes up to it: each stay
    is read once, as a change on its first day and one on its last. What came before the
    period counts on its first day. ``as_recorded`` asks as `open_stays` does, by what is open on
    record now; otherwise a closed stay counts from its admission until the later one of
    its stop and its discharge.
    """
    # One row per patient and visit, as in `open_stays`, from the first admission on.
    starts = (
        parts.encounters_by_type_key(t, codes.ADMISSION_TYPE_UUID)
        .filter(F.col("visit_id").isNotNull())
        .groupBy("patient_id", "visit_id")
        .agg(F.min(F.to_date("encounter_datetime")).alias("_start"))
    )
    left = (
        parts.discharges(t)
        .groupBy("visit_id", "patient_id")
        .agg(F.min("date_of_discharge").alias("_left"))
    )
    stays = (
        starts.join(parts.live(t.visit).select("visit_id", "date_stopped"), "visit_id")
        .join(left, ["visit_id", "patient_id"], "left")
        .join(parts.people(t, alive=True).select("patient_id"), "patient_id")
        .join(parts.person_names(t).select("patient_id").distinct(), "patient_id")
    )
    stopped = F.to_date("date_stopped")
    closed = F.when(stopped.isNotNull() & F.col("_left").isNotNull(), F.greatest(stopped, "_left"))
    if as_recorded:
        stays, closed = stays.filter(closed.isNull()), F.lit(None).cast("date")
    first, ended = F.lit(first_day), F.when(closed.isNotNull(), F.greatest(closed, "_start"))
    both = [(F.col("_start"), 1), (ended, -1)]
    changes = (
        stays.select(
            F.inline(F.array(*(F.struct(d.alias("day"), F.lit(n).alias("n")) for d, n in both)))
        )
        .filter(F.col("day") <= F.lit(last_day))
        .groupBy(F.greatest("day", first).alias("day"))
        .agg(F.sum("n").alias("n"))
    )
    # Prefix sums in two levels: months over all of them, days within their month.
    length = (last_day - first_day).days + 1
    days = t.visit.sparkSession.range(length).select(F.date_add(first, F.col("id").cast("int")).alias("day"))
    daily = days.join(changes, "day", "left").select(
        "day", F.trunc("day", "MM").alias("_month"), F.coalesce("n", F.lit(0)).alias("n")
    )
    earlier = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = (
        daily.groupBy("_month")
        .agg(F.sum("n").alias("_n"))
        .select("_month", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within_month = Window.partitionBy("_month").orderBy("day")
    return daily.join(months, "_month").select(
        "day", (F.col("_before") + F.sum("n").over(within_month)).alias("n_open")
    )
