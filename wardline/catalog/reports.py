"""The reports over the derived base tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardline.catalog.basics import AS_OF, CENSUS_DAY
from wardline.catalog.registry import report
from wardline.catalog.standin_sql import with_tables
from wardline.functions import codes
from wardline.plans import cohorts, daily, financial, history, operative, parts
from wardline.sources.schemas import COST_COLUMNS
from wardline.sources.tables import ignoring_case, replaced

DAY = dt.date(1998, 3, 2)
YEAR = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))
SURGERY_DAY = dt.date(1998, 10, 3)
SURGERY_PATIENT = 0

# -- steps shared by the SQL --------------------------------------------------

_CN = """,
names AS (SELECT concept_id, name FROM concept_name
          WHERE voided = 0 AND concept_name_type = 'FULLY_SPECIFIED' AND locale = 'en')"""

# Rank words and diagnoses of a group, latest first, as one comma list.
_RANKS = """,
groups AS (
  SELECT o.encounter_id, o.person_id, o.obs_group_id,
         string_split(string_agg(n.name, ',' ORDER BY o.obs_id DESC, n.name DESC), ',') AS items
  FROM obs o
  JOIN encounter e ON e.encounter_id = o.encounter_id AND e.voided = 0 AND e.encounter_type = 15
  LEFT JOIN names n ON n.concept_id = o.value_coded
  WHERE o.obs_group_id IS NOT NULL AND o.concept_id <> 159394
  GROUP BY ALL),
ranked AS (
  SELECT encounter_id, person_id,
         CASE list_position(items, 'Primary') WHEN 1 THEN items[-1] WHEN 2 THEN items[1] END AS p,
         CASE list_position(items, 'Secondary') WHEN 1 THEN items[-1] WHEN 2 THEN items[1] END AS s
  FROM groups),
adm AS (
  SELECT encounter_id, person_id,
         string_agg(DISTINCT p, ', ' ORDER BY p) AS "Primary",
         string_agg(DISTINCT s, ', ' ORDER BY s) AS "Secondary"
  FROM ranked GROUP BY ALL)"""

# The ordered diagnosis list of an encounter, by name.
_SLOTS = """,
listed AS (
  SELECT e.encounter_id, e.patient_id,
         string_split(string_agg(n.name, '|' ORDER BY o.obs_id, n.name), '|') AS items
  FROM encounter e
  JOIN obs o ON o.person_id = e.patient_id AND o.encounter_id = e.encounter_id
  LEFT JOIN names n ON n.concept_id = o.value_coded
  WHERE o.concept_id = 6042 AND e.encounter_type = 15 GROUP BY ALL),
adm AS (
  SELECT encounter_id, patient_id, coalesce(items[1], '') AS dx1, coalesce(items[2], '') AS dx2,
         CASE WHEN len(items) >= 3 THEN items[-1] ELSE '' END AS dx3
  FROM listed)"""

_NOTES = """,
e_notes AS (SELECT encounter_id, arg_min(value_text, obs_id) AS notes
            FROM obs WHERE concept_id = 162169 AND voided = 0 GROUP BY encounter_id)"""

_BOOKED = """,
bk AS (
  SELECT e.encounter_id, e.patient_id, min(d.given_name || ' ' || d.family_name) AS "Surgeon",
         e.encounter_datetime,
         max(CASE WHEN o.concept_id = 5096 THEN o.value_datetime END) AS "Appointment_Date",
         max(CASE WHEN o.concept_id = 1651 THEN n.name ELSE '' END) AS "Operation",
         e.creator
  FROM obs o
  JOIN encounter e ON e.encounter_id = o.encounter_id AND e.voided = 0
  JOIN person_name d ON d.person_id = e.creator
  LEFT JOIN names n ON n.concept_id = o.value_coded
  WHERE o.concept_id IN (5096, 1651) AND e.encounter_type = 14
  GROUP BY e.encounter_id, e.patient_id, e.encounter_datetime, e.creator)"""

_ONE_PERSON = """,
khno AS (SELECT patient_id, min(identifier) AS identifier FROM patient_identifier
         WHERE identifier_type = 4 AND voided = 0 GROUP BY patient_id),
called AS (SELECT person_id, min(concat_ws(' ', family_name, middle_name, given_name)) AS full_name
           FROM person_name WHERE voided = 0 GROUP BY person_id)"""

_PAID = (
    """,
pc AS (SELECT charges_id, CAST(max(payment_date) AS DATE) AS payment_date,
              min(charge_account_id) AS charge_account_id, """
    + ", ".join(
        f'max(CASE WHEN mode_of_payment_id = {mode} THEN amount_paid END) AS "{name}"'
        for name, mode in codes.PAYMENT_MODES.items()
    )
    + """, CAST(sum(amount_paid) AS DECIMAL(18,2)) AS "Total_Paid"
       FROM payment GROUP BY charges_id)"""
)

_NEAR = (
    'bk."Appointment_Date" BETWEEN {at} - INTERVAL 2 DAY AND {at} + INTERVAL 2 DAY'
)
_AGE = (
    "CAST(trunc(date_diff('day', p.birthdate, CAST({at} AS DATE)) / 365.25) AS BIGINT)"
)
_AS_OF = f"DATE '{AS_OF}'"


def _days_to_as_of(day: str) -> str:
    return f"CAST(date_diff('day', {day}, {_AS_OF}) AS INTEGER)"


_COSTS = ", ".join(f"c.{c}" for c in COST_COLUMNS)
_PAID_COLUMNS = ", ".join(
    ["pc.charges_id", "pc.payment_date", "pc.charge_account_id"]
    + [f'pc."{m}"' for m in codes.PAYMENT_MODES]
    + ['pc."Total_Paid"']
)

# -- daily lists --------------------------------------------------------------

_PEOPLE = ("person", "person_name", "patient_identifier")


def _ranked_sql(day: dt.date | None) -> str:
    on_day = f"AND CAST(e.encounter_datetime AS DATE) = DATE '{day}'" if day else ""
    return (
        with_tables("encounter", "obs", "concept_name", *_PEOPLE)
        + _CN + _RANKS + _ONE_PERSON
        + f"""
    SELECT e.patient_id, e.encounter_id, CAST(e.encounter_datetime AS DATE) AS "encounterDate",
           i.identifier AS "KH_Number", w.full_name AS patient_name,
           {_AGE.format(at="e.encounter_datetime")} AS age, a."Primary", a."Secondary",
           min(CAST(op.value_datetime AS DATE)) AS "DoO",
           {_days_to_as_of("min(CAST(op.value_datetime AS DATE))")} AS num_days
    FROM encounter e
    JOIN adm a ON a.encounter_id = e.encounter_id
    JOIN person p ON p.person_id = a.person_id AND p.voided = 0
    JOIN called w ON w.person_id = p.person_id
    LEFT JOIN khno i ON i.patient_id = e.patient_id
    LEFT JOIN obs op ON op.person_id = e.patient_id AND op.concept_id = 159619 AND op.voided = 0
                    AND op.value_datetime >= date_trunc('day', e.encounter_datetime)
    WHERE e.voided = 0 AND e.encounter_type = 15 {on_day}
    GROUP BY ALL
    """
    )


@report("report_daily_list_ranked", _ranked_sql(DAY))
def _(t):
    return daily.daily_list_ranked(t, DAY, AS_OF)


@report("report_daily_list_ranked_every_day", _ranked_sql(None))
def _(t):
    return daily.daily_list_ranked(t, None, AS_OF)


@report(
    "report_bookings",
    with_tables("encounter", "obs", "concept_name", "person_name") + _CN + _BOOKED
    + "\nSELECT * FROM bk",
)
def _(t):
    return parts.bookings(t)


@report(
    "report_notes",
    with_tables("obs") + _NOTES + "\nSELECT * FROM e_notes",
)
def _(t):
    return parts.notes(t)


@report(
    "diagnosis_ranks",
    with_tables("encounter", "obs", "concept_name") + _CN + _RANKS + "\nSELECT * FROM adm",
)
def _(t):
    admitted = parts.live(parts.encounters_by_type_key(t, codes.ADMISSION_TYPE_UUID))
    return parts.diagnosis_ranks(t, admitted)


@report(
    "diagnosis_slots",
    with_tables("encounter", "obs", "concept_name") + _CN + _SLOTS
    + "\nSELECT encounter_id, patient_id AS person_id, dx1, dx2, dx3 FROM adm",
)
def _(t):
    admitted = parts.encounters_by_form_key(t, codes.ADMISSION_FORM_UUID)
    slots = parts.diagnosis_slots(t, admitted.select("encounter_id", "patient_id"))
    return slots.withColumnRenamed("patient_id", "person_id")


def _linked_sql(day: dt.date | None) -> str:
    on_day = f"AND CAST(e.encounter_datetime AS DATE) = DATE '{day}'" if day else ""
    return (
        with_tables("encounter", "obs", "concept_name", *_PEOPLE)
        + _CN + _RANKS + _NOTES + _BOOKED + _ONE_PERSON
        + f""",
linked AS (
    SELECT e.patient_id, e.encounter_id, e.encounter_datetime, bk."Appointment_Date",
           bk."Surgeon", bk."Operation",
           row_number() OVER (PARTITION BY e.encounter_id
                              ORDER BY bk."Appointment_Date", bk.encounter_id) AS rn
    FROM encounter e
    JOIN bk ON bk.patient_id = e.patient_id AND {_NEAR.format(at="e.encounter_datetime")}
    WHERE e.voided = 0 AND e.encounter_type = 15 {on_day})
SELECT e.patient_id, e.encounter_id, CAST(e.encounter_datetime AS DATE) AS "encounterDate",
       i.identifier AS "KH_Number", w.full_name AS patient_name,
       {_AGE.format(at="e.encounter_datetime")} AS age, a."Primary", a."Secondary",
       CAST(e."Appointment_Date" AS DATE) AS "DoO", e."Surgeon", e."Operation", n.notes,
       {_days_to_as_of('CAST(e."Appointment_Date" AS DATE)')} AS num_days
FROM linked e
JOIN e_notes n ON n.encounter_id = e.encounter_id
JOIN adm a ON a.encounter_id = e.encounter_id
JOIN person p ON p.person_id = a.person_id AND p.voided = 0
JOIN called w ON w.person_id = p.person_id
LEFT JOIN khno i ON i.patient_id = e.patient_id
WHERE e.rn = 1
"""
    )


LINKED_DAY = dt.date(1997, 5, 28)


@report("report_daily_list_linked", _linked_sql(LINKED_DAY))
def _(t):
    return daily.daily_list_linked(t, LINKED_DAY, AS_OF)


@report("report_daily_list_linked_every_day", _linked_sql(None))
def _(t):
    return daily.daily_list_linked(t, None, AS_OF)


def _slots_sql(day: dt.date | None) -> str:
    on_day = f"AND CAST(e.encounter_datetime AS DATE) = DATE '{day}'" if day else ""
    return (
        with_tables("encounter", "obs", "concept_name", *_PEOPLE)
        + _CN + _SLOTS + _NOTES + _BOOKED
        + f"""
SELECT e.patient_id, e.encounter_id, CAST(e.encounter_datetime AS DATE) AS doa,
       i.identifier AS "KH_Number",
       concat_ws(' ', w.family_name, w.middle_name, w.given_name) AS patient_name,
       {_AGE.format(at="e.encounter_datetime")} AS age,
       a.dx1 AS "primary", a.dx2 AS "secondary", a.dx3,
       CAST(bk."Appointment_Date" AS DATE) AS "DoO", bk."Surgeon", bk."Operation" AS operation,
       {_days_to_as_of('CAST(bk."Appointment_Date" AS DATE)')} AS num_days, n.notes
FROM encounter e
JOIN adm a ON a.encounter_id = e.encounter_id
JOIN person p ON p.person_id = a.patient_id AND p.voided = 0
JOIN person_name w ON w.person_id = p.person_id AND w.voided = 0
LEFT JOIN patient_identifier i
  ON i.patient_id = e.patient_id AND i.identifier_type = 4 AND i.voided = 0
LEFT JOIN bk ON bk.patient_id = e.patient_id AND {_NEAR.format(at="e.encounter_datetime")}
LEFT JOIN e_notes n ON n.encounter_id = e.encounter_id
WHERE e.voided = 0 AND e.encounter_type = 15 {on_day}
"""
    )


@report("report_daily_list_slots", _slots_sql(DAY))
def _(t):
    return daily.daily_list_slots(t, DAY, AS_OF)


@report("report_daily_list_slots_every_day", _slots_sql(None))
def _(t):
    return daily.daily_list_slots(t, None, AS_OF)


@report(
    "report_open_stays",
    with_tables("encounter", "obs", "concept_name", "visit", *_PEOPLE)
    + _CN + _RANKS + _NOTES + _BOOKED + _ONE_PERSON
    + f""",
dc AS (SELECT patient_id, visit_id, min(CAST(encounter_datetime AS DATE)) AS date_of_discharge
       FROM encounter WHERE encounter_type = 9 GROUP BY ALL),
stays AS (
    SELECT e.patient_id, e.visit_id, v.date_stopped, dc.date_of_discharge,
           e.encounter_id, e.encounter_datetime,
           bk."Appointment_Date", bk."Surgeon", bk."Operation", bk.encounter_id AS bk_id
    FROM encounter e
    JOIN visit v ON v.visit_id = e.visit_id AND v.voided = 0
    LEFT JOIN dc ON dc.patient_id = e.patient_id AND dc.visit_id = e.visit_id
    LEFT JOIN bk ON bk.patient_id = e.patient_id AND {_NEAR.format(at="e.encounter_datetime")}
    WHERE e.encounter_type = 15 AND e.visit_id IS NOT NULL
      AND (v.date_stopped IS NULL OR dc.date_of_discharge IS NULL)
      AND CAST(e.encounter_datetime AS DATE) <= DATE '{CENSUS_DAY}'),
first_enc AS (SELECT patient_id, visit_id, min(encounter_id) AS encounter_id
              FROM stays GROUP BY ALL),
first_bk AS (SELECT * FROM (
    SELECT patient_id, visit_id, "Appointment_Date", "Surgeon", "Operation",
           row_number() OVER (PARTITION BY patient_id, visit_id
                              ORDER BY "Appointment_Date", bk_id) AS rn
    FROM stays WHERE bk_id IS NOT NULL) x WHERE rn = 1)
SELECT DISTINCT s.patient_id, s.encounter_id, s.visit_id, s.date_stopped,
       CAST(s.encounter_datetime AS DATE) AS doa, i.identifier AS "KH_Number",
       w.full_name AS patient_name, {_AGE.format(at="s.encounter_datetime")} AS age,
       a."Primary" AS "primary", a."Secondary" AS "secondary",
       CAST(b."Appointment_Date" AS DATE) AS "DoO", b."Surgeon", b."Operation" AS operation,
       s.date_of_discharge, n.notes,
       {_days_to_as_of('CAST(b."Appointment_Date" AS DATE)')} AS num_days
FROM stays s
JOIN first_enc f ON f.patient_id = s.patient_id AND f.visit_id = s.visit_id
                AND f.encounter_id = s.encounter_id
JOIN person p ON p.person_id = s.patient_id AND p.voided = 0 AND p.dead = 0
JOIN called w ON w.person_id = p.person_id
LEFT JOIN first_bk b ON b.patient_id = s.patient_id AND b.visit_id = s.visit_id
LEFT JOIN khno i ON i.patient_id = s.patient_id
LEFT JOIN adm a ON a.encounter_id = s.encounter_id
LEFT JOIN e_notes n ON n.encounter_id = s.encounter_id
""",
)
def _(t):
    return daily.open_stays(t, CENSUS_DAY, AS_OF)


# -- money --------------------------------------------------------------------


@report(
    "report_payments_flat",
    with_tables("payment", "charges", "mode_of_payment", "charge_account")
    + f"""
    SELECT {_COSTS}, p.payment_date, p.amount_paid, p.nhif, a.account_name, m.mode_of_payment
    FROM payment p
    JOIN charges c ON c.charges_id = p.charges_id
    JOIN mode_of_payment m ON m.mode_of_payment_id = p.mode_of_payment_id
    JOIN charge_account a ON a.charge_account_id = p.charge_account_id
    """,
)
def _(t):
    return financial.payments_flat(t)


@report(
    "report_payment_summary",
    with_tables("payment", "charges", "charge_account", "obs", "person", "person_name")
    + _PAID
    + f"""
    SELECT k.value_text AS "KH_Number", w.family_name AS last_name, w.given_name AS first_name,
           p.birthdate AS dob, p.gender AS sex, c.patient_id, {_COSTS}, a.account_name,
           {_PAID_COLUMNS}
    FROM charges c
    JOIN pc ON pc.charges_id = c.charges_id
    JOIN charge_account a ON a.charge_account_id = pc.charge_account_id
    JOIN person p ON p.person_id = c.patient_id AND p.voided = 0
    JOIN person_name w ON w.person_id = p.person_id AND w.voided = 0
    LEFT JOIN obs k ON k.person_id = c.patient_id AND k.concept_id = 5325 AND k.voided = 0
    """,
)
def _(t):
    return financial.payment_summary(t)


_MONEY_TABLES = (
    "encounter", "obs", "concept_name", "location", "payment", "charges", "charge_account",
    *_PEOPLE,
)


def _charged_sql(diagnoses: str, admission: str, number: str, dated: bool) -> str:
    charged = "c.date_created AS date_of_charge," if dated else ""
    period = (
        f"WHERE c.date_created BETWEEN TIMESTAMP '{YEAR[0]}' AND TIMESTAMP '{YEAR[1]}'"
        if dated
        else ""
    )
    return (
        with_tables(*_MONEY_TABLES) + _CN + diagnoses + _BOOKED + _PAID
        + f""",
located AS ({admission}),
dc AS (SELECT patient_id, visit_id, CAST(encounter_datetime AS DATE) AS date_of_discharge
       FROM encounter WHERE encounter_type = 9)
SELECT i.identifier AS "{number}", w.family_name AS last_name, w.given_name AS first_name,
       p.birthdate AS dob, p.gender AS sex, bk."Operation", bk."Surgeon",
       bk."Appointment_Date" AS "DoO", dc.date_of_discharge, c.patient_id,
       l."Primary", l."Secondary", l."DoA", l.location, l.visit_id, {_COSTS}, {charged}
       a.account_name, {_PAID_COLUMNS}
FROM charges c
JOIN pc ON pc.charges_id = c.charges_id
JOIN located l ON l.visit_id = c.visit_id
JOIN charge_account a ON a.charge_account_id = pc.charge_account_id
LEFT JOIN bk ON bk.patient_id = c.patient_id AND {_NEAR.format(at='l."DoA"')}
LEFT JOIN dc ON dc.patient_id = c.patient_id AND dc.visit_id = l.visit_id
JOIN person p ON p.person_id = c.patient_id AND p.voided = 0
JOIN person_name w ON w.person_id = p.person_id AND w.voided = 0
LEFT JOIN patient_identifier i
  ON i.patient_id = c.patient_id AND i.identifier_type = 4 AND i.voided = 0
{period}
"""
    )


_RANKED_ADMISSION = """
SELECT e.visit_id, x."Primary", x."Secondary", e.encounter_datetime AS "DoA", g.name AS location
FROM adm x JOIN encounter e ON e.encounter_id = x.encounter_id
JOIN location g ON g.location_id = e.location_id"""
_SLOTTED_ADMISSION = """
SELECT e.visit_id, x.dx1 AS "Primary", x.dx2 AS "Secondary", e.encounter_datetime AS "DoA",
       g.name AS location
FROM adm x JOIN encounter e ON e.encounter_id = x.encounter_id
JOIN location g ON g.location_id = e.location_id"""


@report(
    "report_charges_admission", _charged_sql(_RANKS, _RANKED_ADMISSION, "KH_Number", dated=False)
)
def _(t):
    return financial.charges_admission(t)


@report("report_financial", _charged_sql(_RANKS, _RANKED_ADMISSION, "kh_number", dated=True))
def _(t):
    return financial.financial_report(t, *YEAR)


@report(
    "report_financial_slots", _charged_sql(_SLOTS, _SLOTTED_ADMISSION, "kh_number", dated=True)
)
def _(t):
    return financial.financial_report(t, *YEAR, admissions="slots")


# -- operative report ---------------------------------------------------------


def _operative_sql(condition: str, number: str | None = None) -> str:
    asked = f"AND identifier = '{number}'" if number else ""
    join = "JOIN" if number else "LEFT JOIN"

    def text(concept: int, column: str, alias: str) -> str:
        return f'max(CASE WHEN o.concept_id = {concept} THEN {column} ELSE \'\' END) AS "{alias}"'

    def number(concept: int, alias: str) -> str:
        return f'max(CASE WHEN o.concept_id = {concept} THEN o.value_numeric END) AS "{alias}"'

    columns = ",\n       ".join(
        [
            text(1651, "n.name", "operation"),
            text(163034, "n.name", "dx1"),
            text(163035, "n.name", "dx2"),
            text(1473, "o.value_text", "surgeon"),
            text(160029, "n.name", "findings"),
            text(160632, "o.value_text", "operativeDetails"),
            number(5089, "weight"),
            number(161928, "ebl"),
            number(161929, "urine"),
        ]
    )
    return (
        with_tables("encounter", "obs", "concept_name", *_PEOPLE) + _CN
        + f""",
khno AS (SELECT patient_id, min(identifier) AS identifier FROM patient_identifier
         WHERE identifier_type = 4 AND voided = 0 {asked} GROUP BY patient_id),
called AS (SELECT person_id, min(concat_ws(' ', family_name, given_name)) AS full_name
           FROM person_name WHERE voided = 0 GROUP BY person_id),
written AS (
SELECT e.patient_id AS patient, i.identifier AS "khNo", w.full_name AS name, p.birthdate AS dob,
       {_AGE.format(at="e.encounter_datetime")} AS age, p.gender AS sex,
       CAST(e.encounter_datetime AS DATE) AS "DoO", e.encounter_id,
       {columns}
FROM obs o
JOIN encounter e ON e.encounter_id = o.encounter_id AND e.voided = 0
JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
JOIN called w ON w.person_id = p.person_id
{join} khno i ON i.patient_id = e.patient_id
LEFT JOIN names n ON n.concept_id = o.value_coded
WHERE e.encounter_type = 16
GROUP BY e.patient_id, i.identifier, w.full_name, p.birthdate, p.gender, e.encounter_datetime,
         e.encounter_id)
SELECT * FROM written WHERE {condition}
"""
    )


@report(
    "report_operative_by_patient",
    _operative_sql(f"\"DoO\" = DATE '{SURGERY_DAY}' AND patient = {SURGERY_PATIENT}"),
)
def _(t):
    return operative.operative_report(t, SURGERY_DAY, patient=SURGERY_PATIENT)


@report(
    "report_operative_by_number",
    _operative_sql(f"\"DoO\" = DATE '{SURGERY_DAY}'", number=f"KH-{SURGERY_PATIENT}"),
)
def _(t):
    return operative.operative_report(
        t, SURGERY_DAY, hospital_number=f"KH-{SURGERY_PATIENT}"
    )


# Text is compared without case, its largest value too, so the columns of text are left out here.
_ANY_CASE = ["patient", "dob", "age", "DoO", "encounter_id", "weight", "ebl", "urine"]


@report(
    "report_operative_any_case",
    _operative_sql("true", number=f"KH-B{SURGERY_PATIENT}").replace(
        "SELECT * FROM written", 'SELECT {} FROM written'.format(", ".join(f'"{c}"' for c in _ANY_CASE))
    ),
)
def _(t):
    asked = f"kh-b{SURGERY_PATIENT}"
    found = operative.operative_report(ignoring_case(t), hospital_number=asked)
    return found.select(*_ANY_CASE)


@report("report_operative_by_second_number", _operative_sql("true", number="KH-B0"))
def _(t):
    return operative.operative_report(t, hospital_number="KH-B0")


@report("report_operative_every_day", _operative_sql("true"))
def _(t):
    return operative.operative_report(t)


# -- cohorts and statistics ---------------------------------------------------

_COHORT_TABLES = ("encounter", "obs", "person")


def _in(family) -> str:
    return "(" + ", ".join(str(c) for c in family) + ")"


def _cohort_sql(kind: int, concept: int, family, aged: bool = False) -> str:
    age = (
        f", p.birthdate, {_AGE.format(at=_AS_OF)} AS age"
        if aged
        else ""
    )
    return (
        with_tables(*_COHORT_TABLES)
        + f"""
    SELECT e.patient_id, e.encounter_id, e.encounter_type, e.encounter_datetime, e.location_id,
           o.concept_id, o.value_coded{age}
    FROM encounter e
    JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
    JOIN obs o ON o.encounter_id = e.encounter_id AND o.concept_id = {concept}
              AND o.value_coded IN {_in(family)}
    WHERE e.encounter_type = {kind}
    """
    )


@report("cohort_family_a", _cohort_sql(11, 6042, codes.HYDROCEPHALUS_DX))
def _(t):
    return cohorts.cohort_listing(
        t, codes.NEURO_TYPE_UUID, codes.DIAGNOSIS, codes.HYDROCEPHALUS_DX
    )


@report("cohort_family_b", _cohort_sql(11, 6042, codes.SPINA_BIFIDA_DX))
def _(t):
    return cohorts.cohort_listing(t, codes.NEURO_TYPE_UUID, codes.DIAGNOSIS, codes.SPINA_BIFIDA_DX)


@report(
    "cohort_a_operations", _cohort_sql(16, 1651, codes.HYDROCEPHALUS_OPERATIONS, aged=True)
)
def _(t):
    return cohorts.cohort_listing(
        t, codes.SURGERY_TYPE_UUID, codes.OPERATION, codes.HYDROCEPHALUS_OPERATIONS, as_of=AS_OF
    )


_HALVES = """
SELECT CAST(sum(CASE WHEN quarter IN (1, 2) THEN 1 ELSE 0 END) AS BIGINT) AS jan_jun,
       CAST(sum(CASE WHEN quarter IN (3, 4) THEN 1 ELSE 0 END) AS BIGINT) AS jul_dec,
       CAST(count(*) AS BIGINT) AS total
FROM counted GROUP BY quarter"""


def _wrapped(body: str, merge: str = "min") -> str:
    return f"""
SELECT CAST(coalesce({merge}(jan_jun), 0) AS BIGINT) AS jan_jun,
       CAST(coalesce({merge}(jul_dec), 0) AS BIGINT) AS jul_dec,
       CAST(coalesce({merge}(total), 0) AS BIGINT) AS total
FROM ({body}) t"""


# Visits with their three diagnosis slots, and their first visit type.
_SLOTTED = """,
listed AS (
  SELECT e.encounter_id, e.patient_id, p.birthdate, e.encounter_datetime,
         string_split(string_agg(CAST(o.value_coded AS VARCHAR), '|' ORDER BY o.obs_id, o.value_coded), '|')
           AS items
  FROM encounter e
  JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
  JOIN obs o ON o.person_id = e.patient_id AND o.encounter_id = e.encounter_id
  WHERE o.concept_id = 6042 AND e.encounter_type = 11 GROUP BY ALL),
vt AS (
  SELECT e.encounter_id,
         CASE arg_min(o.value_coded, (o.obs_id, o.value_coded)) WHEN 164180 THEN 'Initial'
              WHEN 160530 THEN 'Followup' ELSE 'None' END AS visit_type
  FROM encounter e JOIN obs o ON o.person_id = e.patient_id AND o.encounter_id = e.encounter_id
  WHERE o.concept_id = 164181 AND e.encounter_type = 11 GROUP BY e.encounter_id),
slotted AS (
  SELECT *, coalesce(items[1], '') AS dx1, coalesce(items[2], '') AS dx2,
         CASE WHEN len(items) >= 3 THEN items[-1] ELSE '' END AS dx3 FROM listed)"""


def _member(label: str) -> str:
    in_family = _in(codes.DX_FAMILIES[label])
    return " OR ".join(
        f"(TRY_CAST({slot} AS BIGINT) IN {in_family})" for slot in ("dx1", "dx2", "dx3")
    )


def _visits_sql(
    family: str, excluded: str | None, visit_type: str | None, wrap: bool, merge: str = "min"
) -> str:
    unless = f"AND NOT coalesce({_member(excluded)}, false)" if excluded else ""
    typed = f"AND vt.visit_type = '{visit_type}'" if visit_type else ""
    join_type = "JOIN vt ON vt.encounter_id = d.encounter_id" if visit_type else ""
    body = (
        with_tables(*_COHORT_TABLES)
        + _SLOTTED
        + f""",
counted AS (
  SELECT quarter(d.encounter_datetime) AS quarter
  FROM slotted d {join_type}
  WHERE coalesce({_member(family)}, false) {unless} {typed}
    AND trunc(date_diff('day', d.birthdate, CAST(d.encounter_datetime AS DATE)) / 365.25) < 15)"""
    )
    return body + (_wrapped(_HALVES, merge) if wrap else _HALVES)


_A, _B = codes.HYDROCEPHALUS, codes.SPINA_BIFIDA


@report("stat_a_seen", _visits_sql(_A, _B, None, wrap=True))
def _(t):
    return cohorts.visit_statistic(t, _A, never_with=_B, wrap=True)


@report("stat_a_seen_year_sum", _visits_sql(_A, _B, None, wrap=True, merge="sum"))
def _(t):
    return cohorts.visit_statistic(t, _A, never_with=_B, wrap=True, combine="sum")


@report("stat_a_new", _visits_sql(_A, _B, "Initial", wrap=True))
def _(t):
    return cohorts.visit_statistic(t, _A, never_with=_B, visit_type="Initial", wrap=True)


@report("stat_a_followup", _visits_sql(_A, _B, "Followup", wrap=False))
def _(t):
    return cohorts.visit_statistic(t, _A, never_with=_B, visit_type="Followup")


@report("stat_b_seen", _visits_sql(_B, None, None, wrap=False))
def _(t):
    return cohorts.visit_statistic(t, _B)


@report("stat_b_new", _visits_sql(_B, None, "Initial", wrap=False))
def _(t):
    return cohorts.visit_statistic(t, _B, visit_type="Initial")


@report("stat_b_followup", _visits_sql(_B, None, "Followup", wrap=False))
def _(t):
    return cohorts.visit_statistic(t, _B, visit_type="Followup")


def _operations_sql(family) -> str:
    return (
        with_tables(*_COHORT_TABLES)
        + f""",
counted AS (
  SELECT quarter(e.encounter_datetime) AS quarter
  FROM encounter e
  JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
  JOIN obs o ON o.encounter_id = e.encounter_id AND o.concept_id = 1651
            AND o.value_coded IN {_in(family)}
  WHERE e.encounter_type = 16
    AND trunc(date_diff('day', p.birthdate, {_AS_OF}) / 365.25) < 15)"""
        + _wrapped(_HALVES)
    )


@report("stat_a_operations", _operations_sql(codes.HYDROCEPHALUS_OPERATIONS))
def _(t):
    return cohorts.operation_statistic(t, codes.HYDROCEPHALUS_OPERATIONS, AS_OF)


@report("stat_shunt_total", _operations_sql(codes.SHUNT_TOTAL))
def _(t):
    return cohorts.operation_statistic(t, codes.SHUNT_TOTAL, AS_OF)


@report("stat_shunt_revisions", _operations_sql(codes.SHUNT_REVISIONS))
def _(t):
    return cohorts.operation_statistic(t, codes.SHUNT_REVISIONS, AS_OF)


@report("stat_etv", _operations_sql(codes.ETV))
def _(t):
    return cohorts.operation_statistic(t, codes.ETV, AS_OF)


def _children_sql(label: str, excluded: str | None) -> str:
    unless = f"AND NOT coalesce({_member(excluded)}, false)" if excluded else ""
    return (
        with_tables(*_COHORT_TABLES)
        + _SLOTTED
        + f"""
SELECT CAST(year(encounter_datetime) AS INTEGER) AS year,
       count(DISTINCT CASE WHEN quarter(encounter_datetime) <= 2 THEN patient_id END) AS jan_jun,
       count(DISTINCT CASE WHEN quarter(encounter_datetime) > 2 THEN patient_id END) AS jul_dec,
       count(DISTINCT patient_id) AS total
FROM slotted
WHERE coalesce({_member(label)}, false) {unless}
  AND trunc(date_diff('day', birthdate, CAST(encounter_datetime AS DATE)) / 365.25) < 15
GROUP BY ALL"""
    )


@report("stat_a_children", _children_sql(_A, _B))
def _(t):
    return cohorts.children_seen(t, _A, never_with=_B)


@report("stat_b_children", _children_sql(_B, None))
def _(t):
    return cohorts.children_seen(t, _B)


# The first operation of each patient over all years, of those on record.
_FIRST_OPERATIONS = (
    with_tables(*_COHORT_TABLES)
    + f""",
first_ops AS (
  SELECT e.patient_id, e.encounter_id, e.encounter_datetime, o.value_coded, p.birthdate,
         {_AGE.format(at=_AS_OF)} AS age
  FROM encounter e
  JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
  JOIN obs o ON o.encounter_id = e.encounter_id AND o.concept_id = 1651
            AND o.value_coded IN {_in(codes.HYDROCEPHALUS_OPERATIONS)}
  WHERE e.encounter_type = 16 AND e.encounter_datetime IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY e.patient_id
                             ORDER BY e.encounter_datetime, e.encounter_id, o.value_coded) = 1)"""
)


@report(
    "cohort_a_first_operations",
    _FIRST_OPERATIONS
    + f"""
SELECT * FROM first_ops
WHERE encounter_datetime >= DATE '{YEAR[0]}' AND CAST(encounter_datetime AS DATE) <= DATE '{YEAR[1]}'""",
)
def _(t):
    return cohorts.first_interventions(t, codes.HYDROCEPHALUS_OPERATIONS, AS_OF, *YEAR)


@report(
    "stat_a_first_operations",
    _FIRST_OPERATIONS
    + """
SELECT CAST(year(encounter_datetime) AS INTEGER) AS year,
       count(*) FILTER (quarter(encounter_datetime) <= 2) AS jan_jun,
       count(*) FILTER (quarter(encounter_datetime) > 2) AS jul_dec, count(*) AS total
FROM first_ops WHERE age < 15 GROUP BY ALL""",
)
def _(t):
    return cohorts.first_intervention_statistic(t, codes.HYDROCEPHALUS_OPERATIONS, AS_OF)


def _page_sql() -> str:
    a = f"(coalesce({_member(_A)}, false) AND NOT coalesce({_member(_B)}, false))"
    b = f"coalesce({_member(_B)}, false)"
    visits = ",\n       ".join(
        f"count(*) FILTER ({family} {f"AND visit_type = '{label}'" if label else ''}) AS {name}"
        for name, family, label in (
            ("a_seen", a, None),
            ("a_new", a, "Initial"),
            ("a_followup", a, "Followup"),
            ("b_seen", b, None),
            ("b_new", b, "Initial"),
            ("b_followup", b, "Followup"),
        )
    )
    kinds = {
        "a_operations": codes.HYDROCEPHALUS_OPERATIONS,
        "shunts": codes.SHUNT_TOTAL,
        "shunt_revisions": codes.SHUNT_REVISIONS,
        "etv": codes.ETV,
    }
    operations = ",\n       ".join(
        f"count(*) FILTER (young AND code IN {_in(family)}) AS {name}" for name, family in kinds.items()
    )
    figures = "a_seen a_new a_followup b_seen b_new b_followup a_operations shunts shunt_revisions etv"
    shown = ", ".join(f"coalesce({f}, 0)::bigint AS {f}" for f in figures.split())
    return (
        with_tables(*_COHORT_TABLES)
        + _SLOTTED
        + f""",
aged AS (
  SELECT d.*, vt.visit_type,
         trunc(date_diff('day', birthdate, CAST(encounter_datetime AS DATE)) / 365.25) < 15 AS child
  FROM slotted d LEFT JOIN vt USING (encounter_id)),
seen AS (
  SELECT CAST(year(encounter_datetime) AS INTEGER) AS year,
         CAST(quarter(encounter_datetime) AS INTEGER) AS quarter,
       {visits}
  FROM (SELECT * REPLACE (CASE WHEN child THEN dx1 END AS dx1, CASE WHEN child THEN dx2 END AS dx2,
                          CASE WHEN child THEN dx3 END AS dx3) FROM aged)
  GROUP BY ALL),
operated AS (
  SELECT CAST(year(e.encounter_datetime) AS INTEGER) AS year,
         CAST(quarter(e.encounter_datetime) AS INTEGER) AS quarter, o.value_coded AS code,
         trunc(date_diff('day', p.birthdate, {_AS_OF}) / 365.25) < 15 AS young
  FROM encounter e
  JOIN person p ON p.person_id = e.patient_id AND p.voided = 0
  JOIN obs o ON o.encounter_id = e.encounter_id AND o.concept_id = 1651 AND o.value_coded IS NOT NULL
  WHERE e.encounter_type = 16),
operations AS (SELECT year, quarter, {operations} FROM operated GROUP BY ALL)
SELECT year, quarter, {shown}
FROM seen FULL JOIN operations USING (year, quarter)"""
    )


@report("stat_page_all_years", _page_sql())
def _(t):
    return history.page(history.visit_counts(t), history.operation_counts(t), AS_OF)


@report("stat_page_from_batches", _page_sql())
def _(t):
    # Two batches, as if the later encounters had come in after the earlier ones were counted.
    later = F.col("encounter_datetime") >= F.lit(dt.datetime(1996, 7, 15)).cast("timestamp_ntz")
    batches = [replaced(t, encounter=t.encounter.filter(c)) for c in (~later, later)]
    visits = history.merged(*(history.visit_counts(b) for b in batches))
    return history.page(visits, history.merged(*(history.operation_counts(b) for b in batches)), AS_OF)


def _census_sql(ends: str, kept: str) -> str:
    return (
        with_tables("encounter", "visit", "person", "person_name")
        + f""",
dc AS (SELECT patient_id, visit_id, min(CAST(encounter_datetime AS DATE)) AS gone
       FROM encounter WHERE encounter_type = 9 GROUP BY ALL),
stays AS (
  SELECT e.patient_id, e.visit_id, min(CAST(e.encounter_datetime AS DATE)) AS start,
         {ends} AS stop
  FROM encounter e
  JOIN visit v ON v.visit_id = e.visit_id AND v.voided = 0
  LEFT JOIN dc ON dc.patient_id = e.patient_id AND dc.visit_id = e.visit_id
  JOIN person p ON p.person_id = e.patient_id AND p.voided = 0 AND p.dead = 0
  WHERE e.encounter_type = 15 AND e.patient_id IN (SELECT person_id FROM person_name WHERE voided = 0)
  GROUP BY ALL),
days AS (SELECT unnest(generate_series(DATE '{YEAR[0]}', DATE '{YEAR[1]}', INTERVAL 1 DAY)) AS day)
SELECT CAST(day AS DATE) AS day, count(s.patient_id)::bigint AS n_open
FROM days LEFT JOIN stays s ON s.start <= day AND {kept}
GROUP BY ALL"""
    )


_CLOSED = (
    "CASE WHEN max(v.date_stopped) IS NOT NULL AND max(dc.gone) IS NOT NULL "
    "THEN greatest(CAST(max(v.date_stopped) AS DATE), max(dc.gone)) END"
)


@report("census_every_day", _census_sql(_CLOSED, "s.stop IS NULL"))
def _(t):
    return daily.census(t, *YEAR)


@report("census_in_hindsight", _census_sql(_CLOSED, "(s.stop IS NULL OR s.stop > day)"))
def _(t):
    return daily.census(t, *YEAR, as_recorded=False)
