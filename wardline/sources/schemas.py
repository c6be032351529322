"""Fixed schemas of the fourteen base tables.

Date-times carry no zone, money is exact decimal, and codes are wide enough for
any dictionary size.
"""

from __future__ import annotations

from pyspark.sql import types as T

COST_COLUMNS = (
    "stay_cost",
    "procedure_cost",
    "anaesthesia_cost",
    "doctor_cost",
    "meds_cost",
    "lab_cost",
    "xray_cost",
    "supplies_cost",
    "file_cost",
    "follow_up_cost",
)

_MONEY = T.DecimalType(18, 2)
_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": _MONEY,
}

_COLUMNS = {
    "encounter": (
        "encounter_id bigint, patient_id bigint, visit_id bigint, encounter_datetime timestamp, "
        "encounter_type int, location_id int, creator bigint, voided int"
    ),
    "obs": (
        "obs_id bigint, person_id bigint, concept_id int, encounter_id bigint, order_id bigint, "
        "obs_group_id bigint, value_coded bigint, value_text string, value_numeric double, "
        "value_datetime timestamp, voided int"
    ),
    "visit": "visit_id bigint, date_stopped timestamp, voided int",
    "person": "person_id bigint, birthdate date, gender string, dead int, voided int",
    "person_name": (
        "person_id bigint, given_name string, middle_name string, family_name string, voided int"
    ),
    "patient_identifier": "patient_id bigint, identifier string, identifier_type int, voided int",
    "concept_name": (
        "concept_id bigint, name string, concept_name_type string, locale string, voided int"
    ),
    "encounter_type": "encounter_type_id int, name string, uuid string",
    "form": "form_id int, name string, uuid string, encounter_type int",
    "location": "location_id int, name string",
    "charges": (
        "charges_id bigint, patient_id bigint, visit_id bigint, date_created timestamp, "
        + ", ".join(f"{c} money" for c in COST_COLUMNS)
    ),
    "payment": (
        "charges_id bigint, payment_date timestamp, charge_account_id int, "
        "mode_of_payment_id int, amount_paid money, nhif string"
    ),
    "mode_of_payment": "mode_of_payment_id int, mode_of_payment string",
    "charge_account": "charge_account_id int, account_name string",
}


def _schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {name: _schema(cols) for name, cols in _COLUMNS.items()}
