"""Small hand-made base tables for the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from wardline.functions import codes
from wardline.sources import lookups
from wardline.sources.schemas import COST_COLUMNS, SCHEMAS
from wardline.sources.tables import Tables

NEURO, ADMISSION, BOOKING, SURGERY, DISCHARGE = 11, 15, 14, 16, 9

# Names of the concepts the tests use.
CONCEPTS = {
    1: "Primary",
    2: "Secondary",
    11: "X",
    12: "Y",
    13: "X, type 2",
    21: "Shunt",
    31: "a",
    32: "b",
    33: "c",
    34: "d",
}


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


class Clinic:
    """Rows added one by one; `tables` gives them as base tables."""

    def __init__(self, spark):
        self._spark = spark
        self._rows: dict[str, list[dict]] = {name: [] for name in SCHEMAS}
        self._next_obs = 1000
        for concept, name in CONCEPTS.items():
            self.concept(concept, name)

    def add(self, table: str, **values) -> None:
        defaults = {"voided": 0} if "voided" in SCHEMAS[table].names else {}
        self._rows[table].append({**defaults, **values})

    def concept(self, concept, name, locale="en", kind="FULLY_SPECIFIED", voided=0):
        self.add(
            "concept_name",
            concept_id=concept,
            name=name,
            locale=locale,
            concept_name_type=kind,
            voided=voided,
        )

    def patient(self, patient, birthdate="2010-01-01", number=True, dead=0, voided=0):
        self.add(
            "person",
            person_id=patient,
            birthdate=dt.date.fromisoformat(birthdate),
            gender="F",
            dead=dead,
            voided=voided,
        )
        self.add(
            "person_name",
            person_id=patient,
            given_name=f"Given{patient}",
            family_name=f"Family{patient}",
        )
        if number:
            self.add(
                "patient_identifier",
                patient_id=patient,
                identifier=f"KH{patient}",
                identifier_type=codes.HOSPITAL_NUMBER_TYPE,
            )

    def encounter(self, encounter, patient, kind, when, visit=None, creator=900, **values):
        self.add(
            "encounter",
            encounter_id=encounter,
            patient_id=patient,
            visit_id=visit,
            encounter_datetime=at(when),
            encounter_type=kind,
            location_id=1,
            creator=creator,
            **values,
        )

    def obs(self, encounter, patient, concept, obs_id=None, **values):
        self._next_obs += 1
        self.add(
            "obs",
            obs_id=obs_id or self._next_obs,
            person_id=patient,
            concept_id=concept,
            encounter_id=encounter,
            **values,
        )

    def booking(self, encounter, patient, appointment, operation=21):
        self.encounter(encounter, patient, BOOKING, "2024-01-01 08:00")
        self.obs(encounter, patient, codes.APPOINTMENT_DATE, value_datetime=at(appointment))
        if operation is not None:
            self.obs(encounter, patient, codes.OPERATION, value_coded=operation)

    def surgeon(self, person=900):
        self.add("person_name", person_id=person, given_name="Jo", family_name="Cutter")

    def group(self, encounter, patient, group, *concepts):
        """A diagnosis group; concepts as they appear in the list, latest first."""
        for concept in reversed(concepts):
            self.obs(encounter, patient, 7, obs_group_id=group, value_coded=concept)

    def diagnoses(self, encounter, patient, *coded):
        for code in coded:
            self.obs(encounter, patient, codes.DIAGNOSIS, value_coded=code)

    def charge(self, charge, patient, visit, when):
        self.add(
            "charges",
            charges_id=charge,
            patient_id=patient,
            visit_id=visit,
            date_created=at(when),
            **{c: Decimal("10.00") for c in COST_COLUMNS},
        )

    def payment(self, charge, mode, amount, account=5, when="2024-02-01 09:00"):
        self.add(
            "payment",
            charges_id=charge,
            mode_of_payment_id=mode,
            amount_paid=Decimal(amount),
            charge_account_id=account,
            payment_date=at(when),
            nhif="n",
        )

    def _frame(self, name):
        schema = SCHEMAS[name]
        values = {
            "encounter_type": lookups.ENCOUNTER_TYPE_ROWS,
            "form": lookups.FORM_ROWS,
            "mode_of_payment": lookups.MODE_ROWS,
            "location": "(1, 'Ward')",
            "charge_account": "(5, 'Main'), (6, 'Other')",
        }.get(name)
        if values:
            columns = ", ".join(schema.names)
            return self._spark.sql(f"SELECT * FROM VALUES {values} AS v({columns})")
        rows = [tuple(r.get(f) for f in schema.names) for r in self._rows[name]]
        return self._spark.createDataFrame(rows, schema)

    def tables(self) -> Tables:
        return Tables(self._frame)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
