"""The base tables, derived from the order tables the checks run on.

Orders become encounters, visits and charges, line items become observations
and payments, customers become people, parts and a few code names become
concepts. Every rule has its counterpart in `catalog.standin_sql`.

Observations and encounters are unions of one branch per concept or type, each
with its code as a literal: a report that filters on the code reads only the
branches it needs, and Catalyst drops the others from the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from wardline.functions import codes
from wardline.sources import lookups
from wardline.sources.schemas import COST_COLUMNS, SCHEMAS
from wardline.sources.tables import Tables

# Encounters made from one order are told apart by this distance.
ID_STEP = 10**15
# Concepts made from parts start here, above every fixed code.
PART_CONCEPT = 1_000_000
RANK_CONCEPT = 159946
RANK_CODES = {"Primary": 159943, "Secondary": 159944}

# The codes that quantities 1, 2, ... stand for. The last two have no name.
DX_CODES = codes.HYDROCEPHALUS_DX[:16] + codes.SPINA_BIFIDA_DX[:6]
UNNAMED_DX = DX_CODES[-2:]
OP_CODES = codes.HYDROCEPHALUS_OPERATIONS

ADMITTED = "o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"


def code_names() -> list[tuple[int, str]]:
    """Names of the fixed codes; some hold a comma, as real names do."""
    rows = [(c, f"Hydrocephalus, form {c}") for c in codes.HYDROCEPHALUS_DX]
    rows += [(c, f"Spina bifida {c}") for c in codes.SPINA_BIFIDA_DX if c not in UNNAMED_DX]
    rows += [(c, f"Operation {c}") for c in OP_CODES]
    return rows + [(c, name) for name, c in RANK_CODES.items()]


def _shape(df: DataFrame, table: str, condition: str = "", **columns: str | int) -> DataFrame:
    """Select a table's columns from SQL expressions, typed; the ones not given are null."""
    if condition:
        df = df.filter(condition)
    return df.selectExpr(
        *(
            f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in SCHEMAS[table].fields
        )
    )


def _union(branches: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, branches)


def _coded(code_list: tuple[int, ...], quantity: str, otherwise: str) -> str:
    """The n-th code of a list for quantity n, another code beyond the list."""
    n = len(code_list)
    array = f"array({', '.join(str(c) for c in code_list)})"
    return (
        f"CASE WHEN {quantity} <= {n} THEN element_at({array}, int(least({quantity}, {n})))"
        f" ELSE {otherwise} END"
    )


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


class _Maker:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._given[name]

    def _values(self, rows: str, columns: str) -> DataFrame:
        return self._spark.sql(f"SELECT * FROM VALUES {rows} AS v({columns})")

    # -- people ---------------------------------------------------------------

    def person(self) -> DataFrame:
        return _shape(
            self._read("customer"),
            "person",
            person_id="c_custkey",
            birthdate="date_add(DATE '1981-01-01', int(c_custkey % 20) * 365)",
            gender="if(c_mktsegment IN ('BUILDING', 'HOUSEHOLD'), 'F', 'M')",
            dead="c_acctbal < -900",
            voided="c_acctbal > 9900",
        )

    def person_name(self) -> DataFrame:
        own = _shape(
            self._read("customer"),
            "person_name",
            person_id="c_custkey",
            given_name="c_mktsegment",
            middle_name="if(c_nationkey >= 5, concat('N', c_nationkey), NULL)",
            family_name="c_name",
            voided=0,
        )
        second = _shape(
            self._read("supplier"),
            "person_name",
            person_id="s_suppkey",
            given_name="'Alias'",
            family_name="s_name",
            voided="s_acctbal < 0",
        )
        return own.union(second)

    def patient_identifier(self) -> DataFrame:
        customer = self._read("customer")
        own = _shape(
            customer,
            "patient_identifier",
            "c_acctbal >= 0",
            patient_id="c_custkey",
            identifier="concat('KH-', c_custkey)",
            identifier_type=4,
            voided=0,
        )
        second = _shape(
            self._read("supplier"),
            "patient_identifier",
            patient_id="s_suppkey",
            identifier="concat('KH-B', s_suppkey)",
            identifier_type=4,
            voided="s_acctbal < 0",
        )
        other = _shape(
            customer,
            "patient_identifier",
            patient_id="c_custkey",
            identifier="c_name",
            identifier_type=3,
            voided=0,
        )
        return _union([own, second, other])

    # -- lookups --------------------------------------------------------------

    def encounter_type(self) -> DataFrame:
        rows = self._values(lookups.ENCOUNTER_TYPE_ROWS, "encounter_type_id, name, uuid")
        return _shape(rows, "encounter_type", **_same(*rows.columns))

    def form(self) -> DataFrame:
        rows = self._values(lookups.FORM_ROWS, "form_id, name, uuid, encounter_type")
        return _shape(rows, "form", **_same(*rows.columns))

    def mode_of_payment(self) -> DataFrame:
        rows = self._values(lookups.MODE_ROWS, "mode_of_payment_id, mode_of_payment")
        return _shape(rows, "mode_of_payment", **_same(*rows.columns))

    def location(self) -> DataFrame:
        nation = self._read("nation")
        return _shape(nation, "location", location_id="n_nationkey", name="n_name")

    def charge_account(self) -> DataFrame:
        nation = self._read("nation")
        return _shape(
            nation, "charge_account", charge_account_id="n_nationkey", account_name="n_name"
        )

    def concept_name(self) -> DataFrame:
        part = self._read("part")

        def parts(name: str, kind: str, locale: str) -> DataFrame:
            return _shape(
                part,
                "concept_name",
                concept_id=f"p_partkey + {PART_CONCEPT}",
                name=name,
                concept_name_type=f"'{kind}'",
                locale=f"'{locale}'",
                voided=0,
            )

        fixed = self._values(
            ", ".join(f"({c}L, '{n}')" for c, n in code_names()), "concept_id, name"
        )
        return _union(
            [
                parts("p_name", "FULLY_SPECIFIED", "en"),
                parts("p_brand", "SHORT", "en"),
                parts("p_type", "FULLY_SPECIFIED", "fr"),
                _shape(
                    fixed,
                    "concept_name",
                    concept_id="concept_id",
                    name="name",
                    concept_name_type="'FULLY_SPECIFIED'",
                    locale="'en'",
                    voided=0,
                ),
            ]
        )

    # -- encounters and visits ------------------------------------------------

    def visit(self) -> DataFrame:
        return _shape(
            self._read("orders"),
            "visit",
            visit_id="o_orderkey",
            date_stopped="if(o_orderstatus <> 'O', o_orderdate + INTERVAL '10' DAY, NULL)",
            voided="o_totalprice < 5000",
        )

    def encounter(self) -> DataFrame:
        orders = self._read("orders")

        def branch(kind: int | str, step: int, shift: int, condition: str = "") -> DataFrame:
            at = "o_orderdate"
            return _shape(
                orders,
                "encounter",
                condition,
                encounter_id=f"o_orderkey + {step * ID_STEP}L" if step else "o_orderkey",
                patient_id="o_orderkey div 10",
                visit_id=(
                    "if(o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED',"
                    " NULL, o_orderkey)"
                ),
                encounter_datetime=f"{at} + INTERVAL '{shift}' DAY" if shift else at,
                encounter_type=kind,
                location_id="day(o_orderdate)",
                creator="o_custkey",
                voided="o_totalprice > 490000",
            )

        main = "CASE o_orderpriority WHEN '1-URGENT' THEN 11 WHEN '5-LOW' THEN 16 ELSE 15 END"
        return _union(
            [
                branch(main, 0, 0),
                branch(14, 1, -1, ADMITTED),
                branch(14, 2, 0, "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'"),
                branch(9, 3, 6, "o_orderpriority IN ('2-HIGH', '3-MEDIUM')"),
                branch(9, 4, 8, "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'"),
                branch(15, 5, 1, "o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'"),
            ]
        )

    # -- observations ---------------------------------------------------------

    def _line_obs(self) -> list[DataFrame]:
        lines = self._read("lineitem")
        part_code = f"l_partkey + {PART_CONCEPT}"
        dx = _coded(DX_CODES, "l_quantity", part_code)
        op = _coded(OP_CODES, "l_quantity", part_code)
        group = "l_orderkey * 8 + l_linenumber"

        def branch(concept: int | str, slot: int | str, condition: str = "", **values):
            return _shape(
                lines,
                "obs",
                condition,
                obs_id=f"l_linenumber * {10**12}L + l_partkey * 4 + {slot}",
                person_id="l_orderkey div 10",
                concept_id=concept,
                encounter_id="l_orderkey",
                **{"voided": 0, **values},
            )

        rank = f"if(l_linenumber = 1, {RANK_CODES['Primary']}, {RANK_CODES['Secondary']})"
        surgical = (
            f"CASE l_linenumber WHEN 3 THEN {codes.PREOPERATIVE_DX}"
            f" WHEN 4 THEN {codes.POSTOPERATIVE_DX} WHEN 5 THEN {codes.FINDINGS}"
            f" WHEN 6 THEN {codes.WEIGHT}"
            f" ELSE if(l_linestatus = 'F', {codes.BLOOD_LOSS}, {codes.URINE_OUTPUT}) END"
        )
        written = f"if(l_returnflag = 'A', {codes.SURGEON}, {codes.OPERATIVE_DETAILS})"
        return [
            branch(codes.DIAGNOSIS, 1, obs_group_id=group, value_coded=dx),
            branch(
                RANK_CONCEPT, "if(l_partkey % 2 = 0, 2, 0)", obs_group_id=group, value_coded=rank
            ),
            branch(
                codes.GROUP_EXCLUDED,
                3,
                "l_returnflag = 'R'",
                obs_group_id=group,
                value_coded=part_code,
            ),
            branch(
                codes.NOTES,
                1,
                "l_linestatus = 'F'",
                value_text="concat_ws(' ', 'note', l_linenumber, l_partkey)",
                voided="l_returnflag = 'R'",
            ),
            branch(codes.OPERATION, 1, "l_linenumber <= 2", value_coded=op),
            branch(
                surgical,
                1,
                "l_linenumber >= 3",
                value_coded=f"if(l_linenumber <= 5, {dx}, NULL)",
                value_numeric=(
                    "CASE l_linenumber WHEN 6 THEN l_quantity WHEN 7 THEN l_extendedprice END"
                ),
            ),
            branch(
                written,
                2,
                "l_returnflag IN ('A', 'N')",
                value_text="concat_ws(' ', 'text', l_suppkey)",
            ),
        ]

    def _order_obs(self) -> list[DataFrame]:
        orders = self._read("orders")

        def branch(concept: int, slot: int, step: int, condition: str = "", **values):
            return _shape(
                orders,
                "obs",
                condition,
                obs_id=f"o_orderkey * 8 + {slot}",
                person_id="o_orderkey div 10",
                concept_id=concept,
                encounter_id=f"o_orderkey + {step * ID_STEP}L" if step else "o_orderkey",
                voided=0,
                **values,
            )

        urgent = "o_orderpriority = '1-URGENT'"
        n = len(OP_CODES)
        return [
            branch(
                codes.APPOINTMENT_DATE, 0, 1, ADMITTED,
                value_datetime=(
                    "o_orderdate + make_dt_interval(int(o_custkey % 9 - 4), 0,"
                    " if(o_orderstatus = 'F', 1, 0))"
                ),
            ),
            branch(
                codes.APPOINTMENT_DATE, 1, 2,
                "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'",
                value_datetime="o_orderdate + INTERVAL '1' DAY",
            ),
            branch(
                codes.OPERATION, 2, 1, ADMITTED,
                value_coded=_coded(OP_CODES, f"int(o_custkey % {n} + 1)", "NULL"),
            ),
            branch(
                codes.OPERATION_DATE, 3, 0,
                value_datetime="o_orderdate + make_dt_interval(int(o_custkey % 9))",
            ),
            branch(
                codes.VISIT_TYPE, 4, 0, urgent,
                value_coded=(
                    "CASE o_orderstatus WHEN 'F' THEN 164180 WHEN 'O' THEN 160530 ELSE 1065 END"
                ),
            ),
            branch(
                codes.VISIT_TYPE, 5, 0, f"{urgent} AND o_totalprice > 400000", value_coded=160530
            ),
        ]

    def obs(self) -> DataFrame:
        from_customers = _shape(
            self._read("customer"),
            "obs",
            obs_id="c_custkey",
            person_id="c_custkey",
            concept_id=codes.HOSPITAL_NUMBER,
            value_text="concat('KH', c_custkey)",
            voided="c_acctbal < 0",
        )
        return _union([*self._line_obs(), *self._order_obs(), from_customers])

    # -- money ----------------------------------------------------------------

    def charges(self) -> DataFrame:
        price = "CAST(o_totalprice AS DECIMAL(18,2))"
        return _shape(
            self._read("orders"),
            "charges",
            charges_id="o_orderkey",
            patient_id="o_orderkey div 10",
            visit_id="o_orderkey",
            date_created="o_orderdate",
            **{c: f"{price} + {i}" for i, c in enumerate(COST_COLUMNS)},
        )

    def payment(self) -> DataFrame:
        return _shape(
            self._read("lineitem"),
            "payment",
            charges_id="l_orderkey",
            payment_date="l_shipdate",
            charge_account_id="l_suppkey % 25",
            mode_of_payment_id="l_linenumber",
            amount_paid="l_extendedprice",
            nhif="l_returnflag",
        )


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Base tables derived from the order tables of a folder."""
    maker = _Maker(spark, sf_dir)
    return Tables(lambda name: getattr(maker, name)())
