"""The derived base tables in SQL: the counterpart of `sources.standins`."""

from __future__ import annotations

from wardline.sources import lookups
from wardline.sources.schemas import COST_COLUMNS
from wardline.sources.standins import DX_CODES, OP_CODES, code_names


def _code_list(codes: tuple[int, ...]) -> str:
    return "[" + ", ".join(str(c) for c in codes) + "]"


_DX = (
    f"CASE WHEN l_quantity <= {len(DX_CODES)} THEN {_code_list(DX_CODES)}[CAST(l_quantity AS INTEGER)]"
    " ELSE 1000000 + l_partkey END"
)
_OP = (
    f"CASE WHEN l_quantity <= {len(OP_CODES)} THEN {_code_list(OP_CODES)}[CAST(l_quantity AS INTEGER)]"
    " ELSE 1000000 + l_partkey END"
)
_VISIT = (
    "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL"
    " ELSE o_orderkey END"
)


def _encounters(kind: str, step: int, shift: int, condition: str) -> str:
    return f"""
    SELECT o_orderkey + {step} * 1000000000000000 AS encounter_id,
           o_orderkey // 10 AS patient_id,
           {_VISIT} AS visit_id,
           o_orderdate + to_days({shift}) AS encounter_datetime,
           {kind} AS encounter_type,
           CAST(extract(day FROM o_orderdate) AS INTEGER) AS location_id,
           o_custkey AS creator,
           CASE WHEN o_totalprice > 490000 THEN 1 ELSE 0 END AS voided
    FROM orders WHERE {condition}"""


_ENCOUNTER = " UNION ALL ".join(
    [
        _encounters(
            "CASE o_orderpriority WHEN '1-URGENT' THEN 11 WHEN '5-LOW' THEN 16 ELSE 15 END",
            0, 0, "true",
        ),
        _encounters("14", 1, -1, "o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"),
        _encounters("14", 2, 0, "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'"),
        _encounters("9", 3, 6, "o_orderpriority IN ('2-HIGH', '3-MEDIUM')"),
        _encounters("9", 4, 8, "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'"),
        _encounters("15", 5, 1, "o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'"),
    ]
)


def _line_obs(
    concept: str,
    slot: str,
    condition: str = "true",
    group: bool = False,
    coded: str = "NULL",
    text: str = "NULL",
    number: str = "NULL",
    voided: str = "0",
) -> str:
    group_id = "l_orderkey * 8 + l_linenumber" if group else "NULL"
    return f"""
    SELECT l_linenumber * 1000000000000 + l_partkey * 4 + {slot} AS obs_id,
           l_orderkey // 10 AS person_id, {concept} AS concept_id, l_orderkey AS encounter_id,
           CAST({group_id} AS BIGINT) AS obs_group_id, CAST({coded} AS BIGINT) AS value_coded,
           CAST({text} AS VARCHAR) AS value_text, CAST({number} AS DOUBLE) AS value_numeric,
           CAST(NULL AS TIMESTAMP) AS value_datetime, {voided} AS voided
    FROM lineitem WHERE {condition}"""


def _order_obs(
    concept: int, slot: int, step: int, condition: str, coded: str = "NULL", at: str = "NULL"
) -> str:
    return f"""
    SELECT o_orderkey * 8 + {slot}, o_orderkey // 10, {concept},
           o_orderkey + {step} * 1000000000000000, CAST(NULL AS BIGINT),
           CAST({coded} AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
           CAST({at} AS TIMESTAMP), 0
    FROM orders WHERE {condition}"""


_ADMITTED = "o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"
_OBS = " UNION ALL ".join(
    [
        _line_obs("6042", "1", group=True, coded=_DX),
        _line_obs(
            "159946",
            "CASE WHEN l_partkey % 2 = 0 THEN 2 ELSE 0 END",
            group=True,
            coded="CASE WHEN l_linenumber = 1 THEN 159943 ELSE 159944 END",
        ),
        _line_obs(
            "159394", "3", "l_returnflag = 'R'", group=True, coded="1000000 + l_partkey"
        ),
        _line_obs(
            "162169",
            "1",
            "l_linestatus = 'F'",
            text="concat_ws(' ', 'note', l_linenumber, l_partkey)",
            voided="CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
        ),
        _line_obs("1651", "1", "l_linenumber <= 2", coded=_OP),
        _line_obs(
            "CASE l_linenumber WHEN 3 THEN 163034 WHEN 4 THEN 163035 WHEN 5 THEN 160029"
            " WHEN 6 THEN 5089 ELSE CASE WHEN l_linestatus = 'F' THEN 161928 ELSE 161929 END END",
            "1",
            "l_linenumber >= 3",
            coded=f"CASE WHEN l_linenumber <= 5 THEN {_DX} END",
            number="CASE l_linenumber WHEN 6 THEN l_quantity WHEN 7 THEN l_extendedprice END",
        ),
        _line_obs(
            "CASE WHEN l_returnflag = 'A' THEN 1473 ELSE 160632 END",
            "2",
            "l_returnflag IN ('A', 'N')",
            text="concat_ws(' ', 'text', l_suppkey)",
        ),
        _order_obs(
            5096, 0, 1, _ADMITTED,
            at="o_orderdate + to_days(CAST(o_custkey % 9 - 4 AS INTEGER))"
            " + to_minutes(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)",
        ),
        _order_obs(
            5096, 1, 2, "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'",
            at="o_orderdate + to_days(1)",
        ),
        _order_obs(
            1651, 2, 1, _ADMITTED,
            coded=f"{_code_list(OP_CODES)}[CAST(o_custkey % {len(OP_CODES)} + 1 AS INTEGER)]",
        ),
        _order_obs(
            159619, 3, 0, "true",
            at="o_orderdate + to_days(CAST(o_custkey % 9 AS INTEGER))",
        ),
        _order_obs(
            164181, 4, 0, "o_orderpriority = '1-URGENT'",
            coded="CASE o_orderstatus WHEN 'F' THEN 164180 WHEN 'O' THEN 160530 ELSE 1065 END",
        ),
        _order_obs(
            164181, 5, 0, "o_orderpriority = '1-URGENT' AND o_totalprice > 400000",
            coded="160530",
        ),
        """
    SELECT c_custkey, c_custkey, 5325, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
           CAST(NULL AS BIGINT), 'KH' || c_custkey, CAST(NULL AS DOUBLE),
           CAST(NULL AS TIMESTAMP), CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END
    FROM customer""",
    ]
)

_NAMES = ", ".join(f"({code}, '{name}')" for code, name in code_names())
_COSTS = ", ".join(
    f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) + {i} AS DECIMAL(18,2)) AS {c}"
    for i, c in enumerate(COST_COLUMNS)
)

_TABLES = {
    "person": """
    SELECT c_custkey AS person_id,
           CAST(DATE '1981-01-01' + to_days(CAST(c_custkey % 20 AS INTEGER) * 365) AS DATE)
             AS birthdate,
           CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F' ELSE 'M' END AS gender,
           CASE WHEN c_acctbal < -900 THEN 1 ELSE 0 END AS dead,
           CASE WHEN c_acctbal > 9900 THEN 1 ELSE 0 END AS voided
    FROM customer""",
    "person_name": """
    SELECT c_custkey AS person_id, c_mktsegment AS given_name,
           CASE WHEN c_nationkey >= 5 THEN 'N' || c_nationkey END AS middle_name,
           c_name AS family_name, 0 AS voided
    FROM customer
    UNION ALL
    SELECT s_suppkey, 'Alias', NULL, s_name, CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END
    FROM supplier""",
    "patient_identifier": """
    SELECT c_custkey AS patient_id, 'KH-' || c_custkey AS identifier, 4 AS identifier_type,
           0 AS voided
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT s_suppkey, 'KH-B' || s_suppkey, 4, CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END
    FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, 3, 0 FROM customer""",
    "encounter_type": f"""
    SELECT * FROM (VALUES {lookups.ENCOUNTER_TYPE_ROWS}) AS v(encounter_type_id, name, uuid)""",
    "form": f"""
    SELECT * FROM (VALUES {lookups.FORM_ROWS}) AS v(form_id, name, uuid, encounter_type)""",
    "mode_of_payment": f"""
    SELECT * FROM (VALUES {lookups.MODE_ROWS}) AS v(mode_of_payment_id, mode_of_payment)""",
    "location": "SELECT n_nationkey AS location_id, n_name AS name FROM nation",
    "charge_account": (
        "SELECT n_nationkey AS charge_account_id, n_name AS account_name FROM nation"
    ),
    "concept_name": f"""
    SELECT p_partkey + 1000000 AS concept_id, p_name AS name,
           'FULLY_SPECIFIED' AS concept_name_type, 'en' AS locale, 0 AS voided FROM part
    UNION ALL SELECT p_partkey + 1000000, p_brand, 'SHORT', 'en', 0 FROM part
    UNION ALL SELECT p_partkey + 1000000, p_type, 'FULLY_SPECIFIED', 'fr', 0 FROM part
    UNION ALL SELECT code, name, 'FULLY_SPECIFIED', 'en', 0
              FROM (VALUES {_NAMES}) AS v(code, name)""",
    "visit": """
    SELECT o_orderkey AS visit_id,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(10) END AS date_stopped,
           CASE WHEN o_totalprice < 5000 THEN 1 ELSE 0 END AS voided
    FROM orders""",
    "encounter": _ENCOUNTER,
    "obs": _OBS,
    "charges": f"""
    SELECT o_orderkey AS charges_id, o_orderkey // 10 AS patient_id, o_orderkey AS visit_id,
           o_orderdate AS date_created, {_COSTS}
    FROM orders""",
    "payment": """
    SELECT l_orderkey AS charges_id, l_shipdate AS payment_date,
           CAST(l_suppkey % 25 AS INTEGER) AS charge_account_id,
           l_linenumber AS mode_of_payment_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_paid, l_returnflag AS nhif
    FROM lineitem""",
}


def with_tables(*names: str) -> str:
    """A WITH clause that defines the named base tables, left open for more steps."""
    return "WITH " + ",\n".join(f"{n} AS ({_TABLES[n]})" for n in names)
