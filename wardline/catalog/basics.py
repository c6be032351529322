"""Scans, projections, filters and scalar functions over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.catalog.registry import Source, query
from wardline.functions import columns as C

CENSUS_DAY = dt.date(1997, 6, 30)
AS_OF = dt.date(2001, 12, 31)

SIZE_FAMILIES = {"A": range(1, 11), "B": range(11, 14)}


def _birthdate(key: str):
    """A birth date for a customer, as in the derived base tables."""
    years = F.pmod(key, F.lit(20)).cast("int")
    return F.date_add(F.lit("1981-01-01").cast("date"), years * 365)


_BIRTHDATE_SQL = "CAST(DATE '1981-01-01' + to_days(CAST(c_custkey % 20 AS INTEGER) * 365) AS DATE)"


def _orders_with_age(s: Source) -> DataFrame:
    people = s.customer.select("c_custkey", _birthdate("c_custkey").alias("birthdate"))
    return s.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", C.age_years("o_orderdate", "birthdate").alias("age")
    )


_AGE_SQL = f"""
SELECT o_orderkey,
       CAST(trunc(date_diff('day', {_BIRTHDATE_SQL}, CAST(o_orderdate AS DATE)) / 365.25) AS BIGINT)
         AS age
FROM orders JOIN customer ON o_custkey = c_custkey
"""


# -- scans and lookups --------------------------------------------------------


@query("scan_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def _(s):
    return s.orders.select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "derived_table",
    """
    SELECT o_orderkey, o_custkey, n_lines
    FROM orders
    JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_lines
          FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey
    """,
)
def _(s):
    lines = s.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return s.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_custkey", "n_lines"
    )


@query("lookup_listing", "SELECT n_nationkey, n_name FROM nation")
def _(s):
    return s.nation.select("n_nationkey", "n_name")


@query(
    "lookup_by_key",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_name IN ('NATION_3', 'NATION_7')",
)
def _(s):
    wanted = F.col("n_name").isin("NATION_3", "NATION_7")
    return s.nation.filter(wanted).select("n_nationkey", "n_name", "n_regionkey")


@query(
    "param_filter",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1997-06-30'",
)
def _(s):
    return s.spark.sql(
        "SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate <= :effectiveDate",
        args={"effectiveDate": CENSUS_DAY},
        orders=s.orders,
    )


@query(
    "codeset_member",
    """
    SELECT p_partkey, p_size,
           CASE WHEN p_size BETWEEN 1 AND 10 THEN 'A' ELSE 'B' END AS family
    FROM part WHERE p_size BETWEEN 1 AND 13
    """,
)
def _(s):
    labelled = s.part.select(
        "p_partkey", "p_size", C.classify("p_size", SIZE_FAMILIES).alias("family")
    )
    return labelled.filter(F.col("family") != "")


# -- projections and filters --------------------------------------------------


@query(
    "project_alias",
    """
    SELECT o_orderkey AS id, o_totalprice AS "Total Price", CAST(o_orderdate AS DATE) AS doa
    FROM orders
    """,
)
def _(s):
    return s.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("Total Price"),
        F.to_date("o_orderdate").alias("doa"),
    )


@query(
    "qualified_star",
    """
    SELECT c.c_name, c.c_mktsegment, o.*
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    """,
)
def _(s):
    o, c = s.orders.alias("o"), s.customer.alias("c")
    joined = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
    return joined.select("c.c_name", "c.c_mktsegment", "o.*")


@query("filter_eq", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def _(s):
    return s.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")


@query("filter_in_list", "SELECT p_partkey, p_size FROM part WHERE p_size IN (3, 7, 11, 19, 45)")
def _(s):
    return s.part.filter(F.col("p_size").isin(3, 7, 11, 19, 45)).select("p_partkey", "p_size")


@query(
    "filter_ne",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag
    FROM lineitem WHERE l_returnflag <> 'R'
    """,
)
def _(s):
    return s.lineitem.filter(F.col("l_returnflag") != "R").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )


@query(
    "filter_null",
    """
    SELECT o_orderkey, o_custkey
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON l_orderkey = o_orderkey
    WHERE l_orderkey IS NULL AND o_custkey IS NOT NULL
    """,
)
def _(s):
    with_lines = s.lineitem.select("l_orderkey").distinct()
    joined = s.orders.join(with_lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    missing = F.col("l_orderkey").isNull() & F.col("o_custkey").isNotNull()
    return joined.filter(missing).select("o_orderkey", "o_custkey")


@query(
    "open_items_census",
    """
    SELECT o_orderkey, o_custkey, stopped, returned
    FROM (SELECT o_orderkey, o_custkey, o_orderdate,
                 CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS stopped
          FROM orders) v
    LEFT JOIN (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS returned
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) d
      ON d.l_orderkey = v.o_orderkey
    WHERE (stopped IS NULL OR returned IS NULL)
      AND CAST(o_orderdate AS DATE) <= DATE '1997-06-30'
    """,
)
def _(s):
    stopped = F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate"))
    items = s.orders.filter(C.up_to_day("o_orderdate", CENSUS_DAY)).select(
        "o_orderkey", "o_custkey", stopped.alias("stopped")
    )
    returned = (
        s.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.to_date(F.min("l_shipdate")).alias("returned"))
    )
    joined = items.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    still_open = F.col("stopped").isNull() | F.col("returned").isNull()
    return joined.filter(still_open).select("o_orderkey", "o_custkey", "stopped", "returned")


@query(
    "filter_between",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'
    """,
)
def _(s):
    inside = C.between_days("o_orderdate", dt.date(1997, 1, 1), dt.date(1997, 3, 31))
    return s.orders.filter(inside).select("o_orderkey", "o_orderdate")


@query(
    "filter_on_day",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-02'
    """,
)
def _(s):
    return s.orders.filter(C.on_day("o_orderdate", dt.date(1998, 3, 2))).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "filter_on_alias",
    """
    SELECT * FROM (
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date_of_charge, o_totalprice AS amount
      FROM orders) x
    WHERE date_of_charge BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND amount > 250000
    """,
)
def _(s):
    charged = s.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("date_of_charge"),
        F.col("o_totalprice").alias("amount"),
    )
    year = F.col("date_of_charge").between(dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    return charged.filter(year & (F.col("amount") > 250000))


@query(
    "having_group_alias",
    """
    SELECT o_custkey AS patient, CAST(o_orderdate AS DATE) AS DoO,
           CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top
    FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
    HAVING CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AND o_custkey > 100
    """,
)
def _(s):
    grouped = (
        s.orders.groupBy(F.col("o_custkey").alias("patient"), F.to_date("o_orderdate").alias("DoO"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    )
    return grouped.filter((F.col("DoO") >= dt.date(1998, 1, 1)) & (F.col("patient") > 100))


@query(
    "any_none_of",
    """
    SELECT o_orderkey
    FROM (SELECT l_orderkey AS o_orderkey,
                 list(CASE WHEN p_size BETWEEN 1 AND 10 THEN 'A'
                           WHEN p_size BETWEEN 11 AND 13 THEN 'B' ELSE '' END) AS kinds
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) x
    WHERE list_contains(kinds, 'A') AND NOT list_contains(kinds, 'B')
    """,
)
def _(s):
    labelled = s.lineitem.join(s.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("o_orderkey"), C.classify("p_size", SIZE_FAMILIES).alias("kind")
    )
    # Two flags per group say all that the list of labels would.
    flags = labelled.groupBy("o_orderkey").agg(
        F.bool_or(F.col("kind") == "A").alias("some_a"),
        F.bool_or(F.col("kind") == "B").alias("some_b"),
    )
    return flags.filter(F.col("some_a") & ~F.col("some_b")).select("o_orderkey")


@query("filter_age", f"SELECT * FROM ({_AGE_SQL}) x WHERE age < 15")
def _(s):
    return _orders_with_age(s).filter(F.col("age") < 15)


# -- scalar functions ---------------------------------------------------------


@query("fn_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(s):
    return s.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "fn_datediff",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
             AS days
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def _(s):
    joined = s.lineitem.join(s.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.datediff("l_shipdate", "o_orderdate").alias("days"),
    )


@query("fn_age_years", _AGE_SQL)
def _(s):
    return _orders_with_age(s)


@query(
    "fn_days_since_asof",
    """
    SELECT o_orderkey,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER)
             AS num_days
    FROM orders
    """,
)
def _(s):
    return s.orders.select("o_orderkey", C.days_since(AS_OF, "o_orderdate").alias("num_days"))


@query(
    "fn_shift_days",
    """
    SELECT event_id, ts - INTERVAL 2 DAY AS two_before, ts + INTERVAL 2 DAY AS two_after
    FROM events
    """,
)
def _(s):
    return s.events.select(
        "event_id",
        C.shift_days("ts", -2).alias("two_before"),
        C.shift_days("ts", 2).alias("two_after"),
    )


@query(
    "fn_quarter",
    "SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders",
)
def _(s):
    return s.orders.select("o_orderkey", F.quarter("o_orderdate").alias("quarter"))


_MAYBE_SEGMENT_SQL = "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"


def _maybe_segment():
    return F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))


@query(
    "fn_concat",
    f"SELECT c_custkey, c_name || ' ' || {_MAYBE_SEGMENT_SQL} AS label FROM customer",
)
def _(s):
    return s.customer.select(
        "c_custkey", F.concat("c_name", F.lit(" "), _maybe_segment()).alias("label")
    )


@query(
    "fn_concat_ws",
    """
    SELECT p_partkey,
           concat_ws(' ', p_brand, CASE WHEN p_size > 25 THEN p_type END, p_name) AS label
    FROM part
    """,
)
def _(s):
    middle = F.when(F.col("p_size") > 25, F.col("p_type"))
    return s.part.select(
        "p_partkey", F.concat_ws(" ", "p_brand", middle, "p_name").alias("label")
    )


_FLAG_LIST_SQL = "concat_ws(',', l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR))"


def _flag_list(separator: str):
    return F.concat_ws(separator, "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))


@query(
    "fn_find_in_set",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(coalesce(list_position(string_split({_FLAG_LIST_SQL}, ','), 'F'), 0) AS INTEGER)
             AS at
    FROM lineitem
    """,
)
def _(s):
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.position_in_list("F", _flag_list(",")).alias("at"),
    )


@query(
    "fn_substring_index",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           string_split({_FLAG_LIST_SQL}, ',')[1] AS head,
           array_to_string(string_split({_FLAG_LIST_SQL}, ',')[1:2], ',') AS front,
           string_split({_FLAG_LIST_SQL}, ',')[-1] AS tail
    FROM lineitem
    """,
)
def _(s):
    text = _flag_list(",")
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.substring_index(text, ",", 1).alias("head"),
        F.substring_index(text, ",", 2).alias("front"),
        F.substring_index(text, ",", -1).alias("tail"),
    )


_RAGGED_SQL = (
    "concat_ws('|', l_returnflag, CASE WHEN l_linenumber > 2 THEN l_linestatus END,"
    " CASE WHEN l_linenumber > 4 THEN CAST(l_linenumber AS VARCHAR) END)"
)


def _ragged():
    """A bar-separated list of one, two or three tokens."""
    line = F.col("l_linenumber")
    return F.concat_ws(
        "|",
        "l_returnflag",
        F.when(line > 2, F.col("l_linestatus")),
        F.when(line > 4, line.cast("string")),
    )


@query(
    "fn_nth_token",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           coalesce(string_split({_RAGGED_SQL}, '|')[2], '') AS second,
           coalesce(string_split({_RAGGED_SQL}, '|')[3], '') AS third
    FROM lineitem
    """,
)
def _(s):
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.nth_token(_ragged(), "|", 2).alias("second"),
        C.nth_token(_ragged(), "|", 3).alias("third"),
    )


@query(
    "fn_token_count",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(len(string_split({_RAGGED_SQL}, '|')) - 1 AS INTEGER) AS bars
    FROM lineitem
    """,
)
def _(s):
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", C.token_count(_ragged(), "|").alias("bars")
    )


@query("fn_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS name FROM part")
def _(s):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return s.part.select("p_partkey", F.trim(padded).alias("name"))


@query(
    "fn_if",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS paid,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS priority
    FROM orders
    """,
)
def _(s):
    done = F.col("o_orderstatus") == "F"
    return s.orders.select(
        "o_orderkey",
        F.when(done, F.col("o_totalprice")).alias("paid"),
        F.when(done, F.col("o_orderpriority")).otherwise("").alias("priority"),
    )


@query(
    "fn_case_searched",
    """
    SELECT o_orderkey,
           CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 200000 THEN 'middle' END
             AS band
    FROM orders
    """,
)
def _(s):
    price = F.col("o_totalprice")
    return s.orders.select(
        "o_orderkey", F.when(price > 400000, "high").when(price > 200000, "middle").alias("band")
    )


@query(
    "fn_case_simple",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_linenumber WHEN 1 THEN 'Initial' WHEN 2 THEN 'Followup' ELSE 'None' END
             AS visit_type
    FROM lineitem
    """,
)
def _(s):
    label = C.label_code("l_linenumber", {1: "Initial", 2: "Followup"}, "None")
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", label.alias("visit_type"))


@query(
    "fn_classify_codes",
    """
    SELECT p_partkey,
           CASE WHEN p_size BETWEEN 1 AND 10 THEN 'A'
                WHEN p_size BETWEEN 11 AND 13 THEN 'B' ELSE '' END AS family
    FROM part
    """,
)
def _(s):
    return s.part.select("p_partkey", C.classify("p_size", SIZE_FAMILIES).alias("family"))
