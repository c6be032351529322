"""Joins and aggregations over the given and the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.catalog.basics import AS_OF
from wardline.catalog.registry import query, report
from wardline.catalog.standin_sql import with_tables
from wardline.functions import columns as C
from wardline.operators import aggregates as A
from wardline.operators import joins as J
from wardline.operators.lists import list_ends
from wardline.plans import parts
from wardline.sources.tables import plain_text

# -- comparison without case --------------------------------------------------

# The same return flags and nations in two spellings each, by the parity of a key.
_FLAG = "CASE WHEN l_orderkey % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END"
_NATION = "CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END"


def _without_case(column: str):
    return F.collate(F.expr(column), "UTF8_LCASE")


@query(
    "filter_ignoring_case",
    f"""
    SELECT l_orderkey, l_linenumber, {_FLAG} AS flag FROM lineitem
    WHERE lower({_FLAG}) IN ('a', 'r') AND lower({_FLAG}) <> 'r'
    """,
)
def _(s):
    spelled = s.lineitem.select("l_orderkey", "l_linenumber", _without_case(_FLAG).alias("flag"))
    kept = spelled.filter(F.col("flag").isin("A", "r") & (F.col("flag") != "R"))
    return plain_text(kept)


@query(
    "join_ignoring_case",
    f"""
    SELECT c.c_custkey, n.n_nationkey
    FROM customer c
    JOIN nation m ON m.n_nationkey = c.c_nationkey
    JOIN (SELECT n_nationkey, {_NATION} AS name FROM nation) n ON lower(n.name) = lower(m.n_name)
    """,
)
def _(s):
    said = s.customer.join(s.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    said = said.select("c_custkey", _without_case("upper(n_name)").alias("name"))
    spelled = s.nation.select("n_nationkey", _without_case(_NATION).alias("name"))
    return said.join(spelled, "name").select("c_custkey", "n_nationkey")


@query(
    "agg_ignoring_case",
    """
    SELECT lower(l_returnflag) AS flag, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem GROUP BY lower(l_returnflag)
    """,
)
def _(s):
    spelled = s.lineitem.select("l_orderkey", _without_case(_FLAG).alias("flag"))
    counted = spelled.groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders")
    )
    return counted.withColumn("flag", F.lower(F.col("flag").cast("string")))


@query(
    "agg_concat_distinct_ignoring_case",
    """
    SELECT l_orderkey, string_agg(DISTINCT lower(l_returnflag), ', ' ORDER BY lower(l_returnflag)) AS flags
    FROM lineitem GROUP BY l_orderkey
    """,
)
def _(s):
    line = "CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END"
    spelled = s.lineitem.select("l_orderkey", _without_case(line).alias("flag"))
    listed = A.distinct_concat(spelled, ["l_orderkey"], {"flags": "flag"})
    # Which spelling is shown depends on the lines of the order.
    ordered = F.array_sort(F.split(F.lower("flags"), ", "))
    return listed.select("l_orderkey", F.array_join(ordered, ", ").alias("flags"))


# -- joins --------------------------------------------------------------------


@query(
    "join_inner",
    """
    SELECT o_orderkey, c_name, c_mktsegment
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def _(s):
    joined = s.orders.join(s.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@report(
    "join_inner_composite",
    with_tables("encounter", "obs")
    + """
    SELECT e.encounter_id, e.patient_id, e.encounter_datetime, o.obs_id, o.value_coded
    FROM obs o JOIN encounter e
      ON o.encounter_id = e.encounter_id AND o.person_id = e.patient_id
    WHERE o.concept_id = 6042
    """,
)
def _(t):
    coded = t.obs.filter(F.col("concept_id") == 6042).select(
        "encounter_id", F.col("person_id").alias("patient_id"), "obs_id", "value_coded"
    )
    joined = t.encounter.join(coded, ["encounter_id", "patient_id"])
    return joined.select(
        "encounter_id", "patient_id", "encounter_datetime", "obs_id", "value_coded"
    )


@query(
    "join_left_filtered_dim",
    """
    SELECT o_orderkey, o_custkey, c_name
    FROM orders LEFT JOIN customer
      ON c_custkey = o_custkey AND c_mktsegment = 'BUILDING' AND c_acctbal > 0
    """,
)
def _(s):
    dim = s.customer.withColumnRenamed("c_custkey", "o_custkey")
    wanted = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)
    joined = J.left_join_filtered(s.orders, dim, wanted, ["o_custkey"])
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query(
    "join_inner_filtered",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name
    FROM lineitem JOIN part ON p_partkey = l_partkey AND p_size IN (1, 2, 3, 5, 8, 13)
    """,
)
def _(s):
    wanted = s.part.filter(F.col("p_size").isin(1, 2, 3, 5, 8, 13))
    joined = s.lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@query(
    "join_left_residual",
    """
    SELECT o_orderkey, l_linenumber, l_partkey, l_shipdate
    FROM orders LEFT JOIN lineitem
      ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-03-02'
    """,
)
def _(s):
    start = F.lit("1998-03-02").cast("timestamp_ntz")
    later = s.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= start))
    lines = later.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate"
    )
    return J.left_join_many(s.orders.select("o_orderkey"), lines, ["o_orderkey"])


def _interval_sql(kind: str) -> str:
    return f"""
    SELECT p.event_id AS purchase_id, p.user_id, p.ts AS purchased,
           c.event_id AS click_id, c.ts AS clicked
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    {kind} JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON c.user_id = p.user_id
     AND c.ts BETWEEN p.ts - INTERVAL 2 DAY AND p.ts + INTERVAL 2 DAY
    """


def _interval(s, how: str):
    purchases = s.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchased")
    )
    clicks = s.events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"),
        F.col("user_id").alias("click_user"),
        F.col("ts").alias("clicked"),
    )
    joined = J.interval_join(
        purchases,
        clicks,
        [("user_id", "click_user")],
        "purchased",
        "clicked",
        how=how,
        piece_rows=J.PIECE_ROWS if how == "left" else None,
    )
    return joined.drop("click_user")


@query("join_interval_inner", _interval_sql("INNER"))
def _(s):
    return _interval(s, "inner")


@query("join_interval_left", _interval_sql("LEFT"))
def _(s):
    return _interval(s, "left")


@query(
    "join_semi_lookup",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
    """,
)
def _(s):
    lookup = s.nation.filter(F.col("n_regionkey") == 1)
    found = J.semi_lookup(s.customer, "c_nationkey", lookup, "n_nationkey")
    return found.select("c_custkey", "c_name")


@query(
    "join_preaggregated",
    """
    SELECT o_orderkey, o_custkey, n_lines, quantity
    FROM orders
    JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_lines,
                 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
          FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey
    """,
)
def _(s):
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)")
    totals = s.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), quantity.alias("quantity")
    )
    return s.orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_custkey", "n_lines", "quantity"
    )


@query(
    "join_outer_nullrejected",
    """
    SELECT o_orderkey, c_name, n_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
    JOIN nation ON n_nationkey = c_nationkey
    """,
)
def _(s):
    dim = s.customer.withColumnRenamed("c_custkey", "o_custkey")
    joined = J.left_join_filtered(s.orders, dim, F.col("c_acctbal") > 0, ["o_custkey"])
    return joined.join(s.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_orderkey", "c_name", "n_name"
    )


@report(
    "join_role_playing",
    with_tables("encounter", "person")
    + """
    SELECT e.encounter_id, patient.gender AS patient_gender, patient.birthdate AS patient_birthdate,
           doctor.gender AS creator_gender
    FROM encounter e
    JOIN person patient ON patient.person_id = e.patient_id AND patient.voided = 0
    JOIN person doctor ON doctor.person_id = e.creator
    WHERE e.encounter_type = 14
    """,
)
def _(t):
    booked = t.encounter.filter(F.col("encounter_type") == 14)
    patient, doctor = parts.live(t.person).alias("patient"), t.person.alias("doctor")
    return (
        booked.join(patient, F.col("patient_id") == F.col("patient.person_id"))
        .join(doctor, F.col("creator") == F.col("doctor.person_id"))
        .select(
            "encounter_id",
            F.col("patient.gender").alias("patient_gender"),
            F.col("patient.birthdate").alias("patient_birthdate"),
            F.col("doctor.gender").alias("creator_gender"),
        )
    )


@query(
    "join_star_chain",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, c_name, n_name, r_name, p_name, s_name
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN part ON p_partkey = l_partkey AND p_size < 25
    LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0
    WHERE o_orderstatus = 'O'
    """,
)
def _(s):
    still_open = s.orders.filter(F.col("o_orderstatus") == "O")
    parts_dim = s.part.withColumnRenamed("p_partkey", "l_partkey")
    makers = s.supplier.withColumnRenamed("s_suppkey", "l_suppkey")
    joined = (
        s.lineitem.join(still_open, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(s.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(s.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(s.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = J.left_join_filtered(joined, parts_dim, F.col("p_size") < 25, ["l_partkey"])
    joined = J.left_join_filtered(joined, makers, F.col("s_acctbal") > 0, ["l_suppkey"])
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        "o_orderdate", "c_name", "n_name", "r_name", "p_name", "s_name",
    )


# -- aggregations -------------------------------------------------------------

def _money(column: str):
    return F.col(column).cast("decimal(18,2)")


@query(
    "agg_group_one",
    """
    SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n, max(l_quantity) AS top
    FROM lineitem GROUP BY l_orderkey
    """,
)
def _(s):
    return s.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top")
    )


@query(
    "agg_group_multi",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, CAST(count(*) AS BIGINT) AS n,
           min(l_shipdate) AS first_ship
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
    """,
)
def _(s):
    return s.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ship")
    )


@query(
    "agg_by_quarter",
    """
    SELECT CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY quarter(o_orderdate)
    """,
)
def _(s):
    return s.orders.groupBy(F.quarter("o_orderdate").alias("quarter")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_global",
    """
    SELECT CAST(count(*) AS BIGINT) AS n, min(l_shipdate) AS first_ship,
           max(l_shipdate) AS last_ship
    FROM lineitem
    """,
)
def _(s):
    return s.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "agg_sum",
    """
    SELECT l_orderkey,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS Total_Paid
    FROM lineitem GROUP BY l_orderkey
    """,
)
def _(s):
    total = F.sum(_money("l_extendedprice")).cast("decimal(18,2)")
    return s.lineitem.groupBy("l_orderkey").agg(total.alias("Total_Paid"))


@query(
    "agg_count_col",
    """
    SELECT o_orderpriority, CAST(count(l_partkey) AS BIGINT) AS lines,
           CAST(count(*) AS BIGINT) AS n
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority
    """,
)
def _(s):
    # Lines are counted per order before the join; an order without lines is one row.
    lines = s.lineitem.groupBy("l_orderkey").agg(
        F.count("l_partkey").alias("_lines"), F.count(F.lit(1)).alias("_rows")
    )
    joined = s.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_orderpriority").agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("lines"),
        F.sum(F.coalesce("_rows", F.lit(1))).alias("n"),
    )


@query(
    "agg_min_max",
    """
    SELECT l_suppkey, CAST(max(l_shipdate) AS DATE) AS last_day,
           CAST(min(l_shipdate) AS DATE) AS first_day, max(l_extendedprice) AS top
    FROM lineitem GROUP BY l_suppkey
    """,
)
def _(s):
    return s.lineitem.groupBy("l_suppkey").agg(
        F.max(F.to_date("l_shipdate")).alias("last_day"),
        F.min(F.to_date("l_shipdate")).alias("first_day"),
        F.max("l_extendedprice").alias("top"),
    )


@query(
    "agg_half_year_counts",
    """
    SELECT CAST(sum(CASE WHEN quarter(o_orderdate) IN (1, 2) THEN 1 ELSE 0 END) AS BIGINT)
             AS jan_jun,
           CAST(sum(CASE WHEN quarter(o_orderdate) IN (3, 4) THEN 1 ELSE 0 END) AS BIGINT)
             AS jul_dec,
           CAST(count(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END) AS BIGINT) AS total
    FROM orders GROUP BY quarter(o_orderdate)
    """,
)
def _(s):
    # A counted column that really holds nulls.
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return A.half_year_counts(s.orders, F.quarter("o_orderdate"), F.lit(1), known)


@query(
    "agg_eav_pivot",
    """
    SELECT user_id,
           max(CASE WHEN event_type = 'click' THEN value END) AS click,
           max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
           max(CASE WHEN event_type = 'error' THEN props ELSE '' END) AS error_props
    FROM events GROUP BY user_id
    """,
)
def _(s):
    return A.eav_pivot(
        s.events,
        ["user_id"],
        {
            "click": ("click", "value"),
            "purchase": ("purchase", "value"),
            "error_props": ("error", "props"),
        },
        concept="event_type",
    )


_MODES = {"NHIF": 1, "Individual": 2, "Government": 3, "NGO": 4, "Insurance": 5, "Needy": 6}


@query(
    "agg_payment_pivot",
    "SELECT l_orderkey AS charges_id, CAST(max(l_shipdate) AS DATE) AS payment_date, "
    + ", ".join(
        f"max(CASE WHEN l_linenumber = {m} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS {n}"
        for n, m in _MODES.items()
    )
    + ", CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS Total_Paid"
    + " FROM lineitem GROUP BY l_orderkey",
)
def _(s):
    paid = s.lineitem.select(
        F.col("l_orderkey").alias("charges_id"),
        "l_linenumber",
        "l_shipdate",
        _money("l_extendedprice").alias("amount_paid"),
    )
    return A.mode_pivot(
        paid,
        "charges_id",
        "l_linenumber",
        "amount_paid",
        _MODES,
        "Total_Paid",
        extra=[F.max(F.to_date("l_shipdate")).alias("payment_date")],
    )


def _named_lines(s):
    return s.lineitem.join(s.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name"
    )


def _line_chunk():
    """Grows with (l_linenumber, l_partkey), in steps that cut a very long order into pieces."""
    step = F.floor(F.col("l_partkey") / 65536)
    return F.col("l_linenumber").cast("bigint") * 10**9 + step


@query(
    "agg_concat_ordered_desc",
    """
    SELECT l_orderkey,
           string_agg(p_name, ',' ORDER BY l_linenumber DESC, l_partkey DESC) AS names
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey
    """,
)
def _(s):
    return A.ordered_concat(
        _named_lines(s),
        ["l_orderkey"],
        "p_name",
        ["l_linenumber", "l_partkey"],
        chunk=_line_chunk(),
        alias="names",
        descending=True,
    )


@query(
    "agg_concat_ordered",
    """
    SELECT l_orderkey,
           string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey) AS codes
    FROM lineitem GROUP BY l_orderkey
    """,
)
def _(s):
    return A.ordered_concat(
        s.lineitem,
        ["l_orderkey"],
        "l_partkey",
        ["l_linenumber", "l_partkey"],
        chunk=_line_chunk(),
        alias="codes",
        separator="|",
    )


@query(
    "agg_list_ends",
    """
    SELECT l_orderkey, codes[1] AS first, codes[2] AS second,
           CASE WHEN len(codes) >= 3 THEN codes[-1] END AS last
    FROM (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS codes
          FROM lineitem GROUP BY l_orderkey) x
    """,
)
def _(s):
    return list_ends(s.lineitem, ["l_orderkey"], "l_partkey", ["l_linenumber", "l_partkey"])


@query(
    "agg_concat_distinct",
    """
    SELECT l_orderkey,
           string_agg(DISTINCT CASE WHEN l_linenumber = 1 THEN p_name END, ', '
                      ORDER BY CASE WHEN l_linenumber = 1 THEN p_name END) AS "Primary",
           string_agg(DISTINCT CASE WHEN l_linenumber <> 1 THEN p_name END, ', '
                      ORDER BY CASE WHEN l_linenumber <> 1 THEN p_name END) AS "Secondary"
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey
    """,
)
def _(s):
    first = F.col("l_linenumber") == 1
    named = _named_lines(s).select(
        "l_orderkey",
        F.when(first, F.col("p_name")).alias("_one"),
        F.when(~first, F.col("p_name")).alias("_other"),
    )
    return A.distinct_concat(named, ["l_orderkey"], {"Primary": "_one", "Secondary": "_other"})


@query(
    "agg_pick_first",
    """
    SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type,
           arg_min(value, (ts, event_id)) AS value
    FROM events GROUP BY user_id
    """,
)
def _(s):
    return A.pick_first(
        s.events,
        ["user_id"],
        ["ts", "event_id"],
        {"event_type": "event_type", "value": "value"},
    )


@query(
    "agg_two_level",
    """
    SELECT l_orderkey, CAST(count(*) AS BIGINT) AS lines,
           CAST(max(paid) AS DECIMAL(18,2)) AS top
    FROM (SELECT l_orderkey, l_linenumber, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid
          FROM lineitem GROUP BY l_orderkey, l_linenumber) x
    GROUP BY l_orderkey
    """,
)
def _(s):
    per_line = s.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(_money("l_extendedprice")).alias("paid")
    )
    return per_line.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.max("paid").cast("decimal(18,2)").alias("top")
    )


def _default_zero_sql(condition: str) -> str:
    return f"""
    SELECT CAST(coalesce(min(jan_jun), 0) AS BIGINT) AS jan_jun,
           CAST(coalesce(min(jul_dec), 0) AS BIGINT) AS jul_dec,
           CAST(coalesce(min(total), 0) AS BIGINT) AS total
    FROM (SELECT sum(CASE WHEN quarter(o_orderdate) IN (1, 2) THEN 1 ELSE 0 END) AS jan_jun,
                 sum(CASE WHEN quarter(o_orderdate) IN (3, 4) THEN 1 ELSE 0 END) AS jul_dec,
                 count(*) AS total
          FROM orders WHERE {condition} GROUP BY quarter(o_orderdate)) x
    """


@query("agg_default_zero", _default_zero_sql("o_totalprice < 0"))
def _(s):
    none = s.orders.filter(F.col("o_totalprice") < 0)
    return A.one_row_statistic(A.half_year_counts(none, F.quarter("o_orderdate"), F.lit(1)))


@query("agg_smallest_quarter", _default_zero_sql("o_orderstatus = 'F'"))
def _(s):
    done = s.orders.filter(F.col("o_orderstatus") == "F")
    return A.one_row_statistic(A.half_year_counts(done, F.quarter("o_orderdate"), F.lit(1)))


@query(
    "agg_days_since_first",
    """
    SELECT o_custkey,
           CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2001-12-31') AS INTEGER)
             AS num_days
    FROM orders GROUP BY o_custkey
    """,
)
def _(s):
    first = F.min(F.to_date("o_orderdate"))
    return s.orders.groupBy("o_custkey").agg(C.days_since(AS_OF, first).alias("num_days"))
