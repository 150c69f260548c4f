"""PL4/PL7 rollups and PL2 modes, plus the per-key picking operators.

``lineitem`` plays ERP / OMS lines, ``orders`` the order headers,
``events`` the status history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import duplicate_keys, keep_first, latest_by, number_within
from ..operators.rollup import listagg_by_value, mode_per_group, rollup_lines
from ..sources.tables import table


# Fixed values (must equal the reference's): the suborder rollup of OMS lines,
# (output column, aggregate, line column), in the reference's order.
SUBORDER_ROLLUP = [
    ("ORDER_ID", "max", "ORDER_ID"), ("ORDER_DATE", "max", "DATE_ORDER"),
    ("TOTAL_DISCOUNT", "sum", "AMOUNT_DISCOUNT"), ("TOTAL_TAX", "sum", "AMOUNT_TAX"),
    ("TOTAL_AMOUNT", "sum", "AMOUNT_TOTAL"), ("TOTAL_UNTAXED", "sum", "AMOUNT_UNTAXED"),
    ("STATE", "max", "STATE_OPTION_NAME"), ("DELIVERY_DATE", "max", "DELIVERY_CLIENT_DATE"),
    ("DELIVERY_METHOD", "max", "DELIVERY_METHOD_NAME"), ("ECOMMERCE_NAME", "max", "ECOMMERCE_NAME"),
    ("ECOMMERCE_NAME_CHILD", "max", "ECOMMERCE_NAME_CHILD"), ("WAREHOUSE", "max", "WAREHOUSE"),
    ("NUMBER_OF_ITEMS", "count", None), ("NUMBER_OF_PRODUCTS", "sum", "PRODUCT_UOM_QTY"),
    ("CITY_NAME", "max", "CITY_NAME"), ("STREET", "max", "STREET"), ("PHONE", "max", "PHONE"),
    ("STATE_NAME", "max", "STATE_NAME"), ("DISCOUNT", "max", "DISCOUNT"),
    ("PRICE_REDUCE", "sum", "PRICE_REDUCE"), ("PRICE_TOTAL", "sum", "PRICE_TOTAL"),
    ("EMAIL", "max", "EMAIL"), ("PARTNER_NAME", "max", "PARTNER_NAME"), ("PARTNER_VAT", "max", "PARTNER_VAT"),
    ("PAYMENT_METHOD_NAME", "max", "PAYMENT_METHOD_NAME"), ("TRANSFER_WAREHOUSE", "listagg", "TRANSFER_WAREHOUSE"),
]


def oms_suborder_rollup(lines: DataFrame, outputs: list[str] | None = None) -> DataFrame:
    """PL4/AG2/AG3/ST10/Q1: OMS lines -> one row per suborder.  Order-level
    amounts are repeated on every line and summed, so totals are multiplied
    by the line count (quirk Q1, kept for parity); the transfer warehouses
    are a ``LISTAGG`` of the non-blank values ordered by value (the
    reference orders by the group key, which leaves the order undefined).
    ``outputs`` names the columns wanted (all by default)."""
    aggs = []
    for out, how, col in SUBORDER_ROLLUP:
        if outputs is not None and out not in outputs:
            continue
        if how == "max":
            aggs.append(F.max(col).alias(out))
        elif how == "sum":
            aggs.append(F.sum(col).alias(out))
        elif how == "count":
            aggs.append(F.count(F.lit(1)).alias(out))
        else:
            aggs.append(listagg_by_value(col).alias(out))
    return lines.groupBy("SUBORDER_ID").agg(*aggs)


def oms_suborder_rollup_q(spark, sf):
    """PL4 end to end: OMS documents flattened to lines (first of a repeated
    line id kept) and rolled up per suborder."""
    from .documents import land_oms_orders
    from ..operators.nested import flatten_oms_orders
    from ..sources import documents as S
    docs = land_oms_orders(spark, sf).select(S.parse_json(F.col("payload"), S.OMS_ORDER).alias("d")).select("d.*")
    outputs = ["ORDER_ID", "TOTAL_AMOUNT", "WAREHOUSE", "NUMBER_OF_ITEMS", "NUMBER_OF_PRODUCTS", "PRICE_TOTAL", "DISCOUNT", "PARTNER_VAT",
               "CITY_NAME", "TRANSFER_WAREHOUSE"]
    lines, _ = flatten_oms_orders(docs, columns=["SUBORDER_ID", *[col for out, _, col in SUBORDER_ROLLUP if out in outputs and col]])
    r = oms_suborder_rollup(lines, outputs)
    return r.select("SUBORDER_ID", "ORDER_ID", F.round("TOTAL_AMOUNT", 2).alias("TOTAL_AMOUNT"), "WAREHOUSE",
                    "NUMBER_OF_ITEMS", F.round("NUMBER_OF_PRODUCTS", 2).alias("NUMBER_OF_PRODUCTS"),
                    F.round("PRICE_TOTAL", 2).alias("PRICE_TOTAL"), "DISCOUNT", "PARTNER_VAT", "CITY_NAME",
                    "TRANSFER_WAREHOUSE")


def header_rollup(spark, sf):
    """AG1/ST8: ERP line -> order header: ``MAX`` of carried attributes,
    ``SUM`` of measures, ``LEFT(MAX(x), n)`` of a text column."""
    li = table(spark, sf, "lineitem").withColumn(
        "line_text", F.concat_ws("/", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")))
    return rollup_lines(
        li, ["l_orderkey"],
        max_cols=["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
        sum_cols=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], sum_round=2,
        left_max_cols={"line_text": 3}, count_name="n_lines")


def suborder_rollup(spark, sf):
    """AG2/AG3/ST10/Q1: order header joined to its lines and rolled up.

    As in the reference, the order-level total is repeated on every line and
    then summed, so ``sum_totalprice`` is the total times the line count
    (quirk Q1, kept for parity).  ``flags`` is the ``LISTAGG`` of non-blank
    return flags ordered by value.
    """
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    lines = o.join(li, o.o_orderkey == li.l_orderkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
        F.col("o_totalprice").alias("sum_totalprice"), F.col("l_quantity").alias("sum_quantity"),
        F.col("l_returnflag").alias("flags"))
    r = rollup_lines(lines, ["o_orderkey"],
                     max_cols=["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
                     sum_cols=["sum_totalprice", "sum_quantity"], sum_round=2,
                     list_cols=["flags"], count_name="n_lines")
    return r


def changed_rollup(spark, sf, since="2001-06-01"):
    """SM4 (batch form): orders with a line shipped since ``since``,
    re-aggregated over *all* their lines (not just the changed ones, Q2)."""
    li = table(spark, sf, "lineitem")
    changed = li.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz")).select("l_orderkey")
    all_lines = li.join(changed.distinct(), "l_orderkey", "left_semi")
    return rollup_lines(all_lines, ["l_orderkey"], max_cols=["l_shipdate"],
                        sum_cols=["l_quantity"], sum_round=2, count_name="n_lines")


def mode_per_customer(spark, sf):
    """AG8/JN12: most frequent priority and status of each customer's
    orders (ties -> smallest), left-joined to the customers."""
    o = table(spark, sf, "orders")
    modes = mode_per_group(o, ["o_custkey"], ["o_orderpriority", "o_orderstatus"])
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return c.join(modes, c.c_custkey == modes.o_custkey, "left").select(
        "c_custkey", "c_name", F.col("o_orderpriority").alias("mode_priority"),
        F.col("o_orderstatus").alias("mode_status"))


def latest_per_user(spark, sf):
    """AG10/WN1: latest event per user (ties by event id)."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by(e, ["user_id"], ["ts", "event_id"])


def latest_address_join(spark, sf):
    """JN8/JN7: latest order per customer (by order id, descending) as a
    CTE, left-joined from customers, and customers to their nation."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    latest = latest_by(o, ["o_custkey"], ["o_orderkey"])
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(latest, c.c_custkey == latest.o_custkey, "left")
            .select("c_custkey", "c_name", "n_name", F.col("o_orderkey").alias("latest_orderkey"),
                    F.col("o_orderstatus").alias("latest_status")))


def line_numbering(spark, sf):
    """WN2/WN3/FL12: split lines into valid / invalid by a flag, then number
    the valid ones 1..n per supplier ordered by part (skew-safe numbering)."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_returnflag")
    valid = li.where(F.col("l_returnflag") != "R")
    return number_within(valid.drop("l_returnflag"), ["l_suppkey"],
                         ["l_partkey", "l_orderkey", "l_linenumber"], "line_number")


def first_per_customer(spark, sf):
    """WN4: attributes of each customer's first order (by date, then key)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", F.col("o_orderkey").alias("first_orderkey"),
        F.col("o_orderdate").alias("first_orderdate"), F.col("o_orderpriority").alias("first_priority"))


def keep_first_lines(spark, sf):
    """DS2: one line per (order, line number), the lowest (part, supplier),
    then quantity and ship date so the order is total."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_shipdate")
    return keep_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]) \
        .drop("l_shipdate")


def distinct_rows(spark, sf):
    """DS1: distinct rows over all selected columns."""
    return table(spark, sf, "part").select("p_brand", "p_type", "p_size").distinct()


def duplicate_groups(spark, sf):
    """SK2/AG7: key groups with more than one row."""
    li = table(spark, sf, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


ORACLE = {
    "q_oms_suborder_rollup": """
        WITH l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey * 100 + l_linenumber
                                                ORDER BY l_linenumber, l_partkey, l_suppkey, l_discount,
                                                         l_extendedprice, l_quantity) AS rn
                   FROM lineitem),
             tw AS (SELECT l_orderkey AS k, l_partkey AS p,
                           string_agg(DISTINCT 'WH' || CAST(l_suppkey AS VARCHAR), ', ' ORDER BY 'WH' || CAST(l_suppkey AS VARCHAR)) AS w
                    FROM lineitem GROUP BY 1, 2),
             x AS (SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderpriority, o.o_orderstatus,
                          l.l_quantity, l.l_extendedprice, l.l_discount, tw.w
                   FROM l JOIN orders o ON o.o_orderkey = l.l_orderkey
                          JOIN tw ON tw.k = l.l_orderkey AND tw.p = l.l_partkey
                   WHERE l.rn = 1)
        SELECT o_orderkey AS SUBORDER_ID, MAX(o_custkey) AS ORDER_ID, ROUND(SUM(o_totalprice), 2) AS TOTAL_AMOUNT,
               MAX(o_orderpriority) AS WAREHOUSE, COUNT(*) AS NUMBER_OF_ITEMS,
               ROUND(SUM(l_quantity), 2) AS NUMBER_OF_PRODUCTS, ROUND(SUM(l_extendedprice), 2) AS PRICE_TOTAL,
               MAX(l_discount) AS DISCOUNT,
               MAX(CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'V-' || CAST(o_custkey AS VARCHAR) END) AS PARTNER_VAT,
               '' AS CITY_NAME,
               COALESCE(STRING_AGG(NULLIF(w, ''), ', ' ORDER BY NULLIF(w, '')), '') AS TRANSFER_WAREHOUSE
        FROM x GROUP BY o_orderkey""",
    "q_header_rollup": """
        SELECT l_orderkey, MAX(l_partkey) AS l_partkey, MAX(l_suppkey) AS l_suppkey,
               MAX(l_linenumber) AS l_linenumber, MAX(l_returnflag) AS l_returnflag,
               MAX(l_linestatus) AS l_linestatus, MAX(l_shipdate) AS l_shipdate,
               ROUND(SUM(l_quantity), 2) AS l_quantity, ROUND(SUM(l_extendedprice), 2) AS l_extendedprice,
               ROUND(SUM(l_discount), 2) AS l_discount, ROUND(SUM(l_tax), 2) AS l_tax,
               LEFT(MAX(l_returnflag || '/' || l_linestatus || '/' || CAST(l_linenumber AS VARCHAR)), 3) AS line_text,
               COUNT(*) AS n_lines
        FROM lineitem GROUP BY l_orderkey""",
    "q_suborder_rollup": """
        SELECT o_orderkey, MAX(o_custkey) AS o_custkey, MAX(o_orderstatus) AS o_orderstatus,
               MAX(o_orderdate) AS o_orderdate, MAX(o_orderpriority) AS o_orderpriority,
               ROUND(SUM(o_totalprice), 2) AS sum_totalprice, ROUND(SUM(l_quantity), 2) AS sum_quantity,
               COALESCE(STRING_AGG(NULLIF(l_returnflag, ''), ', ' ORDER BY NULLIF(l_returnflag, '')), '') AS flags,
               COUNT(*) AS n_lines
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
    "q_changed_rollup": """
        SELECT l_orderkey, MAX(l_shipdate) AS l_shipdate, ROUND(SUM(l_quantity), 2) AS l_quantity,
               COUNT(*) AS n_lines
        FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem
                                           WHERE l_shipdate >= TIMESTAMP '2001-06-01 00:00:00')
        GROUP BY l_orderkey""",
    "q_mode_per_customer": """
        WITH p AS (SELECT o_custkey, o_orderpriority AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey
                          ORDER BY COUNT(*) DESC, o_orderpriority ASC) AS rn
                   FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL
                   GROUP BY o_custkey, o_orderpriority),
             s AS (SELECT o_custkey, o_orderstatus AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey
                          ORDER BY COUNT(*) DESC, o_orderstatus ASC) AS rn
                   FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
                   GROUP BY o_custkey, o_orderstatus)
        SELECT c.c_custkey, c.c_name, p.v AS mode_priority, s.v AS mode_status
        FROM customer c LEFT JOIN p ON c.c_custkey = p.o_custkey AND p.rn = 1
                        LEFT JOIN s ON c.c_custkey = s.o_custkey AND s.rn = 1""",
    "q_latest_per_user": """
        SELECT user_id, event_id, ts, event_type, value FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events) WHERE rn = 1""",
    "q_latest_address_join": """
        WITH latest AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
          WHERE rn = 1)
        SELECT c.c_custkey, c.c_name, n.n_name, l.o_orderkey AS latest_orderkey, l.o_orderstatus AS latest_status
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                        LEFT JOIN latest l ON c.c_custkey = l.o_custkey""",
    "q_line_numbering": """
        SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber,
               CAST(ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_partkey, l_orderkey, l_linenumber) AS INTEGER)
                 AS line_number
        FROM lineitem WHERE l_returnflag != 'R'""",
    "q_first_per_customer": """
        SELECT o_custkey, o_orderkey AS first_orderkey, o_orderdate AS first_orderdate,
               o_orderpriority AS first_priority FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS rn
          FROM orders) WHERE rn = 1""",
    "q_keep_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                                                l_quantity NULLS FIRST, l_shipdate NULLS FIRST) AS rn
          FROM lineitem) WHERE rn = 1""",
    "q_distinct_rows": "SELECT DISTINCT p_brand, p_type, p_size FROM part",
    "q_duplicate_groups": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
}

QUERIES = {
    "q_oms_suborder_rollup": oms_suborder_rollup_q,
    "q_header_rollup": header_rollup,
    "q_suborder_rollup": suborder_rollup,
    "q_changed_rollup": changed_rollup,
    "q_mode_per_customer": mode_per_customer,
    "q_latest_per_user": latest_per_user,
    "q_latest_address_join": latest_address_join,
    "q_line_numbering": line_numbering,
    "q_first_per_customer": first_per_customer,
    "q_keep_first": keep_first_lines,
    "q_distinct_rows": distinct_rows,
    "q_duplicate_groups": duplicate_groups,
}
