"""PL16: three-way reconciliation + alert, and the anti-join family it uses.

On the test tables ``orders`` plays the commerce / order-management header,
``lineitem`` the ERP sales lines (``l_orderkey`` the order number,
``l_returnflag`` the sales pool).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lookback_filter
from ..functions.text import html_link
from ..operators.dedupe import exclude_duplicated, not_in
from ..operators.reconcile import alert, missing_in, quantity_mismatch
from ..sources.tables import table

ASOF = "2001-08-01 00:00:00"
ORDER_LINK = "https://orders.example/orders/"


# Fixed values of the reconciliation (must equal the reference's).
ECOM_POOL = "ECOM"
PAID = "paid"
SHIPPING_ITEM = "DESPACHO"
CREDIT_NOTE_PREFIX = "NC-"
SUFFIXED_ORDER = "1"


def _start(asof, days):
    return F.lit(str(asof)[:10]).cast("date") - F.make_dt_interval(F.lit(days))


def oms_missing(suborders: DataFrame, erp_lines: DataFrame, asof, interval_days: int,
                link_base: str = "") -> DataFrame:
    """PL16 report 1 (JN1/FL4/FL7/SO1/PR17/PR19): suborders since ``asof -
    interval`` (day start) with no ERP line in the e-commerce pool carrying
    their e-commerce name; renamed, with a link, oldest first."""
    left = suborders.where(F.col("ORDER_DATE") >= _start(asof, interval_days).cast("timestamp_ntz"))
    out = missing_in(left, erp_lines, "ECOMMERCE_NAME", "PURCHORDERFORMNUM",
                     right_where=F.col("SALESPOOLID").like(ECOM_POOL))
    return out.select(F.col("ORDER_ID").alias("order_id"), F.col("ECOMMERCE_NAME").alias("order_number"),
                      html_link(link_base, "ORDER_ID", "ECOMMERCE_NAME").alias("order_link"),
                      F.col("ORDER_DATE").alias("created_at")).orderBy("created_at", "order_id")


def shop_missing(orders: DataFrame, erp_lines: DataFrame, asof, interval_days: int,
                 link_base: str = "") -> DataFrame:
    """PL16 report 2 (JN2/FL5): paid commerce orders processed after ``asof
    - interval`` with no ERP line in the e-commerce pool; by name."""
    left = orders.where((F.col("PROCESSED_AT") > F.lit(str(asof)).cast("timestamp_ntz")
                         - F.make_dt_interval(F.lit(interval_days)))
                        & (F.col("FINANCIAL_STATUS") == PAID))
    out = missing_in(left, erp_lines, "NAME", "PURCHORDERFORMNUM", right_where=F.col("SALESPOOLID").like(ECOM_POOL))
    return out.select(F.col("ORDER_ID").alias("order_id"), F.col("NAME").alias("order_number"),
                      html_link(link_base, "ORDER_ID", "NAME").alias("order_link"),
                      F.col("CREATED_AT").alias("created_at")).orderBy("order_number")


def quantity_discrepancies(shop_lines: DataFrame, erp_lines: DataFrame, asof, interval_days: int,
                           link_base: str = "") -> DataFrame:
    """PL16 report 3 (JN3-JN5/AG6/CV6/CV8/SO2/SO3): per commerce order of the
    period, line quantity (text, safely cast) vs the ERP quantity without the
    shipping item, joined on the order name = the ERP order number as a
    number, kept when they differ and the ERP has neither a credit note
    (``NC-`` + name) nor a suffixed order (name + ``1``)."""
    shop = shop_lines.where(F.col("CREATED_AT") >= _start(asof, interval_days).cast("timestamp_ntz"))
    erp = erp_lines.where(F.col("ITEMID") != SHIPPING_ITEM)
    r = quantity_mismatch(shop, ["ORDER_ID", "ORDER_NAME", "CREATED_AT"], F.col("ORDER_NAME").try_cast("decimal(38,0)"),
                          F.col("QUANTITY").try_cast("decimal(38,6)"),
                          erp, F.col("PURCHORDERFORMNUM").try_cast("decimal(38,0)"), F.col("QTY"),
                          "total_shop", "total_erp")
    name = F.col("ORDER_NAME").cast("string")
    r = missing_in(r, erp_lines, F.concat(F.lit(CREDIT_NOTE_PREFIX), name), "PURCHORDERFORMNUM")
    r = missing_in(r, erp_lines, F.concat(name, F.lit(SUFFIXED_ORDER)), "PURCHORDERFORMNUM")
    return r.select(F.col("ORDER_ID").alias("order_id"), F.col("ORDER_NAME").alias("order_number"),
                    html_link(link_base, "ORDER_ID", "ORDER_NAME").alias("order_link"),
                    F.col("CREATED_AT").alias("created_at"), F.col("total_shop").cast("double").alias("total_shop"),
                    F.col("total_erp").cast("int").alias("total_erp")) \
        .orderBy(F.col("order_number").try_cast("decimal(38,0)").desc())


def discrepancy_alert(oms: DataFrame, shop: DataFrame, qty: DataFrame, asof, max_days: int,
                      number_results: int) -> DataFrame:
    """PL16 alert (AG16/AG17/DT8): one row of counts, "older than
    ``max_days`` whole days" flags and the combined alert."""
    return alert({"oms": (oms, "created_at"), "shop": (shop, "created_at"), "qty": (qty, "created_at")},
                 asof, max_days, number_results)


def missing_in_erp(spark, sf, asof=ASOF, interval_days=212):
    """JN1/FL4/FL7/PR18/SO1: finished orders of the last ``interval_days``
    with no line in the ``R`` pool (right-side predicate in the ON clause)."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    left = o.where(lookback_filter("o_orderdate", asof, interval_days) & (F.col("o_orderstatus") == "F"))
    return missing_in(left, li, "o_orderkey", "l_orderkey",
                      right_where=F.col("l_returnflag").like("R")).orderBy("o_orderdate", "o_orderkey")


def paid_missing(spark, sf, asof=ASOF, interval_days=90):
    """JN2/FL5: open orders newer than ``asof - interval`` absent from the
    ``O`` line pool, with the report link (PR17) and renamed columns (PR19)."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    left = o.where((F.col("o_orderdate") > F.lit(asof).cast("timestamp_ntz") - F.make_dt_interval(F.lit(interval_days)))
                   & (F.col("o_orderstatus") == "O"))
    out = missing_in(left, li, "o_orderkey", "l_orderkey", right_where=F.col("l_linestatus").like("O"))
    return (out.select(html_link(ORDER_LINK, "o_orderkey", "o_orderkey").alias("order_link"),
                       F.col("o_orderkey").alias("order_id"),
                       F.col("o_orderdate").alias("created_at"))
            .orderBy(F.col("order_id").desc()))


def qty_mismatch(spark, sf):
    """JN3/AG6/CV8/FL5: per order, line quantity total vs the total of the
    non-returned lines (cast to int), kept when they differ."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    shop = o.join(li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "o_custkey", "o_orderdate", "l_quantity")
    erp = li.where(F.col("l_returnflag") != "R")
    r = quantity_mismatch(shop, ["o_orderkey", "o_custkey", "o_orderdate"], "o_orderkey", F.col("l_quantity"),
                          erp, "l_orderkey", F.col("l_quantity"), "total_shop", "total_erp")
    return r.select("o_orderkey", "o_custkey", "o_orderdate",
                    F.round("total_shop", 2).alias("total_shop"),
                    F.col("total_erp").cast("int").alias("total_erp"))


def not_exists_computed(spark, sf):
    """JN5/ST9: orders with no order keyed ``'NC-' || k`` nor ``k || '1'``
    (correlated NOT EXISTS on computed text keys as two anti joins)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("txt"))
    k = F.col("o_orderkey").cast("string")
    a = missing_in(o, keys, F.concat(F.lit("NC-"), k), "txt")
    return missing_in(a, keys, F.concat(k, F.lit("1")), "txt")


def safe_cast_join(spark, sf):
    """JN4/CV6/SO2: text order numbers (returns prefixed ``NC-``) joined to
    numeric order keys through a safe numeric cast; sorted by that cast."""
    li = table(spark, sf, "lineitem")
    txt = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("NC-"), F.col("l_orderkey").cast("string"))) \
        .otherwise(F.col("l_orderkey").cast("string"))
    erp = li.groupBy(txt.alias("order_text")).agg(F.round(F.sum("l_quantity"), 2).alias("total_qty"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    num = F.col("order_text").try_cast("decimal(38,0)")
    return (o.join(erp, F.col("o_orderkey") == num, "inner")
            .orderBy(num).select("o_orderkey", "o_orderstatus", "order_text", "total_qty"))


def not_in_dups(spark, sf):
    """JN6/AG7: lines of orders that own no duplicated (order, line) group."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return exclude_duplicated(li, ["l_orderkey", "l_linenumber"], "l_orderkey")


def not_in_null_aware(spark, sf):
    """JN6/Q12: same with a nullable entity; a null inside the duplicate
    groups makes ``NOT IN`` empty the result."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_orderkey")).alias("entity"),
        "l_linenumber", "l_partkey")
    return exclude_duplicated(li, ["entity", "l_linenumber"], "entity")


def move_item_excluded(spark, sf):
    """AG4/JN6/FL6/DS3: quantity per order for orders holding no PROMO part
    (``NOT IN`` a distinct key list), ``HAVING SUM > 0``."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    promo = li.join(p, li.l_partkey == p.p_partkey).where(F.upper("p_type") == "PROMO") \
        .select("l_orderkey").distinct()
    kept = not_in(li, "l_orderkey", promo, "l_orderkey")
    return (kept.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total_qty"))
            .where(F.col("total_qty") > 0).select("l_orderkey", F.round("total_qty", 2).alias("total_qty")))


def alert_report(spark, sf, asof=ASOF, max_days=60, min_rows=100):
    """PL16/AG16/AG17/DT8: one row with the three report counts, whether any report row
    is older than ``max_days`` whole days (DT8), and the combined alert."""
    oms = missing_in_erp(spark, sf, asof)
    shop = table(spark, sf, "orders").where(
        (F.col("o_orderdate") > F.lit(asof).cast("timestamp_ntz") - F.make_dt_interval(F.lit(90)))
        & (F.col("o_orderstatus") == "O"))
    shop = missing_in(shop, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey",
                      right_where=F.col("l_linestatus").like("O"))
    qty = qty_mismatch(spark, sf).where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return alert({"oms": (oms, "o_orderdate"), "shop": (shop, "o_orderdate"),
                  "qty": (qty, "o_orderdate")}, asof, max_days, min_rows)


ORACLE = {
    "q_missing_in_erp": """
        SELECT s.* FROM orders s
        LEFT JOIN lineitem e ON s.o_orderkey = e.l_orderkey AND e.l_returnflag LIKE 'R'
        WHERE e.l_orderkey IS NULL AND s.o_orderstatus = 'F'
          AND s.o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 212 DAY
        ORDER BY s.o_orderdate""",
    "q_paid_missing": """
        SELECT '<a href="https://orders.example/orders/' || CAST(s.o_orderkey AS VARCHAR)
               || '" target="_blank">' || CAST(s.o_orderkey AS VARCHAR) || '</a>' AS order_link,
               s.o_orderkey AS order_id, s.o_orderdate AS created_at
        FROM orders s
        LEFT JOIN lineitem e ON s.o_orderkey = e.l_orderkey AND e.l_linestatus LIKE 'O'
        WHERE e.l_orderkey IS NULL AND s.o_orderstatus = 'O'
          AND s.o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 90 DAY""",
    "q_qty_mismatch": """
        SELECT shop.o_orderkey, shop.o_custkey, shop.o_orderdate,
               ROUND(shop.total_shop, 2) AS total_shop, CAST(TRUNC(erp.total_erp) AS INTEGER) AS total_erp
        FROM (SELECT o_orderkey, o_custkey, o_orderdate, SUM(l_quantity) AS total_shop
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              GROUP BY o_orderkey, o_custkey, o_orderdate) shop
        JOIN (SELECT l_orderkey, SUM(l_quantity) AS total_erp FROM lineitem
              WHERE l_returnflag != 'R' GROUP BY l_orderkey) erp
          ON shop.o_orderkey = erp.l_orderkey
        WHERE shop.total_shop != erp.total_erp""",
    "q_not_exists_computed": """
        SELECT o.o_orderkey, o.o_orderstatus FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE CAST(e.o_orderkey AS VARCHAR) = 'NC-' || CAST(o.o_orderkey AS VARCHAR))
          AND NOT EXISTS (SELECT 1 FROM orders e WHERE CAST(e.o_orderkey AS VARCHAR) = CAST(o.o_orderkey AS VARCHAR) || '1')""",
    "q_safe_cast_join": """
        WITH erp AS (
          SELECT CASE WHEN l_returnflag = 'R' THEN 'NC-' || CAST(l_orderkey AS VARCHAR)
                      ELSE CAST(l_orderkey AS VARCHAR) END AS order_text,
                 ROUND(SUM(l_quantity), 2) AS total_qty
          FROM lineitem GROUP BY 1)
        SELECT o.o_orderkey, o.o_orderstatus, erp.order_text, erp.total_qty
        FROM orders o JOIN erp ON o.o_orderkey = TRY_CAST(erp.order_text AS DECIMAL(38,0))""",
    "q_not_in_dups": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber
                                 HAVING COUNT(*) > 1)""",
    "q_not_in_null_aware": """
        WITH t AS (SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS entity,
                          l_linenumber, l_partkey FROM lineitem)
        SELECT * FROM t WHERE entity NOT IN (SELECT entity FROM t GROUP BY entity, l_linenumber
                                             HAVING COUNT(*) > 1)""",
    "q_move_item_excluded": """
        SELECT l_orderkey, ROUND(SUM(l_quantity), 2) AS total_qty FROM lineitem
        WHERE l_orderkey NOT IN (SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey
                                 WHERE UPPER(p_type) = 'PROMO')
        GROUP BY l_orderkey HAVING SUM(l_quantity) > 0""",
    "q_alert": """
        WITH oms AS (
          SELECT s.o_orderdate AS ts FROM orders s
          LEFT JOIN lineitem e ON s.o_orderkey = e.l_orderkey AND e.l_returnflag LIKE 'R'
          WHERE e.l_orderkey IS NULL AND s.o_orderstatus = 'F'
            AND s.o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 212 DAY),
        shop AS (
          SELECT s.o_orderdate AS ts FROM orders s
          LEFT JOIN lineitem e ON s.o_orderkey = e.l_orderkey AND e.l_linestatus LIKE 'O'
          WHERE e.l_orderkey IS NULL AND s.o_orderstatus = 'O'
            AND s.o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 90 DAY),
        qty AS (
          SELECT shop.o_orderdate AS ts
          FROM (SELECT o_orderkey, o_orderdate, SUM(l_quantity) AS a FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                GROUP BY o_orderkey, o_custkey, o_orderdate) shop
          JOIN (SELECT l_orderkey, SUM(l_quantity) AS b FROM lineitem WHERE l_returnflag != 'R' GROUP BY l_orderkey) erp
            ON shop.o_orderkey = erp.l_orderkey
          WHERE shop.a != erp.b AND shop.o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'),
        s AS (
          SELECT (SELECT COUNT(*) FROM oms) AS oms_count,
                 COALESCE((SELECT BOOL_OR(FLOOR(EPOCH(TIMESTAMP '2001-08-01 00:00:00' - ts) / 86400) > 60) FROM oms), FALSE) AS oms_older,
                 (SELECT COUNT(*) FROM shop) AS shop_count,
                 COALESCE((SELECT BOOL_OR(FLOOR(EPOCH(TIMESTAMP '2001-08-01 00:00:00' - ts) / 86400) > 60) FROM shop), FALSE) AS shop_older,
                 (SELECT COUNT(*) FROM qty) AS qty_count,
                 COALESCE((SELECT BOOL_OR(FLOOR(EPOCH(TIMESTAMP '2001-08-01 00:00:00' - ts) / 86400) > 60) FROM qty), FALSE) AS qty_older)
        SELECT *, (oms_older OR oms_count >= 100 OR shop_older OR shop_count >= 100
                   OR qty_older OR qty_count >= 100) AS alert FROM s""",
}

QUERIES = {
    "q_missing_in_erp": missing_in_erp,
    "q_paid_missing": paid_missing,
    "q_qty_mismatch": qty_mismatch,
    "q_not_exists_computed": not_exists_computed,
    "q_safe_cast_join": safe_cast_join,
    "q_not_in_dups": not_in_dups,
    "q_not_in_null_aware": not_in_null_aware,
    "q_move_item_excluded": move_item_excluded,
    "q_alert": alert_report,
}
