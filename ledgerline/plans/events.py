"""PL17: retail sales -> marketing event documents (JN7, JN8, JN13, WN1, WN4,
FL3, FL9, DT6, NU3, AG11-AG15, AG18, ST5, ST12, ST13, JS2).

The reference walks rows in Python, keeps a dict per customer and sale, and
asks an external service per customer whether a profile exists.  Here the
job reads the sales of 13 months once, with a flag for the period's own
lines.  One aggregate gives each customer's first lines; the e-mail cascade
(ERP customer, sale line, latest shipping address) and the profile check, a
join to a ``profiles`` table, then work on one row a customer.  A bit map of
the customers without a profile filters the older lines before they are
shuffled; what remains is joined to the variant table, grouped once by
``(customer, sale)`` and written by ``to_json``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casts as C
from ..functions import dates as D
from ..functions import text as T
from ..functions.arrays import distinct_of_lists
from ..operators.dedupe import latest_by
from ..operators.membership import maybe_member
from ..session import ensure_checkpoint_dir
from ..sources.tables import table

# Fixed values of the event documents (reference constants).
AVOID_ACCOUNTS = ("55555555-5", "66666666-6", "22222222-2")
RETAIL_COST_CENTRE = "Retail"
CURRENCY = "CLP"
DEFAULT_VENDOR = "VENDOR"  # the seller's name is configuration (retail_events(vendor=...))
SOURCE_NAME = "retail"
LINE_GRAMS = 200
IMAGE_SIZE = 2000

_ARRIVAL = ["SALESID", "LINENUM", "SALESLINEPK"]


def period_lines(sales: DataFrame, back, start, end) -> DataFrame:
    """JN7/FL3/FL9: retail lines of ``[back, end]`` of accounts that count, with
    IN_PERIOD: is the line of ``[start, end]``."""
    return (sales.where(D.between_days("INVOICEDATE", back, end) & (F.col("CECO") == RETAIL_COST_CENTRE)
                        & ~F.col("CUSTACCOUNT").isin(*AVOID_ACCOUNTS))
            .withColumn("IN_PERIOD", D.between_days("INVOICEDATE", start, end)))


def customers_of(lines: DataFrame, erp_customers: DataFrame, shop_addresses: DataFrame, profiles: DataFrame) -> DataFrame:
    """JN7/JN8/WN1/WN4/NU3: one row per customer with a line of the period that has an e-mail.

    A line's e-mail is the first truthy one of ERP primary contact, ERP receipt
    mail, the sale line and the latest shipping address (by order id as text,
    descending).  NEW: the first such line's e-mail has no profile.  EMAIL and
    FULL_NAME come from the customer's first line with an e-mail (arrival
    order: sale, line number, line key), for new customers among all lines.
    HAS_EMAIL: every line has one, also without one of its own.
    """
    own, arrival = F.nullif("PRIMARYCONTACTEMAIL", F.lit("")), F.struct(*_ARRIVAL)
    line = F.struct(own.alias("own"), F.col("ORGANIZATIONNAME").alias("name"))
    firsts = lines.groupBy("CUSTACCOUNT").agg(
        F.min_by(line, F.when(F.col("IN_PERIOD"), arrival)).alias("period_any"),
        F.min_by(line, F.when(F.col("IN_PERIOD") & own.isNotNull(), arrival)).alias("period_own"),
        F.min_by(line, arrival).alias("all_any"), F.min_by(line, F.when(own.isNotNull(), arrival)).alias("all_own")) \
        .where(F.col("period_any").isNotNull())
    latest = latest_by(shop_addresses.select("CUSTOMER_ID", "ORDER_ID", "EMAIL"), ["CUSTOMER_ID"], ["ORDER_ID"])
    contacts = erp_customers.groupBy("CUSTOMERACCOUNT").agg(F.min(F.struct("PRIMARYCONTACTEMAIL", "RECEIPTEMAIL")).alias("erp"))
    j = firsts.join(contacts, F.col("CUSTACCOUNT") == F.col("CUSTOMERACCOUNT"), "left") \
        .join(latest.select("CUSTOMER_ID", F.col("EMAIL").alias("shop")), F.col("CUSTACCOUNT") == F.col("CUSTOMER_ID"), "left")
    has = C.first_truthy("erp.PRIMARYCONTACTEMAIL", "erp.RECEIPTEMAIL", "shop").isNotNull()

    def chosen(any_, own_):
        mail = C.first_truthy("erp.PRIMARYCONTACTEMAIL", "erp.RECEIPTEMAIL", f"{any_}.own", "shop")
        return F.when(has, F.struct(mail.alias("EMAIL"), F.col(f"{any_}.name").alias("FULL_NAME"))) \
            .when(F.col(own_).isNotNull(), F.struct(F.col(f"{own_}.own").alias("EMAIL"), F.col(f"{own_}.name").alias("FULL_NAME")))

    c = j.select("CUSTACCOUNT", has.alias("HAS_EMAIL"), chosen("period_any", "period_own").alias("in_period"), chosen("all_any", "all_own").alias("in_all")) \
        .where(F.col("in_period").isNotNull())
    known = profiles.select(F.col("EMAIL").alias("_profile")).distinct()
    c = c.join(known, F.col("in_period.EMAIL") == F.col("_profile"), "left").withColumn("NEW", F.col("_profile").isNull())
    return c.withColumn("_c", F.when(F.col("NEW"), F.col("in_all")).otherwise(F.col("in_period"))).select("CUSTACCOUNT", "HAS_EMAIL", "NEW", "_c.*")


def with_variants(lines: DataFrame, variants: DataFrame) -> DataFrame:
    """ST5/JN13: SKU ``item-color-size`` joined to the variant table; a SKU
    listed twice takes its last row (largest variant id)."""
    # few SKUs repeat: dealt out first, they are sorted where they are joined and not in the few tasks that read the table
    v = latest_by(variants.where(F.col("VARIANT_SKU").isNotNull()).repartition("VARIANT_SKU"), ["VARIANT_SKU"], ["VARIANT_ID"])
    lines = lines.withColumn("SKU", T.key_text("ITEMID", "INVENTCOLORID", "INVENTSIZEID"))
    return lines.join(v, lines.SKU == v.VARIANT_SKU, "left").drop("VARIANT_SKU")


def _event_docs(sale: DataFrame, show_location: Column, vendor: str = DEFAULT_VENDOR) -> Column:
    lines = F.col("lines")
    store = F.col("CANAL")
    name = F.when(show_location, T.sale_event_name("INVOICEID", store)).otherwise(T.sale_event_name("INVOICEID"))
    money = lambda v: F.struct(F.struct(v.alias("amount"), F.lit(CURRENCY).alias("currency_code")).alias("shop_money"),
                               F.struct(v.alias("amount"), F.lit(CURRENCY).alias("currency_code")).alias("presentment_money"))
    image = lambda l: F.array(F.struct(l["IMAGE_SRC"].alias("src"), l["IMAGE_SRC"].alias("thumb_src"),
                                       l["IMAGE_ALT"].alias("alt"), F.lit(IMAGE_SIZE).alias("width"),
                                       F.lit(IMAGE_SIZE).alias("height"), F.lit(1).alias("position"),
                                       l["IMAGE_ID"].alias("id")))
    line_item = lambda l: F.struct(
        l["VARIANT_ID"].alias("id"), l["QTY"].alias("fulfillable_quantity"),
        F.lit("manual").alias("fulfillment_service"), F.lit("fulfilled").alias("fulfillment_status"),
        F.lit(False).alias("gift_card"), F.lit(LINE_GRAMS).alias("grams"), l["PRODUCT_TITLE"].alias("name"),
        l["PRICE"].alias("price"), money(l["PRICE"]).alias("price_set"), F.lit(True).alias("product_exists"),
        l["PRODUCT_ID"].alias("product_id"), l["QTY"].alias("quantity"), F.lit(True).alias("requires_shipping"),
        l["SKU"].alias("sku"), F.lit(False).alias("taxable"), l["PRODUCT_TITLE"].alias("title"),
        F.lit("0").alias("total_discount"), l["VARIANT_ID"].alias("variant_id"),
        F.lit("shopify").alias("variant_inventory_management"), F.lit(vendor).alias("vendor"),
        l["PRICE"].alias("line_price"),
        F.struct(l["PRODUCT_ID"].alias("id"), l["PRODUCT_TITLE"].alias("title"), l["PRODUCT_HANDLE"].alias("handle"),
                 F.lit(vendor).alias("vendor"), l["PRODUCT_TYPE"].alias("product_type"), image(l).alias("images"),
                 F.struct(l["SKU"].alias("sku"), image(l).alias("images")).alias("variant")).alias("product"))
    total = F.col("total")
    shop_shape = F.struct(
        name.alias("event"),
        F.struct(T.first_word(F.col("FULL_NAME")).alias("$first_name"), T.rest_words(F.col("FULL_NAME")).alias("$last_name"),
                 F.col("EMAIL").alias("$email"), F.col("CUSTACCOUNT").alias("$organization")).alias("customer_properties"),
        F.col("event_time").alias("time"),
        F.struct(F.transform(lines, lambda l: l["PRODUCT_TITLE"]).alias("Items"), F.col("tags").alias("Collections"),
                 F.col("item_count").alias("Item Count"), F.array().cast("array<string>").alias("tags"),
                 F.lit(False).alias("OptedInToSmsOrderUpdates"), F.array().cast("array<string>").alias("Discount Codes"),
                 F.lit("0").alias("Total Discounts"), F.col("SALESID").alias("Order ID"), store.alias("Location"),
                 F.lit(SOURCE_NAME).alias("Source Name"),
                 F.struct(F.col("SALESID").alias("id"), F.col("EMAIL").alias("contact_email"),
                          F.lit(CURRENCY).alias("currency"), total.alias("current_subtotal_price"),
                          money(total).alias("current_subtotal_price_set"), total.alias("total_line_items_price"),
                          total.alias("total_price"), money(total).alias("total_price_set"),
                          F.lit("0").alias("total_outstanding"), F.lit(LINE_GRAMS).alias("total_weight"),
                          F.col("event_time").alias("updated_at"),
                          F.transform(lines, line_item).alias("line_items")).alias("extra"),
                 total.alias("$value"), store.alias("$location")).alias("properties"))
    custom_shape = F.struct(
        name.alias("event"), F.struct(F.col("EMAIL").alias("$email")).alias("customer_properties"),
        F.col("event_time").alias("time"),
        F.struct(F.col("SALESID").alias("Order ID"), F.col("tags").alias("Categories"),
                 F.transform(lines, lambda l: l["PRODUCT_TITLE"]).alias("ItemNames"),
                 F.transform(lines, lambda l: l["SKU"]).alias("Skus"), store.alias("RetailStore"),
                 total.alias("$value")).alias("properties"))
    return name, F.when(F.col("all_matched"), F.to_json(shop_shape)).otherwise(F.to_json(custom_shape))


def retail_events(sales: DataFrame, erp_customers: DataFrame, shop_addresses: DataFrame,
                  variants: DataFrame, profiles: DataFrame, start, end,
                  vendor: str = DEFAULT_VENDOR) -> DataFrame:
    """PL17/AR5: one event document per (customer, sale) and location flag
    (line lists mapped to lists of item structs with ``transform``).

    Customers whose e-mail has no profile get the sales of the 12 months
    before ``start`` too (DT7).  Each sale yields two events, without and
    with the store in the event name.  Per customer, e-mail and name come
    from its first line with an e-mail (:func:`customers_of`); per sale the
    store, time and invoice come from its first line.  The document takes the full commerce shape when every line
    found a variant (AG14), else the short shape.
    """
    start_d = start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start)[:10])
    leap_day = start_d.month == 2 and start_d.day == 29  # the month's last day a year before, as add_months has it
    back = start_d.replace(year=start_d.year - 1, day=28 if leap_day else start_d.day)
    # the sales are read once: the customers' aggregate and the event lines both read what is written here
    ensure_checkpoint_dir(sales.sparkSession)
    used = ["CUSTACCOUNT", *_ARRIVAL, "PRIMARYCONTACTEMAIL", "ORGANIZATIONNAME", "IN_PERIOD", "CANAL", "CREATEDTRANSACTIONDATE2", "INVOICEID",
            "ITEMID", "INVENTCOLORID", "INVENTSIZEID", "QTY", "LINEAMOUNTWITHTAXES"]
    lines = period_lines(sales, back, start, end).select(*used).checkpoint()
    customers = customers_of(lines, erp_customers, shop_addresses, profiles).checkpoint()
    new = customers.where("NEW")
    older = maybe_member(lines.where("NOT IN_PERIOD"), "CUSTACCOUNT", new.select("CUSTACCOUNT"), "_new").where("_new").select(*used)
    lines = lines.where("IN_PERIOD").join(customers, "CUSTACCOUNT").unionByName(older.join(new, "CUSTACCOUNT")) \
        .where(F.col("HAS_EMAIL") | C.truthy("PRIMARYCONTACTEMAIL"))
    line = F.struct(*[F.col(c) for c in _ARRIVAL], "SKU", "QTY", F.col("LINEAMOUNTWITHTAXES").alias("PRICE"),
                    "VARIANT_ID", "PRODUCT_ID", "PRODUCT_TITLE", "PRODUCT_TYPE", "PRODUCT_HANDLE",
                    "IMAGE_ID", "IMAGE_ALT", "IMAGE_SRC", "PRODUCT_TAGS")
    first_line = F.min_by(F.struct("CANAL", "CREATEDTRANSACTIONDATE2", "INVOICEID"), F.struct(*_ARRIVAL))
    sale = with_variants(lines, variants).groupBy("CUSTACCOUNT", "SALESID").agg(
        first_line.alias("_s"), F.any_value("EMAIL").alias("EMAIL"), F.any_value("FULL_NAME").alias("FULL_NAME"),
        F.array_sort(F.collect_list(line)).alias("lines"), F.bool_and(F.col("VARIANT_ID").isNotNull()).alias("all_matched"),
        F.round(F.sum("LINEAMOUNTWITHTAXES"), 2).alias("total"), F.count(F.lit(1)).alias("item_count"))
    sale = sale.select("*", "_s.*", distinct_of_lists(F.transform("lines", lambda x: T.split_list(x["PRODUCT_TAGS"]))).alias("tags")).drop("_s") \
        .withColumn("event_time", D.iso_utc_text("CREATEDTRANSACTIONDATE2"))
    ev = sale.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("show_location"))
    name, doc = _event_docs(ev, F.col("show_location"), vendor)
    return ev.select("CUSTACCOUNT", "SALESID", "show_location", name.alias("event"), "EMAIL", "all_matched",
                     "total", "item_count", F.array_join("tags", ", ").alias("tags"), "event_time",
                     doc.alias("document"))


# ------------------------------------------------------- test-table inputs
def _event_inputs(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    c, p = table(spark, sf, "customer"), table(spark, sf, "part")
    acct = F.when(F.col("c_acctbal") < 0, F.lit(AVOID_ACCOUNTS[0])).otherwise(F.concat(F.lit("C"), F.col("c_custkey").cast("string")))
    s = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    sales = s.select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("SALESID"),
        F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("SALESLINEPK"),
        F.col("l_linenumber").alias("LINENUM"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("61-"), F.col("l_orderkey").cast("string")))
         .otherwise(F.concat(F.lit("1-"), F.col("l_orderkey").cast("string"))).alias("INVOICEID"),
        acct.alias("CUSTACCOUNT"), F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment")).alias("ORGANIZATIONNAME"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lower("c_name"), F.lit("@line.example"))).alias("PRIMARYCONTACTEMAIL"),
        F.concat(F.lit("Store "), F.col("o_orderpriority")).alias("CANAL"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Online")).otherwise(F.lit("Retail")).alias("CECO"),
        F.to_date("l_shipdate").alias("INVOICEDATE"), F.col("o_orderdate").alias("CREATEDTRANSACTIONDATE2"),
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("ITEMID"),
        F.col("l_returnflag").alias("INVENTCOLORID"), F.col("l_linestatus").alias("INVENTSIZEID"),
        F.col("l_quantity").alias("QTY"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * (1 + F.col("l_tax").cast("decimal(18,2)")), 2)
        .cast("double").alias("LINEAMOUNTWITHTAXES"))
    erp = c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("CUSTOMERACCOUNT"),
                   F.when(F.col("c_acctbal") > 5000, F.concat(F.lower("c_name"), F.lit("@erp.example"))).alias("PRIMARYCONTACTEMAIL"),
                   F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lower("c_name"), F.lit("@receipt.example")))
                    .otherwise(F.lit("")).alias("RECEIPTEMAIL"))
    addrs = o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("CUSTOMER_ID"),
                     F.col("o_orderkey").cast("string").alias("ORDER_ID"),
                     F.when(F.col("o_orderpriority") != "5-LOW",
                            F.concat(F.lit("shop"), F.col("o_orderkey").cast("string"), F.lit("@shop.example"))).alias("EMAIL"))
    suffix = F.explode(F.array(F.lit("-N-O"), F.lit("-N-F"), F.lit("-A-F"), F.lit("-A-O")))
    variants = p.select("*", suffix.alias("sfx")).select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string"), F.col("sfx")).alias("VARIANT_SKU"),
        (F.col("p_partkey") + F.when(F.col("sfx") == "-A-O", F.lit(0)).otherwise(F.lit(100000))).alias("VARIANT_ID"),
        F.col("p_partkey").alias("PRODUCT_ID"), F.col("p_name").alias("PRODUCT_TITLE"),
        F.col("p_type").alias("PRODUCT_TYPE"), F.concat(F.lit("h-"), F.col("p_partkey").cast("string")).alias("PRODUCT_HANDLE"),
        F.concat(F.col("p_type"), F.lit(", "), F.col("p_brand")).alias("PRODUCT_TAGS"),
        F.concat(F.lit("img"), F.col("p_partkey").cast("string")).alias("IMAGE_ID"), F.col("p_name").alias("IMAGE_ALT"),
        F.concat(F.lit("https://img.example/"), F.col("p_partkey").cast("string")).alias("IMAGE_SRC"))
    # a second row for one SKU family: the lookup must keep the last (largest id)
    variants = variants.unionByName(variants.where(F.col("VARIANT_SKU").endswith("-N-O"))
                                    .withColumn("VARIANT_ID", F.col("VARIANT_ID") + 500000)
                                    .withColumn("PRODUCT_TAGS", F.concat(F.col("PRODUCT_TAGS"), F.lit(", dup"))))
    profiles = c.where(F.col("c_acctbal") > 5000).select(F.concat(F.lower("c_name"), F.lit("@erp.example")).alias("EMAIL"))
    return sales, erp, addrs, variants, profiles


def build_events(spark, sf):
    """PL17/JS2/AR5/AG11-AG15/JN13/ST13: event documents for Q1 1998; the
    scalar parts are read back out of the JSON document."""
    sales, erp, addrs, variants, profiles = _event_inputs(spark, sf)
    ev = retail_events(sales, erp, addrs, variants, profiles, "1998-01-01", "1998-03-31")
    d = F.col("document")
    return ev.select("CUSTACCOUNT", "SALESID", "show_location", "event", "EMAIL", "all_matched", "total",
                     "item_count", "tags", "event_time",
                     F.get_json_object(d, "$.properties['Order ID']").alias("doc_order_id"),
                     F.get_json_object(d, "$.properties['$value']").cast("double").alias("doc_value"),
                     F.get_json_object(d, "$.event").alias("doc_event"))


_EVENTS_SQL = """
WITH sales AS (
  SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS SALESID,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS SALESLINEPK,
         l_linenumber AS LINENUM,
         CASE WHEN o_orderstatus = 'F' THEN '61-' ELSE '1-' END || CAST(l_orderkey AS VARCHAR) AS INVOICEID,
         CASE WHEN c_acctbal < 0 THEN '55555555-5' ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS CUSTACCOUNT,
         c_name || ' ' || c_mktsegment AS ORGANIZATIONNAME,
         CASE WHEN l_linenumber = 1 THEN lower(c_name) || '@line.example' END AS PRIMARYCONTACTEMAIL,
         'Store ' || o_orderpriority AS CANAL,
         CASE WHEN o_orderstatus = 'P' THEN 'Online' ELSE 'Retail' END AS CECO,
         CAST(l_shipdate AS DATE) AS INVOICEDATE, o_orderdate AS CTD,
         'I' || CAST(l_partkey AS VARCHAR) || '-' || l_returnflag || '-' || l_linestatus AS SKU,
         l_quantity AS QTY,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(18,2))), 2) AS DOUBLE) AS PRICE
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
erp AS (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_acctbal > 5000 THEN lower(c_name) || '@erp.example' END AS pc,
               CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) || '@receipt.example' ELSE '' END AS rc
        FROM customer),
addr AS (SELECT CUSTOMER_ID, EMAIL FROM (
           SELECT 'C' || CAST(o_custkey AS VARCHAR) AS CUSTOMER_ID, CAST(o_orderkey AS VARCHAR) AS ORDER_ID,
                  CASE WHEN o_orderpriority != '5-LOW' THEN 'shop' || CAST(o_orderkey AS VARCHAR) || '@shop.example' END AS EMAIL,
                  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR) DESC) AS rn
           FROM orders) WHERE rn = 1),
lines_all AS (
  SELECT s.*, COALESCE(NULLIF(e.pc, ''), NULLIF(e.rc, ''), NULLIF(s.PRIMARYCONTACTEMAIL, ''), NULLIF(a.EMAIL, '')) AS LINE_EMAIL
  FROM sales s LEFT JOIN erp e ON s.CUSTACCOUNT = e.id LEFT JOIN addr a ON s.CUSTACCOUNT = a.CUSTOMER_ID
  WHERE s.CECO = 'Retail' AND s.CUSTACCOUNT NOT IN ('55555555-5', '66666666-6', '22222222-2')),
base AS (SELECT * FROM lines_all WHERE LINE_EMAIL IS NOT NULL AND INVOICEDATE BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'),
first0 AS (SELECT CUSTACCOUNT, LINE_EMAIL FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY CUSTACCOUNT ORDER BY SALESID, LINENUM, SALESLINEPK) AS rn FROM base)
           WHERE rn = 1),
profiles AS (SELECT DISTINCT lower(c_name) || '@erp.example' AS EMAIL FROM customer WHERE c_acctbal > 5000),
new AS (SELECT CUSTACCOUNT FROM first0 WHERE LINE_EMAIL NOT IN (SELECT EMAIL FROM profiles)),
lines AS (
  SELECT * FROM base WHERE CUSTACCOUNT NOT IN (SELECT CUSTACCOUNT FROM new)
  UNION ALL
  SELECT * FROM lines_all WHERE LINE_EMAIL IS NOT NULL AND INVOICEDATE BETWEEN DATE '1997-01-01' AND DATE '1998-03-31'
    AND CUSTACCOUNT IN (SELECT CUSTACCOUNT FROM new)),
var0 AS (
  SELECT 'I' || CAST(p_partkey AS VARCHAR) || sfx AS VARIANT_SKU,
         p_partkey + CASE WHEN sfx = '-A-O' THEN 0 ELSE 100000 END AS VARIANT_ID,
         p_type || ', ' || p_brand AS PRODUCT_TAGS
  FROM (SELECT *, UNNEST(['-N-O', '-N-F', '-A-F', '-A-O']) AS sfx FROM part)),
var1 AS (SELECT * FROM var0 UNION ALL
         SELECT VARIANT_SKU, VARIANT_ID + 500000, PRODUCT_TAGS || ', dup' FROM var0 WHERE VARIANT_SKU LIKE '%-N-O'),
var AS (SELECT VARIANT_SKU, VARIANT_ID, PRODUCT_TAGS FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY VARIANT_SKU ORDER BY VARIANT_ID DESC) AS rn FROM var1) WHERE rn = 1),
lv AS (SELECT l.*, v.VARIANT_ID, v.PRODUCT_TAGS FROM lines l LEFT JOIN var v ON l.SKU = v.VARIANT_SKU),
cust AS (SELECT CUSTACCOUNT, LINE_EMAIL AS EMAIL FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY CUSTACCOUNT ORDER BY SALESID, LINENUM, SALESLINEPK) AS rn FROM lv)
         WHERE rn = 1),
firstline AS (SELECT CUSTACCOUNT, SALESID, CANAL, CTD, INVOICEID FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY CUSTACCOUNT, SALESID ORDER BY SALESID, LINENUM, SALESLINEPK) AS rn FROM lv)
         WHERE rn = 1),
tags AS (SELECT CUSTACCOUNT, SALESID, string_agg(DISTINCT t, ', ' ORDER BY t) AS tags
         FROM (SELECT CUSTACCOUNT, SALESID, UNNEST(string_split(PRODUCT_TAGS, ', ')) AS t FROM lv
               WHERE PRODUCT_TAGS IS NOT NULL AND PRODUCT_TAGS != '')
         GROUP BY 1, 2),
agg AS (SELECT CUSTACCOUNT, SALESID, BOOL_AND(VARIANT_ID IS NOT NULL) AS all_matched,
               ROUND(SUM(PRICE), 2) AS total, COUNT(*) AS item_count
        FROM lv GROUP BY 1, 2),
sale AS (
  SELECT a.*, f.CANAL, f.CTD, f.INVOICEID, COALESCE(t.tags, '') AS tags, c.EMAIL
  FROM agg a JOIN firstline f ON a.CUSTACCOUNT = f.CUSTACCOUNT AND a.SALESID = f.SALESID
             LEFT JOIN tags t ON a.CUSTACCOUNT = t.CUSTACCOUNT AND a.SALESID = t.SALESID
             JOIN cust c ON a.CUSTACCOUNT = c.CUSTACCOUNT),
ev AS (
  SELECT *, CASE WHEN starts_with(INVOICEID, '61-') THEN '[NC] Placed retail return' ELSE 'Placed Retail Order' END
           || CASE WHEN show_location THEN ' - ' || upper(CANAL) ELSE '' END AS event
  FROM (SELECT *, UNNEST([FALSE, TRUE]) AS show_location FROM sale))
SELECT CUSTACCOUNT, SALESID, show_location, event, EMAIL, all_matched, total, item_count, tags,
       strftime(CTD, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS event_time,
       SALESID AS doc_order_id, total AS doc_value, event AS doc_event
FROM ev
"""

ORACLE = {"q_build_events": _EVENTS_SQL}

QUERIES = {"q_build_events": build_events}
