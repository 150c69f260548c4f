"""Cleaning and typing of extracts: keys, ids, text, casts, dates, fan-out,
schema conformance and scans (ST*, CV*, NU*, DT*, MA*, CD4, PR10-PR19, FL*, SC*).

The dirty inputs are derived from the test tables by plain expressions
(``CASE`` on existing columns) so every query reads whole tables; the
cleaning itself is the library's column functions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import casts as C
from ..functions import dates as D
from ..functions import text as T
from ..operators.calendar import rate_fanout
from ..operators.conform import conform, rename, upper_names
from ..sources.tables import scan, table

# Fixed values of the freight footprint ledger (reference defaults).
AVERAGE_PRODUCT_WEIGHT_KG = "0.32"
DEFAULT_EMISSIONS_FACTOR = "0.12418"
CUSTOMER_LINK = "https://shop.example/customers/"


def composite_key(spark, sf):
    """ST4/ST5/CV3: 4-part line key with the ``None`` marker for a null
    part, an ``item-color-size`` style SKU, a key holding a float printed as
    Python does, and ``fillna(0).astype(int)`` of a fractional quantity."""
    li = table(spark, sf, "lineitem")
    line = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_linenumber"))
    qty = F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_quantity") * 1.5)
    return li.select(
        T.key_text("l_orderkey", "l_partkey", "l_suppkey", line).alias("line_key"),
        T.key_text("l_partkey", "l_returnflag", "l_linestatus").alias("sku"),
        T.key_text("l_orderkey", "l_quantity", float_cols=("l_quantity",)).alias("qty_key"),
        C.int_or_zero(qty).alias("qty_int"))


def strip_gid(spark, sf):
    """ST1-ST3/CV7: global ids built per status, stripped back; address ids
    with a query suffix cut; numeric id or null."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey").cast("string")
    gid = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("gid://shopify/Order/"), k))
           .when(F.col("o_orderstatus") == "O", F.concat(F.lit("gid://shopify/Customer/"), k))
           .otherwise(F.concat(k, F.lit("x"))))
    addr = F.when(F.col("o_orderpriority").startswith("1"),
                  F.concat(k, F.lit("?model_name=CustomerAddress&v=1"))).otherwise(k)
    return o.select("o_orderkey", gid.alias("gid"), addr.alias("address_raw")).select(
        "o_orderkey", "gid",
        T.strip_gid("gid", "Order").alias("order_id"),
        T.strip_gid_after_prefix("gid", "Customer").alias("customer_id"),
        C.numeric_id("gid").cast("string").alias("numeric_id"),
        T.cut_query_suffix("address_raw").alias("address_id"))


def string_clean(spark, sf):
    """ST7/ST11/ST12/ST16/ST17/ST19/PR17: case, trim, first/rest split of a
    name, sentinel values, list join, address text and a report link."""
    c = table(spark, sf, "customer")
    full = F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name"))
    sentinel = (F.when(F.col("c_acctbal") < 0, F.lit("nan"))
                .when(F.col("c_acctbal") > 9000, F.lit("False"))
                .otherwise(F.col("c_nationkey").cast("string")))
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("null")).otherwise(F.col("c_mktsegment"))
    return c.select(
        "c_custkey",
        T.first_word(F.lower(full)).alias("first_name"),
        T.rest_words(full).alias("last_name"),
        F.upper(F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))).alias("name_upper"),
        T.blank_sentinels(sentinel).alias("nation_text"),
        T.null_sentinel(seg).alias("segment"),
        F.array_join(F.array("c_mktsegment", "c_name"), ", ").alias("joined"),
        T.address_text(F.col("c_name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("address"),
        T.html_link(CUSTOMER_LINK, "c_custkey", "c_name").alias("link"))


def safe_casts(spark, sf):
    """CV1-CV6/NU4/NU5: dirty text coerced with the safe casts."""
    o = table(spark, sf, "orders")
    amount = (F.when(F.col("o_orderpriority").startswith("1"), F.lit("n/a"))
              .when(F.col("o_orderpriority").startswith("2"), F.lit(""))
              .otherwise(F.col("o_totalprice").cast("string")))
    f01 = F.when(F.col("o_orderstatus") == "F", F.lit("1")).when(F.col("o_orderstatus") == "O", F.lit("0"))
    yn = F.when(F.col("o_orderstatus") == "F", F.lit("Yes")).when(F.col("o_orderstatus") == "O", F.lit("No"))
    num = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("NC-"), F.col("o_orderkey").cast("string"))) \
        .otherwise(F.col("o_orderkey").cast("string"))
    cust = F.when(F.col("o_orderpriority").startswith("5"), F.lit(None)).otherwise(F.col("o_custkey"))
    st = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus"))
    return o.select(
        "o_orderkey",
        F.round(C.safe_double(amount), 2).alias("amount"),
        F.round(C.double_or_zero(amount), 2).alias("amount_or_zero"),
        C.flag_from_01(f01).alias("flag01"),
        C.flag_from_yes_no(yn).alias("flag_yes"),
        C.try_number(num).cast("bigint").cast("string").alias("order_number"),
        C.zero_if_null(cust).alias("custkey_or_zero"),
        C.equals_null_safe(st, "F").alias("is_finished"))


def email_cascade(spark, sf):
    """NU3/AG18: e-mail chosen by truthiness from four sources in priority
    order, with the winning source; counted per source (exact distinct)."""
    c = table(spark, sf, "customer")
    base = F.lower(F.col("c_name"))
    primary = F.when(F.col("c_acctbal") > 5000, F.concat(base, F.lit("@erp.example")))
    receipt = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(base, F.lit("@receipt.example"))).otherwise(F.lit(""))
    line = F.when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), F.concat(base, F.lit("@line.example")))
    shop = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("shop"), F.col("c_nationkey").cast("string"), F.lit("@shop.example")))
    named = [("erp_primary", primary), ("erp_receipt", receipt), ("sale_line", line), ("shop", shop)]
    e = c.select(C.first_truthy(*[x for _, x in named]).alias("email"),
                 C.first_truthy_source(named).alias("email_source"))
    return e.groupBy("email_source").agg(F.count(F.lit(1)).alias("n_customers"),
                                         F.count_distinct("email").alias("n_emails"))


def tz_shift(spark, sf, asof="2024-02-01 00:00:00"):
    """DT6/DT8/DT9: UTC -> local wall time and back, ISO text with offset,
    whole-day age at ``asof`` and ISO week label."""
    e = table(spark, sf, "events").select("event_id", "ts")
    local = D.utc_to_local("ts")
    return e.select("event_id", local.alias("local_ts"), D.local_to_utc(local).alias("utc_again"),
                    D.iso_utc_text("ts").alias("iso_utc"), D.whole_days(asof, "ts").alias("age_days"),
                    D.iso_week_label("ts").alias("week"))


def date_parse(spark, sf):
    """DT3-DT5: ``dd/MM/yyyy``, ISO and broken date text parsed safely."""
    o = table(spark, sf, "orders")
    txt = (F.when(F.col("o_orderstatus") == "F", D.ntz_format("o_orderdate", "dd/MM/yyyy"))
           .when(F.col("o_orderstatus") == "O", D.ntz_format("o_orderdate", "yyyy-MM-dd"))
           .otherwise(F.concat(F.lit("xx/13/"), F.year("o_orderdate").cast("string"))))
    iso = F.when(F.col("o_orderpriority").startswith("3"), F.lit("not a date")) \
        .otherwise(D.ntz_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", txt.alias("raw"), iso.alias("iso_raw")).select(
        "o_orderkey", "raw",
        D.parse_day_first("raw").alias("parsed"),
        D.safe_timestamp("iso_raw").alias("iso_parsed"),
        F.date_format(D.date_from_prefix("iso_raw"), "yyyy-MM-dd").alias("day_text"))


def month_end_fanout(spark, sf):
    """PL20/CD4/DT12: every daily rate is written for each base rate type, and
    once more as the closing rate on month-end days (fixed list: 28 Feb
    always, 29 Feb never)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("rate_date"),
                                          F.round(F.col("o_totalprice").cast("decimal(18,2)")
                                                  * F.lit("0.001").cast("decimal(4,3)"), 2).cast("double").alias("rate"))
    out = rate_fanout(o, "rate_date")
    return out.select("o_orderkey", F.date_format("rate_date", "yyyy-MM-dd").alias("rate_date"), "rate", "rate_type")


def decimal_round(spark, sf):
    """MA1/AG19: ledger weight = quantity x average weight in decimals,
    HALF_UP to 2 places; factor to 6 places; grand totals of the ledger."""
    li = table(spark, sf, "lineitem")
    ledger = li.select(
        A.decimal_product(C.zero_if_null("l_quantity"), F.lit(AVERAGE_PRODUCT_WEIGHT_KG), 2).alias("weight_kg"),
        F.round(F.lit(DEFAULT_EMISSIONS_FACTOR).cast("decimal(18,8)"), 6).alias("factor"),
        F.round((F.col("l_extendedprice") / 100).cast("decimal(18,6)"), 2).alias("distance_km"))
    return ledger.agg(F.sum("weight_kg").cast("double").alias("total_weight_kg"),
                      F.sum("distance_km").cast("double").alias("total_distance_km"),
                      F.max("factor").cast("double").alias("factor"),
                      F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(F.col("weight_kg") > 10).alias("n_heavy"))


def text_filters(spark, sf):
    """FL6/FL9/FL10: case-insensitive compare, ``NOT IN`` list, non-blank."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_size") == 1, F.lit("   ")).otherwise(F.col("p_name"))
    return p.select("p_partkey", "p_brand", "p_type", name.alias("p_name")).where(
        (F.upper("p_type") != "PROMO") & (F.upper("p_type") == F.upper(F.lower("p_type")))
        & ~F.col("p_brand").isin("Brand#1", "Brand#2") & (F.trim("p_name") != ""))


def resolved_range(spark, sf, today=_dt.date(2001, 8, 1)):
    """FL14/DT7: the four date-argument cases resolved on the driver and
    counted on orders in one pass, plus a 12-months-back window."""
    cases = {
        "n_both": D.resolve_range("2000-01-01", "2000-12-31", today=today),
        "n_start_only": D.resolve_range("2001-06-01", None, today=today),
        "n_end_only": D.resolve_range(None, "2001-03-31", lookback_days=30, today=today),
        "n_default": D.resolve_range(None, None, lookback_days=7, today=today),
    }
    o = table(spark, sf, "orders")
    aggs = [F.count_if(D.between_days("o_orderdate", s, e)).alias(k) for k, (s, e) in cases.items()]
    year_back = F.add_months(F.lit(today.isoformat()).cast("date"), -12)
    aggs.append(F.count_if(F.to_date("o_orderdate").between(year_back, F.lit(today.isoformat()).cast("date")))
                .alias("n_12_months"))
    return o.agg(*aggs)


def coverage(spark, sf):
    """AG20/SE3/DT1/DT2/MA2: lines of the two halves of every year (undated
    lines with the second) unioned; min and max ship time as text, the day as
    text, integer quantity total."""
    li = scan(spark, sf, "lineitem", ["l_shipdate", "l_quantity"])
    first_half = F.coalesce(F.month("l_shipdate") <= 6, F.lit(False))
    u = li.where(first_half).unionByName(li.where(~first_half))
    return u.agg(D.ts_text(F.min("l_shipdate")).alias("first_ship"),
                 D.ts_text(F.max("l_shipdate")).alias("last_ship"),
                 F.date_format(D.day_of(F.max("l_shipdate")), "yyyy-MM-dd").alias("last_day"),
                 F.sum(A.int_quantity("l_quantity")).cast("bigint").alias("total_qty"))


def missing_flag(spark, sf):
    """PR16/PR19/CD1/MP1/JN9: orders left-joined to the orders with a
    returned line, a boolean "missing" column from ``CASE WHEN r.k IS NULL``,
    renamed for the report."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    r = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey").distinct()
    j = o.join(r, o.o_orderkey == r.l_orderkey, "left")
    out = j.select("o_orderkey", "o_orderstatus",
                   F.when(F.col("l_orderkey").isNull(), F.lit(True)).otherwise(F.lit(False)).alias("no_return"))
    return rename(out, {"o_orderkey": "ORDER_ID", "o_orderstatus": "STATUS", "no_return": "IS_MISSING"})


def topk_page(spark, sf):
    """SO3-SO7: one page (offset 100, 50 rows) of orders by descending
    total with a unique tie-break: the limit is the feature."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).offset(100).limit(50)


PART_COLUMNS = [("PART_ID", "BIGINT"), ("NAME", "VARCHAR(100)"), ("BRAND", "VARCHAR"),
                ("PRICE", "FLOAT"), ("SIZE", "INT"), ("CATEGORY", "VARCHAR")]


def conform_schema(spark, sf):
    """PL13/PR10-PR14/SK10: camelCase extract renamed, upper-cased, unknown
    columns dropped, missing ones added as '', cast and ordered."""
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("partId"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("string").alias("price"), F.col("p_size").alias("size"),
        F.col("p_type").alias("odataEtag"))
    p = rename(p, {"partId": "part_id"})
    p = upper_names(p).drop("ODATAETAG", "NOT_THERE")
    return conform(p, PART_COLUMNS, fill="")


def scan_pruned(spark, sf):
    """SC6-SC8/SC10/SC12/SC18: five columns, one month, one flag; the plan reads
    only those columns with the predicates pushed to Parquet."""
    return scan(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"],
                D.period_filter(F.col("l_shipdate"), "1999-06-01", "month") & (F.col("l_returnflag") == "N"))



ORACLE = {
    "q_composite_key": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                 || '-' || COALESCE(CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS VARCHAR), 'None') AS line_key,
               CAST(l_partkey AS VARCHAR) || '-' || l_returnflag || '-' || l_linestatus AS sku,
               CAST(l_orderkey AS VARCHAR) || '-' || COALESCE(CAST(l_quantity AS VARCHAR), 'nan') AS qty_key,
               CAST(TRUNC(COALESCE(CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_quantity * 1.5 END, 0.0)) AS INTEGER) AS qty_int
        FROM lineitem""",
    "q_strip_gid": """
        WITH g AS (SELECT o_orderkey, o_orderpriority,
                     CASE WHEN o_orderstatus = 'F' THEN 'gid://shopify/Order/' || CAST(o_orderkey AS VARCHAR)
                          WHEN o_orderstatus = 'O' THEN 'gid://shopify/Customer/' || CAST(o_orderkey AS VARCHAR)
                          ELSE CAST(o_orderkey AS VARCHAR) || 'x' END AS gid FROM orders)
        SELECT o_orderkey, gid,
               CASE WHEN starts_with(gid, 'gid://shopify/Order/') THEN regexp_extract(gid, '([^/]*)$', 1) ELSE gid END AS order_id,
               CASE WHEN gid IS NULL OR gid = '' THEN NULL
                    WHEN starts_with(gid, 'gid://shopify/Customer/') THEN substr(gid, 24) ELSE gid END AS customer_id,
               CAST(CASE WHEN starts_with(gid, 'gid://shopify/') THEN TRY_CAST(regexp_extract(gid, '([^/]*)$', 1) AS BIGINT)
                    ELSE TRY_CAST(gid AS BIGINT) END AS VARCHAR) AS numeric_id,
               CASE WHEN starts_with(o_orderpriority, '1') THEN CAST(o_orderkey AS VARCHAR)
                    ELSE CAST(o_orderkey AS VARCHAR) END AS address_id
        FROM g""",
    "q_string_clean": """
        SELECT c_custkey,
               split_part(lower(c_mktsegment || ' ' || c_name), ' ', 1) AS first_name,
               CASE WHEN strpos(c_mktsegment || ' ' || c_name, ' ') > 0
                    THEN substr(c_mktsegment || ' ' || c_name, strpos(c_mktsegment || ' ' || c_name, ' ') + 1) ELSE '' END AS last_name,
               upper(trim('  ' || c_name || ' ')) AS name_upper,
               CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_text,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
               c_mktsegment || ', ' || c_name AS joined,
               c_name || ', ' || CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS address,
               '<a href="https://shop.example/customers/' || CAST(c_custkey AS VARCHAR) || '" target="_blank">' || c_name || '</a>' AS link
        FROM customer""",
    "q_safe_casts": """
        SELECT o_orderkey,
               ROUND(TRY_CAST(CASE WHEN starts_with(o_orderpriority, '1') THEN 'n/a' WHEN starts_with(o_orderpriority, '2') THEN ''
                                   ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE), 2) AS amount,
               ROUND(COALESCE(TRY_CAST(CASE WHEN starts_with(o_orderpriority, '1') THEN 'n/a' WHEN starts_with(o_orderpriority, '2') THEN ''
                                   ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE), 0.0), 2) AS amount_or_zero,
               o_orderstatus = 'F' AS flag01,
               o_orderstatus = 'F' AS flag_yes,
               CAST(CAST(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'NC-' || CAST(o_orderkey AS VARCHAR)
                                  ELSE CAST(o_orderkey AS VARCHAR) END AS DECIMAL(38,0)) AS BIGINT) AS VARCHAR) AS order_number,
               COALESCE(CASE WHEN starts_with(o_orderpriority, '5') THEN NULL ELSE o_custkey END, 0) AS custkey_or_zero,
               COALESCE(o_orderstatus = 'F' AND o_orderstatus != 'P', FALSE) AS is_finished
        FROM orders""",
    "q_email_cascade": """
        WITH e AS (
          SELECT COALESCE(NULLIF(CASE WHEN c_acctbal > 5000 THEN lower(c_name) || '@erp.example' END, ''),
                          NULLIF(CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) || '@receipt.example' ELSE '' END, ''),
                          NULLIF(CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN lower(c_name) || '@line.example' END, ''),
                          NULLIF(CASE WHEN c_acctbal >= 0 THEN 'shop' || CAST(c_nationkey AS VARCHAR) || '@shop.example' END, '')) AS email,
                 CASE WHEN c_acctbal > 5000 THEN 'erp_primary'
                      WHEN c_mktsegment = 'BUILDING' THEN 'erp_receipt'
                      WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'sale_line'
                      WHEN c_acctbal >= 0 THEN 'shop' END AS email_source
          FROM customer)
        SELECT email_source, COUNT(*) AS n_customers, COUNT(DISTINCT email) AS n_emails FROM e GROUP BY email_source""",
    "q_tz_shift": """
        SELECT event_id,
               timezone('America/Santiago', ts AT TIME ZONE 'UTC') AS local_ts,
               timezone('UTC', timezone('America/Santiago', ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago') AS utc_again,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso_utc,
               CAST(FLOOR(EPOCH(TIMESTAMP '2024-02-01 00:00:00' - ts) / 86400) AS BIGINT) AS age_days,
               'W' || CAST(weekofyear(ts) AS VARCHAR) AS week
        FROM events""",
    "q_date_parse": """
        WITH r AS (SELECT o_orderkey,
                     CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                          WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                          ELSE 'xx/13/' || CAST(year(o_orderdate) AS VARCHAR) END AS raw,
                     CASE WHEN starts_with(o_orderpriority, '3') THEN 'not a date'
                          ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS iso_raw
                   FROM orders)
        SELECT o_orderkey, raw,
               COALESCE(try_strptime(raw, '%d/%m/%Y'), TRY_CAST(raw AS TIMESTAMP)) AS parsed,
               TRY_CAST(iso_raw AS TIMESTAMP) AS iso_parsed,
               strftime(TRY_CAST(left(iso_raw, 10) AS DATE), '%Y-%m-%d') AS day_text
        FROM r""",
    "q_month_end_fanout": """
        WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
                          CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.001' AS DECIMAL(4,3)), 2) AS DOUBLE) AS rate
                   FROM orders)
        SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS rate_date, rate, 'Predeterminado' AS rate_type FROM r
        UNION ALL SELECT o_orderkey, strftime(d, '%Y-%m-%d'), rate, 'Tienda' FROM r
        UNION ALL SELECT o_orderkey, strftime(d, '%Y-%m-%d'), rate, 'Cierre' FROM r
          WHERE strftime(d, '%m-%d') IN ('01-31', '02-28', '03-31', '04-30', '05-31', '06-30',
                                         '07-31', '08-31', '09-30', '10-31', '11-30', '12-31')""",
    "q_decimal_round": """
        WITH l AS (SELECT ROUND(CAST(COALESCE(l_quantity, 0) AS DECIMAL(18,4)) * CAST('0.32' AS DECIMAL(10,4)), 2) AS weight_kg,
                          ROUND(CAST(l_extendedprice / 100 AS DECIMAL(18,6)), 2) AS distance_km
                   FROM lineitem)
        SELECT CAST(SUM(weight_kg) AS DOUBLE) AS total_weight_kg, CAST(SUM(distance_km) AS DOUBLE) AS total_distance_km,
               CAST(ROUND(CAST('0.12418' AS DECIMAL(18,8)), 6) AS DOUBLE) AS factor,
               COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE weight_kg > 10) AS n_heavy
        FROM l""",
    "q_text_filters": """
        SELECT p_partkey, p_brand, p_type, CASE WHEN p_size = 1 THEN '   ' ELSE p_name END AS p_name FROM part
        WHERE upper(p_type) != 'PROMO' AND p_brand NOT IN ('Brand#1', 'Brand#2')
          AND trim(CASE WHEN p_size = 1 THEN '   ' ELSE p_name END) != ''""",
    "q_resolved_range": """
        SELECT COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-12-31') AS n_both,
               COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-06-01' AND DATE '2001-08-01') AS n_start_only,
               COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-03-01' AND DATE '2001-03-31') AS n_end_only,
               COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-25' AND DATE '2001-08-01') AS n_default,
               COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-08-01' AND DATE '2001-08-01') AS n_12_months
        FROM orders""",
    "q_coverage": """
        SELECT strftime(MIN(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_ship,
               strftime(MAX(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_ship,
               strftime(CAST(MAX(l_shipdate) AS DATE), '%Y-%m-%d') AS last_day,
               CAST(SUM(CAST(TRUNC(l_quantity) AS INTEGER)) AS BIGINT) AS total_qty
        FROM lineitem""",
    "q_missing_flag": """
        SELECT o.o_orderkey AS ORDER_ID, o.o_orderstatus AS STATUS, r.l_orderkey IS NULL AS IS_MISSING
        FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r
          ON o.o_orderkey = r.l_orderkey""",
    "q_topk_page": """
        SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""",
    "q_conform_schema": """
        SELECT p_partkey AS PART_ID, p_name AS NAME, p_brand AS BRAND, TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS PRICE,
               p_size AS SIZE, '' AS CATEGORY FROM part""",
    "q_scan_pruned": """
        SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_shipdate FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1999-06-01' AND l_shipdate < TIMESTAMP '1999-07-01' AND l_returnflag = 'N'""",
}

QUERIES = {
    "q_composite_key": composite_key,
    "q_strip_gid": strip_gid,
    "q_string_clean": string_clean,
    "q_safe_casts": safe_casts,
    "q_email_cascade": email_cascade,
    "q_tz_shift": tz_shift,
    "q_date_parse": date_parse,
    "q_month_end_fanout": month_end_fanout,
    "q_decimal_round": decimal_round,
    "q_text_filters": text_filters,
    "q_resolved_range": resolved_range,
    "q_coverage": coverage,
    "q_missing_flag": missing_flag,
    "q_topk_page": topk_page,
    "q_conform_schema": conform_schema,
    "q_scan_pruned": scan_pruned,
}
