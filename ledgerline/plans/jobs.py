"""The jobs themselves, run as registered queries on landed test tables.

Each query builds its input in the job's source schema with plain expressions
and then calls the library's job function unchanged.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.merge import CREATED_AT, UPDATED_AT, snapshot_and_history, structure_of, write_version
from ..operators.nested import flatten_commerce_orders, flatten_incidences, parse_tax_payload, rejected_tax_payloads
from ..session import shared_folder
from ..sources import documents as S
from ..sources.tables import table
from ..sources.versions import VersionedTable
from . import erp
from .documents import land_incidences, land_tax_payloads
from .reconciliation import ASOF, ORDER_LINK, discrepancy_alert, oms_missing, quantity_discrepancies, shop_missing


# ------------------------------------------------------------ reconciliation
def _reconciliation_inputs(spark, sf):
    """Suborders, commerce orders, commerce lines and ERP lines in their source shapes."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    name = F.col("o_orderkey").cast("string")
    suborders = o.select(F.col("o_orderkey").alias("ORDER_ID"), name.alias("ECOMMERCE_NAME"), F.col("o_orderdate").alias("ORDER_DATE"))
    orders = o.select(F.col("o_orderkey").alias("ORDER_ID"), name.alias("NAME"), F.col("o_orderdate").alias("PROCESSED_AT"),
                      F.col("o_orderdate").alias("CREATED_AT"),
                      F.when(F.col("o_orderstatus") == "O", F.lit("paid")).otherwise(F.lit("pending")).alias("FINANCIAL_STATUS"))
    shop_lines = o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_orderkey").alias("ORDER_ID"), name.alias("ORDER_NAME"), F.col("o_orderdate").alias("CREATED_AT"),
        F.col("l_quantity").cast("decimal(38,6)").cast("string").alias("QUANTITY"))
    key = F.col("l_orderkey").cast("string")
    erp_lines = li.select(
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.concat(F.lit("NC-"), key)).otherwise(key).alias("PURCHORDERFORMNUM"),
        F.when(F.col("l_returnflag") == "N", F.lit("ECOM")).otherwise(F.lit("STORE")).alias("SALESPOOLID"),
        F.when(F.col("l_linenumber") == 2, F.lit("DESPACHO")).otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("ITEMID"),
        F.col("l_quantity").cast("decimal(38,6)").alias("QTY"))
    return suborders, orders, shop_lines, erp_lines


def job_oms_missing(spark, sf):
    """PL16/JN1/FL4/FL7/SO1/PR17/PR19: report 1, suborders of the last 400 days without an ERP line."""
    suborders, _, _, erp_lines = _reconciliation_inputs(spark, sf)
    return oms_missing(suborders, erp_lines, ASOF, 400, ORDER_LINK)


def job_shop_missing(spark, sf):
    """PL16/JN2/FL5: report 2, paid commerce orders of the last 400 days without an ERP line."""
    _, orders, _, erp_lines = _reconciliation_inputs(spark, sf)
    return shop_missing(orders, erp_lines, ASOF, 400, ORDER_LINK)


def job_quantity(spark, sf):
    """PL16/JN3/JN4/JN5/AG6/CV6/CV8/SO2/SO3/SO7: report 3, orders whose quantities differ, by order number as a number, descending."""
    _, _, shop_lines, erp_lines = _reconciliation_inputs(spark, sf)
    return quantity_discrepancies(shop_lines, erp_lines, ASOF, 400, ORDER_LINK)


def job_alert(spark, sf):
    """PL16/AG16/AG17/DT8: the alert over the three reports."""
    return discrepancy_alert(job_oms_missing(spark, sf), job_shop_missing(spark, sf), job_quantity(spark, sf), ASOF, 60, 100)


# --------------------------------------------------------------------- stock
def job_stock_snapshot(spark, sf):
    """PL10/SK7/SC10/ST5/SM5: two captures of the ERP stock (``SKU`` from item,
    color and size): the snapshot holds the second, the history both."""
    p = table(spark, sf, "part")
    raw = p.select(F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("ITEMNUMBER"), F.col("p_brand").alias("PRODUCTCOLORID"),
                   F.when(F.col("p_size") % 5 != 0, F.col("p_size").cast("string")).alias("PRODUCTSIZEID"), F.col("p_size").alias("QTY"))
    stock = erp.erp_stock(raw).select("SKU", "QTY")
    first = stock.withColumn("CAPTURED_AT", F.lit("2024-05-01 08:00:00").cast("timestamp_ntz"))
    second = stock.where("QTY > 10").select("SKU", (F.col("QTY") - 10).alias("QTY"), F.lit("2024-05-02 08:00:00").cast("timestamp_ntz").alias("CAPTURED_AT"))
    empty = structure_of(first.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in (CREATED_AT, UPDATED_AT)}))
    snapshot, result = snapshot_and_history(structure_of(first), empty, first, ["SKU"], "CAPTURED_AT", "2024-05-01 09:00:00")
    snapshot, result = snapshot_and_history(snapshot, result.table, second, ["SKU"], "CAPTURED_AT", "2024-05-02 09:00:00")
    rows = [t.select(F.lit(name).alias("part"), "SKU", "QTY", F.date_format("CAPTURED_AT", "yyyy-MM-dd HH:mm").alias("captured"))
            for name, t in (("snapshot", snapshot), ("history", result.table))]
    return rows[0].unionByName(rows[1])


def job_wms_stock(spark, sf):
    """PL10/SC11/PR12/PR13/DS1: warehouse stock without the listed columns, upper-cased, exact repeats once."""
    li = table(spark, sf, "lineitem")
    raw = li.select(F.lit("W1").alias("whsCode"), F.col("l_suppkey").alias("ownCode"), F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("skuCode"),
                    F.col("l_linestatus").alias("lotStatus"))
    return erp.wms_stock(raw)


# -------------------------------------------------------- prices and invoices
def job_price_list(spark, sf):
    """PL12/PR12/PR13/DT3/CV2/NU1: price rows cleaned; bad numbers 0, bad dates null, missing text ''."""
    p = table(spark, sf, "part")
    raw = p.select(F.lit("e").alias("@odata.etag"), F.lit("co").alias("dataAreaId"), F.col("p_partkey").cast("string").alias("RecordId"),
                   F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("Price"),
                   F.when(F.col("p_size") % 3 == 0, F.lit("soon")).otherwise(F.lit("2024-01-31")).alias("PriceApplicableFromDate"),
                   F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("ProductColorId"))
    out = erp.price_list(raw)
    return out.select("RECORDID", "PRICE", F.date_format("PRICEAPPLICABLEFROMDATE", "yyyy-MM-dd").alias("FROM_DAY"), "PRODUCTCOLORID")


INVOICE_COLUMNS = [("INVOICENUMBER", "VARCHAR(50)"), ("INVOICEDATE", "TIMESTAMP_NTZ"), ("TOTALINVOICEAMOUNT", "FLOAT"), ("SALESORDERNUMBER", "VARCHAR(50)"), ("NOTES", "VARCHAR")]


def job_sales_invoices(spark, sf):
    """PL13/PR12/PR13/PR14/DT3/CV2/NU1/DS1: invoices conformed to the declared columns; repeats once."""
    o = table(spark, sf, "orders")
    raw = o.select(F.lit("e").alias("@odata.etag"), F.concat(F.lit("F"), F.col("o_custkey").cast("string")).alias("InvoiceNumber"),
                   F.when(F.col("o_orderstatus") == "P", F.lit("bad")).otherwise(F.lit("2024-03-05")).alias("InvoiceDate"),
                   F.when(F.col("o_orderstatus") == "F", F.lit("x")).otherwise(F.lit("12.5")).alias("TotalInvoiceAmount"),
                   F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("SalesOrderNumber"), F.lit(1).alias("Unknown"))
    out = erp.sales_invoices(raw, INVOICE_COLUMNS)
    return out.select("INVOICENUMBER", F.date_format("INVOICEDATE", "yyyy-MM-dd").alias("INVOICE_DAY"),
                      F.col("TOTALINVOICEAMOUNT").cast("double").alias("AMOUNT"), "SALESORDERNUMBER", "NOTES")


# ---------------------------------------------------------- other ERP loads
def job_customers_changed(spark, sf):
    """PL9/SC9/FL3: customers whose last change (their last order) lies in the 200 days before the run."""
    o = table(spark, sf, "orders")
    customers = o.groupBy(F.col("o_custkey").alias("CUSTOMERACCOUNT")).agg(F.max("o_orderdate").alias("MODIFIEDDATETIME"))
    return erp.customers_changed(customers, "2001-06-30", 200).select("CUSTOMERACCOUNT", F.date_format("MODIFIEDDATETIME", "yyyy-MM-dd").alias("changed"))


def job_products_publish(spark, sf):
    """PL11/SK6/SK8/CV2/NU1: the product master cleaned and published as a new version, read back from the table."""
    p = table(spark, sf, "part")
    raw = p.select(F.col("p_partkey").alias("PRODUCTNUMBER"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("BRAND"),
                   F.when(F.col("p_size") % 6 == 0, F.lit("?")).otherwise(F.col("p_size").cast("string")).alias("COSTO_HISTORICO"))
    base = shared_folder(spark, "products")
    write_version(raw, base, 1)  # an older state that readers no longer see
    write_version(erp.products_clean(raw), base, 2)
    return VersionedTable(spark, base).latest()


def job_processed_lines(spark, sf):
    """PL7/SC7/FL1/CV2/CV3/ST4: processed lines of 1997 with whole numbers and the 16-part key."""
    li = table(spark, sf, "lineitem")
    text = {c: F.lit("-") for c in erp.PROCESSED_SALESLINE_KEY}
    text |= {"LINENUM": F.col("l_linenumber").cast("double"), "SALESID": F.concat(F.lit("S"), F.col("l_orderkey").cast("string")),
             "ITEMID": F.when(F.col("l_linenumber") != 3, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))),
             "INVENTSIZEID": F.col("l_suppkey").cast("string"), "QTY": F.floor("l_quantity").cast("double")}
    lines = li.select(*[c.alias(n) for n, c in text.items()], F.lit(None).cast("string").alias("TENDERTYPEID"), F.col("l_shipdate").alias("INVOICEDATE"))
    return erp.processed_sales_lines(lines, "1997-06-01", "year").select("SALESID", "LINENUM", "QTY", "TENDERTYPEID", "SALESLINEPK")


# ------------------------------------------- second outputs of the flatteners
def job_order_addresses(spark, sf):
    """PL1/PR2/SC1: the address table of commerce order documents; every fifth order has no address."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    address = F.struct(F.col("c_name").alias("firstName"), F.col("c_mktsegment").alias("city"))
    doc = F.struct(F.concat(F.lit("gid://shopify/Order/"), F.col("o_orderkey").cast("string")).alias("id"),
                   F.when(F.col("o_orderkey") % 5 != 0, address).alias("shippingAddress"))
    docs = o.join(c, o.o_custkey == c.c_custkey).select(S.parse_json(F.to_json(doc), S.COMMERCE_ORDER).alias("d")).select("d.*")
    _, addresses, _ = flatten_commerce_orders(docs)
    return addresses.select("ORDER_ID", "FIRST_NAME", "CITY", "ZIP", "ACCEPTS_MARKETING")


def job_incidence_history(spark, sf):
    """PL5/PR9/SC5/DS1: the history table of incidence documents."""
    docs = land_incidences(spark, sf).select(S.parse_json(F.col("payload"), S.OMS_INCIDENCE).alias("d"), "arrival").select("d.*", "arrival")
    _, history = flatten_incidences(docs, arrival_col="arrival")
    return history.select("PRIMARY_KEY", "ECOMMERCE_NAME_CHILD", "CREATE_DATE", "NAME", "STATE", "USER", F.col("DESCRIPTION").alias("NOTE"))


def job_transfer_headers(spark, sf):
    """PL14/PR10/SC15/DT3: the transfer headers of the 30 days up to the run, names in upper snake case."""
    o = table(spark, sf, "orders")
    headers = o.select(F.concat(F.lit("TR-"), F.col("o_orderkey").cast("string")).alias("TransferOrderNumber"),
                       D.ntz_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("RequestedReceiptDate"),
                       F.col("o_orderpriority").alias("AXXDocTypeCode"))
    lines = headers.select("TransferOrderNumber", F.lit(1).alias("LineNumber"))
    h, _ = erp.transfer_orders(headers, lines, "2001-08-01", 30)
    return h.select("TRANSFER_ORDER_NUMBER", F.date_format("REQUESTED_RECEIPT_DATE", "yyyy-MM-dd").alias("DAY"), "AXX_DOC_TYPE_CODE")


def job_tax_rejects(spark, sf):
    """PL15/SC17/Q14: tax payloads, some cut off, some without documents, some blank: documents read, and payloads rejected by reason."""
    p = land_tax_payloads(spark, sf)
    folio = F.regexp_extract("payload", r"Folio&gt;([0-9]+)&lt;", 1).cast("long")
    broken = p.select(F.when(folio % 7 == 1, F.expr("left(payload, length(payload) - 60)")).when(folio % 7 == 2, F.lit(" "))
                      .when(folio % 7 == 3, F.lit("<soap:Envelope><soap:Body/></soap:Envelope>")).otherwise(F.col("payload")).alias("payload"))
    read = parse_tax_payload(broken).agg(F.lit("read").alias("outcome"), F.count(F.lit(1)).alias("n"))
    rejected = rejected_tax_payloads(broken).groupBy(F.col("REASON").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return read.unionByName(rejected)


_RECONCILIATION = """
  erp AS (SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'NC-' || CAST(l_orderkey AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END AS num,
                 CASE WHEN l_returnflag = 'N' THEN 'ECOM' ELSE 'STORE' END AS pool, l_linenumber = 2 AS shipping, CAST(l_quantity AS DECIMAL(38,6)) AS qty
          FROM lineitem),
  oms AS (SELECT o_orderkey AS order_id, CAST(o_orderkey AS VARCHAR) AS order_number,
                 '<a href="https://orders.example/orders/' || o_orderkey || '" target="_blank">' || o_orderkey || '</a>' AS order_link, o_orderdate AS created_at
          FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-27 00:00:00'
            AND NOT EXISTS (SELECT 1 FROM erp WHERE num = CAST(o_orderkey AS VARCHAR) AND pool = 'ECOM')),
  shop AS (SELECT o_orderkey AS order_id, CAST(o_orderkey AS VARCHAR) AS order_number,
                  '<a href="https://orders.example/orders/' || o_orderkey || '" target="_blank">' || o_orderkey || '</a>' AS order_link, o_orderdate AS created_at
           FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 400 DAY AND o_orderstatus = 'O'
             AND NOT EXISTS (SELECT 1 FROM erp WHERE num = CAST(o_orderkey AS VARCHAR) AND pool = 'ECOM')),
  a AS (SELECT o_orderkey, o_orderdate, SUM(CAST(l_quantity AS DECIMAL(38,6))) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE o_orderdate >= TIMESTAMP '2000-06-27 00:00:00' GROUP BY 1, 2),
  b AS (SELECT TRY_CAST(num AS DECIMAL(38,0)) AS k, SUM(qty) AS total FROM erp WHERE NOT shipping GROUP BY 1),
  qty AS (SELECT o_orderkey AS order_id, CAST(o_orderkey AS VARCHAR) AS order_number,
                 '<a href="https://orders.example/orders/' || o_orderkey || '" target="_blank">' || o_orderkey || '</a>' AS order_link, o_orderdate AS created_at,
                 CAST(a.total AS DOUBLE) AS total_shop, CAST(TRUNC(b.total) AS INTEGER) AS total_erp
          FROM a JOIN b ON a.o_orderkey = b.k
          WHERE a.total <> b.total AND NOT EXISTS (SELECT 1 FROM erp WHERE num = 'NC-' || CAST(o_orderkey AS VARCHAR))
            AND NOT EXISTS (SELECT 1 FROM erp WHERE num = CAST(o_orderkey AS VARCHAR) || '1'))"""

_OLDER = "COALESCE((SELECT BOOL_OR(FLOOR(EPOCH(TIMESTAMP '2001-08-01 00:00:00' - created_at) / 86400) > 60) FROM {0}), FALSE) AS {0}_older"

ORACLE = {
    "q_job_order_addresses": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID, CASE WHEN o_orderkey % 5 <> 0 THEN c_name END AS FIRST_NAME,
               CASE WHEN o_orderkey % 5 <> 0 THEN c_mktsegment END AS CITY, CAST(NULL AS VARCHAR) AS ZIP, FALSE AS ACCEPTS_MARKETING
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "q_job_incidence_history": """
        SELECT DISTINCT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '-' || event_type AS PRIMARY_KEY,
               CAST(user_id AS VARCHAR) AS ECOMMERCE_NAME_CHILD, strftime(ts, '%Y-%m-%d %H:%M:%S') AS CREATE_DATE, event_type AS NAME,
               CASE WHEN value > 50 THEN 'done' ELSE '' END AS STATE, CASE WHEN value <= 80 THEN 'u' || CAST(user_id AS VARCHAR) ELSE '' END AS "USER", props AS NOTE
        FROM events""",
    "q_job_transfer_headers": """
        SELECT 'TR-' || CAST(o_orderkey AS VARCHAR) AS TRANSFER_ORDER_NUMBER, strftime(o_orderdate, '%Y-%m-%d') AS DAY, o_orderpriority AS AXX_DOC_TYPE_CODE
        FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-02' AND DATE '2001-08-01'""",
    "q_job_tax_rejects": """
        WITH g AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, COUNT(*) AS docs,
                          min_by(o_orderkey, CAST(o_orderkey AS VARCHAR)) % 7 AS m FROM orders GROUP BY 1, 2)
        SELECT 'read' AS outcome, CAST(SUM(CASE WHEN m IN (1, 2, 3) THEN 0 ELSE docs END) AS BIGINT) AS n FROM g
        UNION ALL SELECT CASE m WHEN 1 THEN 'unparsable' WHEN 2 THEN 'empty' ELSE 'no documents' END, COUNT(*) FROM g WHERE m IN (1, 2, 3) GROUP BY 1""",
    "q_job_oms_missing": "WITH " + _RECONCILIATION + " SELECT * FROM oms",
    "q_job_shop_missing": "WITH " + _RECONCILIATION + " SELECT * FROM shop",
    "q_job_quantity": "WITH " + _RECONCILIATION + " SELECT * FROM qty",
    "q_job_alert": "WITH " + _RECONCILIATION + f""",
        s AS (SELECT (SELECT COUNT(*) FROM oms) AS oms_count, {_OLDER.format('oms')}, (SELECT COUNT(*) FROM shop) AS shop_count, {_OLDER.format('shop')},
                     (SELECT COUNT(*) FROM qty) AS qty_count, {_OLDER.format('qty')})
        SELECT *, (oms_older OR oms_count >= 100 OR shop_older OR shop_count >= 100 OR qty_older OR qty_count >= 100) AS alert FROM s""",
    "q_job_stock_snapshot": """
        WITH s AS (SELECT 'I' || CAST(p_partkey AS VARCHAR) || '-' || p_brand || '-' || CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) ELSE 'None' END AS SKU,
                          p_size AS QTY FROM part)
        SELECT 'history' AS part, SKU, QTY, '2024-05-01 08:00' AS captured FROM s
        UNION ALL SELECT x.part, SKU, QTY - 10, '2024-05-02 08:00' FROM s, (VALUES ('history'), ('snapshot')) x(part) WHERE QTY > 10""",
    "q_job_wms_stock": "SELECT DISTINCT 'SKU' || CAST(l_partkey AS VARCHAR) AS SKUCODE, l_linestatus AS LOTSTATUS FROM lineitem",
    "q_job_price_list": """
        SELECT CAST(p_partkey AS DOUBLE) AS RECORDID, CASE WHEN p_size % 7 = 0 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS PRICE,
               CASE WHEN p_size % 3 <> 0 THEN '2024-01-31' END AS FROM_DAY, CASE WHEN p_size % 4 <> 0 THEN p_brand ELSE '' END AS PRODUCTCOLORID
        FROM part""",
    "q_job_sales_invoices": """
        SELECT DISTINCT 'F' || CAST(o_custkey AS VARCHAR) AS INVOICENUMBER, CASE WHEN o_orderstatus <> 'P' THEN '2024-03-05' END AS INVOICE_DAY,
               CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE 12.5 END AS AMOUNT,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END AS SALESORDERNUMBER, '' AS NOTES
        FROM orders""",
    "q_job_customers_changed": """
        SELECT o_custkey AS CUSTOMERACCOUNT, strftime(MAX(o_orderdate), '%Y-%m-%d') AS changed FROM orders GROUP BY o_custkey
        HAVING CAST(MAX(o_orderdate) AS DATE) BETWEEN DATE '2001-06-30' - INTERVAL 200 DAY AND DATE '2001-06-30'""",
    "q_job_products_publish": """
        SELECT p_partkey AS PRODUCTNUMBER, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS BRAND,
               CASE WHEN p_size % 6 = 0 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS COSTO_HISTORICO
        FROM part""",
    "q_job_processed_lines": """
        SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS SALESID, CAST(l_linenumber AS INTEGER) AS LINENUM, CAST(FLOOR(l_quantity) AS INTEGER) AS QTY, 0 AS TENDERTYPEID,
               concat_ws('-', CAST(l_linenumber AS VARCHAR), '-', '-', '-', '-', 'S' || CAST(l_orderkey AS VARCHAR), '-', '-', CASE WHEN l_linenumber <> 3 THEN 'P' || CAST(l_partkey AS VARCHAR) ELSE 'None' END, '-', '-', CAST(l_suppkey AS VARCHAR), '-', '-', '-', CAST(CAST(FLOOR(l_quantity) AS INTEGER) AS VARCHAR)) AS SALESLINEPK
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
}

QUERIES = {
    "q_job_order_addresses": job_order_addresses,
    "q_job_incidence_history": job_incidence_history,
    "q_job_transfer_headers": job_transfer_headers,
    "q_job_tax_rejects": job_tax_rejects,
    "q_job_oms_missing": job_oms_missing,
    "q_job_shop_missing": job_shop_missing,
    "q_job_quantity": job_quantity,
    "q_job_alert": job_alert,
    "q_job_stock_snapshot": job_stock_snapshot,
    "q_job_wms_stock": job_wms_stock,
    "q_job_price_list": job_price_list,
    "q_job_sales_invoices": job_sales_invoices,
    "q_job_customers_changed": job_customers_changed,
    "q_job_products_publish": job_products_publish,
    "q_job_processed_lines": job_processed_lines,
}
