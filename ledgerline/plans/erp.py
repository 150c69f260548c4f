"""ERP and warehouse loads (PL6-PL14): period scans with duplicate exclusion,
composite keys, typed cleaning, rollups, snapshots and OData conformance.

Each job is a DataFrame -> DataFrame function; the caller upserts the result
with :func:`ledgerline.operators.merge.upsert` on the job's key.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import casts as C
from ..functions import dates as D
from ..functions import text as T
from ..operators.conform import conform, upper_names
from ..operators.dedupe import exclude_duplicated
from ..sources.tables import table

# Fixed values that must equal the reference's: the parts of the line keys
# (also the duplicate-group columns of the sales-line scan), in key order.
SALESLINE_KEY = ["LINENUM", "RETAILVARIANTID", "SALESORDERNUMBER", "EXTERNALITEMNUMBER", "ITEMNUMBER",
                 "PRODUCTCONFIGURATIONID", "PRODUCTCOLORID", "PRODUCTSIZEID", "PRODUCTSTYLEID",
                 "ORDEREDINVENTORYSTATUSID", "SHIPPINGWAREHOUSEID", "ORDEREDSALESQUANTITY"]
PROCESSED_SALESLINE_KEY = ["LINENUM", "INVENTTRANSID", "INVENTDIMID", "REFCUSTINVOICETRANSRECID", "INVOICEID",
                           "SALESID", "EXTERNALITEMID", "DEV_SALESID", "ITEMID", "CONFIGID", "INVENTCOLORID",
                           "INVENTSIZEID", "INVENTSTYLEID", "INVENTSTATUSID", "INVENTLOCATIONID", "QTY"]
# Header rollup of processed lines: (output, aggregate, input column).
SALES_ROLLUP = [("INVOICEDATE", "max", "INVOICEDATE"), ("CREATEDTRANSACTION", "max", "CREATEDTRANSACTIONDATE2"),
                ("INVOICEID", "max", "INVOICEID"), ("CUSTOMERACCOUNT", "max", "CUSTACCOUNT"),
                ("ORGANIZATIONNAME", "left100", "ORGANIZATIONNAME"), ("SALESPRICETOTAL", "sum", "SALESPRICE"),
                ("QTYTOTAL", "sum", "QTY"), ("CURRENCYCODE", "max", "CURRENCYCODE"), ("CANAL", "max", "CANAL"),
                ("CECO", "max", "CECO"), ("TAXGROUP", "max", "TAXGROUP"), ("ORDERNUMBER", "max", "PURCHORDERFORMNUM")]
INVOICE_NUMERIC = ["TOTALTAXAMOUNT", "TOTALDISCOUNTCUSTOMERGROUPCODE", "TOTALCHARGEAMOUNT",
                   "TOTALDISCOUNTAMOUNT", "TOTALINVOICEAMOUNT"]
PRICE_NUMERIC = ["RECORDID", "SALESPRICEQUANTITY", "TOQUANTITY", "FIXEDPRICECHARGES", "SALESLEADTIMEDAYS",
                 "FROMQUANTITY", "PRICE"]
PRICE_DATES = ["PRICEAPPLICABLEFROMDATE", "PRICEAPPLICABLETODATE"]
WMS_DROP = ["idWhs", "whsCode", "shortWhsName", "ownCode", "ownName"]


def sales_lines(lines: DataFrame, day, period: str, ts_col: str = "SYNCSTARTDATETIME",
                exclude_duplicates: bool = True) -> DataFrame:
    """PL6 (SC6/FL1/AG7/JN6/CV3/ST4): lines of one day / month / year; orders
    owning a duplicated 12-part group are dropped (``NOT IN``); ``LINENUM``
    and ``QTYORDERED`` become integers (null -> 0) and ``SALESLINEPK`` is the
    12-part key with Python's text of each part."""
    df = lines.where(D.period_filter(F.col(ts_col), day, period))
    if exclude_duplicates:
        df = exclude_duplicated(df, SALESLINE_KEY, "SALESORDERNUMBER")
    df = df.withColumn("LINENUM", C.int_or_zero("LINENUM")).withColumn("QTYORDERED", C.int_or_zero("QTYORDERED"))
    floats = tuple(f.name for f in df.schema.fields if f.name in SALESLINE_KEY and f.dataType.typeName() == "double")
    return df.withColumn("SALESLINEPK", T.key_text(*SALESLINE_KEY, float_cols=floats))


def processed_sales_lines(lines: DataFrame, day, period: str, ts_col: str = "INVOICEDATE",
                          exclude_duplicates: bool = False) -> DataFrame:
    """PL7 (SC7/CV2/CV3/ST4): processed lines of the period; the duplicate
    exclusion exists but is off by default, as in the reference (Q4);
    integers for ``LINENUM``/``QTY``, tender type numeric or 0, 16-part key."""
    df = lines.where(D.period_filter(F.col(ts_col), day, period))
    if exclude_duplicates:
        df = exclude_duplicated(df, PROCESSED_SALESLINE_KEY, "SALESID")
    df = (df.withColumn("LINENUM", C.int_or_zero("LINENUM")).withColumn("QTY", C.int_or_zero("QTY"))
          .withColumn("TENDERTYPEID", C.int_or_zero("TENDERTYPEID")))
    return df.withColumn("SALESLINEPK", T.key_text(*PROCESSED_SALESLINE_KEY))


def sales_rollup(lines: DataFrame) -> DataFrame:
    """PL7/AG1/ST8: one header per ``SALESID`` (13 columns)."""
    aggs = []
    for out, how, col in SALES_ROLLUP:
        if how == "max":
            aggs.append(F.max(col).alias(out))
        elif how == "sum":
            aggs.append(F.sum(col).alias(out))
        else:
            aggs.append(F.left(F.max(col).cast("string"), F.lit(100)).alias(out))
    return lines.groupBy("SALESID").agg(*aggs)


def accounting_entries(entries: DataFrame, day, period: str, ts_col: str = "ACCOUNTINGDATE") -> DataFrame:
    """PL8 (SC8/FL1/CV4/DT2): entries of the period, 0/1 flags as booleans."""
    df = entries.where(D.period_filter(F.col(ts_col), day, period))
    return (df.withColumn("ISSELECTED", C.flag_from_01("ISSELECTED"))
            .withColumn("TRANSFERSTATUS", C.flag_from_01("TRANSFERSTATUS")))


def customers_changed(customers: DataFrame, asof, days: int, ts_col: str = "MODIFIEDDATETIME") -> DataFrame:
    """PL9 (SC9/FL3): customers changed in the ``days`` before ``asof``."""
    return customers.where(D.between_days(ts_col, D._lit_date(asof) - F.expr(f"INTERVAL {int(days)} DAYS"),
                                          D._lit_date(asof)))


def erp_stock(stock: DataFrame) -> DataFrame:
    """PL10 (SC10/ST5): ERP stock with ``SKU = item-color-size``."""
    return stock.withColumn("SKU", T.key_text("ITEMNUMBER", "PRODUCTCOLORID", "PRODUCTSIZEID"))


def wms_stock(raw: DataFrame) -> DataFrame:
    """PL10 (SC11/PR12/PR13/DS1): WMS stock: listed columns dropped (absent
    ones ignored), names upper-cased, exact duplicate rows removed."""
    return upper_names(raw.drop(*WMS_DROP)).distinct()


def products_clean(products: DataFrame, cost_col: str = "COSTO_HISTORICO") -> DataFrame:
    """PL11 (CV2/NU1): historic cost numeric (bad -> 0), blank strings ''."""
    return C.fill_blank_strings(products.withColumn(cost_col, C.double_or_zero(cost_col)))


def price_list(rows: DataFrame) -> DataFrame:
    """PL12 (PR12/PR13/DT3/CV2/NU1): OData price rows: etag and company
    dropped, names upper-cased, dates parsed safely, numbers coerced (bad ->
    0), blank strings '' (string columns only, Q18)."""
    df = upper_names(rows.drop("@odata.etag", "dataAreaId"))
    for c in PRICE_DATES:
        if c in df.columns:
            df = df.withColumn(c, D.safe_timestamp(c))
    for c in PRICE_NUMERIC:
        if c in df.columns:
            df = df.withColumn(c, C.double_or_zero(c))
    return C.fill_blank_strings(df)


def sales_invoices(rows: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """PL13 (PR12-PR14/DT3/CV2/NU1/DS1): invoices conformed to the declared
    schema: upper-case names, safe date, amounts (bad -> 0), '' for missing
    text, unknown columns dropped, missing ones added as '', distinct."""
    df = upper_names(rows).drop("@ODATA.ETAG")
    if "INVOICEDATE" in df.columns:
        df = df.withColumn("INVOICEDATE", D.safe_timestamp("INVOICEDATE"))
    for c in INVOICE_NUMERIC:
        if c in df.columns:
            df = df.withColumn(c, C.double_or_zero(c))
    df = C.fill_blank_strings(df)
    text_cols = [n for n, t in columns if "CHAR" in t.upper() or t.upper() == "STRING"]
    out = conform(df, columns)
    return out.fillna("", subset=[c for c in text_cols if isinstance(out.schema[c].dataType, StringType)]).distinct()


# Source names whose upper-snake form is not rule-derived.
TRANSFER_NAME_OVERRIDES = {"AXXWMSLocationId": "AXX_WMS_LOCATION_ID", "AXXDriverID": "AXX_DRIVER_ID",
                           "AXXDocTypeCode": "AXX_DOC_TYPE_CODE"}


def snake_upper(name: str) -> str:
    """PR10 helper: ``TransferOrderNumber`` -> ``TRANSFER_ORDER_NUMBER``."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    return s.upper()


def rename_snake(df: DataFrame, overrides: dict | None = None) -> DataFrame:
    """PR10/PR11: camelCase source columns renamed to upper snake case; an
    explicit ``overrides`` mapping wins over the rule."""
    overrides = {**TRANSFER_NAME_OVERRIDES, **(overrides or {})}
    return df.select(*[F.col(f"`{c}`").alias(overrides.get(c, snake_upper(c))) for c in df.columns])


def transfer_orders(headers: DataFrame, lines: DataFrame, asof, days_lookback: int,
                    overrides: dict | None = None):
    """PL14 (SC15/SC16/JN19/PR10/PR11/CV5/DT3): transfer headers whose
    requested receipt date falls in the ``days_lookback`` days up to
    ``asof``, and the lines of exactly those headers (one left semi join
    instead of one request per header).  Dates parse safely; the
    ``Yes``/``No`` reservation flag becomes a boolean (missing -> false).
    Returns ``(headers, lines)``."""
    h = rename_snake(headers, overrides)
    for c in [c for c in h.columns if c.endswith("_DATE")]:
        h = h.withColumn(c, D.safe_timestamp(c))
    end = D._lit_date(asof)
    h = h.where(F.to_date("REQUESTED_RECEIPT_DATE").between(F.date_sub(end, int(days_lookback)), end))
    ln = rename_snake(lines, overrides)
    for c in [c for c in ln.columns if c.endswith("_DATE")]:
        ln = ln.withColumn(c, D.safe_timestamp(c))
    if "IS_AUTOMATICALLY_RESERVED" in ln.columns:
        ln = ln.withColumn("IS_AUTOMATICALLY_RESERVED", C.flag_from_yes_no("IS_AUTOMATICALLY_RESERVED"))
    ln = ln.join(h.select("TRANSFER_ORDER_NUMBER"), "TRANSFER_ORDER_NUMBER", "left_semi")
    return h, ln


# ------------------------------------------------------- test-table inputs
def _erp_lines(spark, sf):
    """Sales lines in the ERP shape from ``lineitem`` (the 12 key parts)."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("double").alias("LINENUM"),
        F.concat(F.lit("RV"), F.col("l_partkey").cast("string")).alias("RETAILVARIANTID"),
        F.concat(F.lit("SO-"), F.col("l_orderkey").cast("string")).alias("SALESORDERNUMBER"),
        F.concat(F.lit("X"), F.col("l_partkey").cast("string")).alias("EXTERNALITEMNUMBER"),
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("ITEMNUMBER"),
        F.lit("C1").alias("PRODUCTCONFIGURATIONID"), F.col("l_returnflag").alias("PRODUCTCOLORID"),
        F.col("l_linestatus").alias("PRODUCTSIZEID"), F.lit("GEN").alias("PRODUCTSTYLEID"),
        F.lit("DISP").alias("ORDEREDINVENTORYSTATUSID"),
        F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("SHIPPINGWAREHOUSEID"),
        F.col("l_quantity").alias("ORDEREDSALESQUANTITY"), (F.col("l_quantity") * 1.5).alias("QTYORDERED"),
        F.col("l_shipdate").alias("SYNCSTARTDATETIME"))


def erp_sales_lines_q(spark, sf):
    """PL6: one year of ERP sales lines with duplicated orders excluded and
    the 12-part key built."""
    out = sales_lines(_erp_lines(spark, sf), "1998-06-01", "year")
    return out.select("SALESLINEPK", "SALESORDERNUMBER", "LINENUM", "QTYORDERED")


def processed_sales_rollup_q(spark, sf):
    """PL7: processed lines of one year rolled up to sales headers."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("SALESID"),
        F.to_date("l_shipdate").alias("INVOICEDATE"), F.col("o_orderdate").alias("CREATEDTRANSACTIONDATE2"),
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string")).alias("INVOICEID"),
        F.col("o_custkey").cast("string").alias("CUSTACCOUNT"),
        F.concat(F.lit("Org "), F.col("o_orderpriority")).alias("ORGANIZATIONNAME"),
        F.col("l_extendedprice").alias("SALESPRICE"), F.col("l_quantity").alias("QTY"),
        F.lit("CLP").alias("CURRENCYCODE"), F.col("o_orderpriority").alias("CANAL"),
        F.lit("Retail").alias("CECO"), F.col("l_linestatus").alias("TAXGROUP"),
        F.col("o_orderkey").cast("string").alias("PURCHORDERFORMNUM"))
    r = sales_rollup(lines.where(D.period_filter(F.col("INVOICEDATE"), "1998-06-01", "year")))
    return r.select("SALESID", F.date_format("INVOICEDATE", "yyyy-MM-dd").alias("INVOICEDATE"), "CREATEDTRANSACTION",
                    "INVOICEID", "CUSTOMERACCOUNT", "ORGANIZATIONNAME", F.round("SALESPRICETOTAL", 2).alias("SALESPRICETOTAL"),
                    F.round("QTYTOTAL", 2).alias("QTYTOTAL"), "CURRENCYCODE", "CANAL", "CECO", "TAXGROUP", "ORDERNUMBER")


def accounting_entries_q(spark, sf):
    """PL8/SC8/FL1/CV4: one month of accounting entries (from the lines:
    debit per line) with the 0/1 flags as booleans (null -> false)."""
    li = table(spark, sf, "lineitem")
    entries = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("ENTRY_ID"),
        F.col("l_shipdate").alias("ACCOUNTINGDATE"), F.col("l_extendedprice").alias("AMOUNT"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("ISSELECTED"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.lit(0))
        .alias("TRANSFERSTATUS"))
    out = accounting_entries(entries, "1999-06-15", "month")
    return out.select("ENTRY_ID", F.date_format("ACCOUNTINGDATE", "yyyy-MM-dd").alias("ACCOUNTINGDATE"),
                      "AMOUNT", "ISSELECTED", "TRANSFERSTATUS")


def transfer_orders_q(spark, sf):
    """PL14/SC15/SC16/JN19/PR10/PR11/CV5/DT3: transfer headers (camelCase
    OData rows) of the 30 days up to ``asof`` and the lines of exactly those
    headers, renamed to upper snake case, with the reservation flag as a
    boolean."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    headers = o.select(F.concat(F.lit("TR-"), F.col("o_orderkey").cast("string")).alias("TransferOrderNumber"),
                       D.ntz_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("RequestedReceiptDate"),
                       F.col("o_orderpriority").alias("ReceivingWarehouseId"))
    lines = li.select(F.concat(F.lit("TR-"), F.col("l_orderkey").cast("string")).alias("TransferOrderNumber"),
                      F.col("l_linenumber").alias("LineNumber"), F.col("l_partkey").alias("ItemNumber"),
                      F.when(F.col("l_returnflag") == "A", F.lit("Yes")).when(F.col("l_returnflag") == "N", F.lit("No"))
                      .alias("IsAutomaticallyReserved"))
    _, ln = transfer_orders(headers, lines, "2001-08-01", 30)
    return ln.select("TRANSFER_ORDER_NUMBER", "LINE_NUMBER", "ITEM_NUMBER", "IS_AUTOMATICALLY_RESERVED")


ORACLE = {
    "q_accounting_entries": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
                 || '-' || CAST(l_suppkey AS VARCHAR) AS ENTRY_ID,
               strftime(l_shipdate, '%Y-%m-%d') AS ACCOUNTINGDATE, l_extendedprice AS AMOUNT,
               l_returnflag = 'R' AS ISSELECTED,
               COALESCE(CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'N' THEN NULL ELSE 0 END, 0) != 0 AS TRANSFERSTATUS
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-06-01' AND l_shipdate < TIMESTAMP '1999-07-01'""",
    "q_transfer_orders": """
        SELECT 'TR-' || CAST(l_orderkey AS VARCHAR) AS TRANSFER_ORDER_NUMBER, l_linenumber AS LINE_NUMBER,
               l_partkey AS ITEM_NUMBER, COALESCE(l_returnflag = 'A', FALSE) AS IS_AUTOMATICALLY_RESERVED
        FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                             WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-02' AND DATE '2001-08-01')""",
    "q_erp_sales_lines": """
        WITH l AS (SELECT 'SO-' || CAST(l_orderkey AS VARCHAR) AS so, * FROM lineitem
                   WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'),
             d AS (SELECT so FROM l GROUP BY l_linenumber, l_partkey, so, l_returnflag, l_linestatus, l_suppkey, l_quantity
                   HAVING COUNT(*) > 1)
        SELECT CAST(l_linenumber AS VARCHAR) || '-RV' || CAST(l_partkey AS VARCHAR) || '-' || so || '-X'
                 || CAST(l_partkey AS VARCHAR) || '-I' || CAST(l_partkey AS VARCHAR) || '-C1-' || l_returnflag || '-'
                 || l_linestatus || '-GEN-DISP-W' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_quantity AS VARCHAR) AS SALESLINEPK,
               so AS SALESORDERNUMBER, l_linenumber AS LINENUM, CAST(TRUNC(l_quantity * 1.5) AS INTEGER) AS QTYORDERED
        FROM l WHERE so NOT IN (SELECT so FROM d)""",
    "q_processed_sales_rollup": """
        SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS SALESID, strftime(MAX(CAST(l_shipdate AS DATE)), '%Y-%m-%d') AS INVOICEDATE,
               MAX(o_orderdate) AS CREATEDTRANSACTION, MAX('INV-' || CAST(l_orderkey AS VARCHAR)) AS INVOICEID,
               MAX(CAST(o_custkey AS VARCHAR)) AS CUSTOMERACCOUNT, LEFT(MAX('Org ' || o_orderpriority), 100) AS ORGANIZATIONNAME,
               ROUND(SUM(l_extendedprice), 2) AS SALESPRICETOTAL, ROUND(SUM(l_quantity), 2) AS QTYTOTAL,
               'CLP' AS CURRENCYCODE, MAX(o_orderpriority) AS CANAL, 'Retail' AS CECO, MAX(l_linestatus) AS TAXGROUP,
               MAX(CAST(o_orderkey AS VARCHAR)) AS ORDERNUMBER
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE CAST(l_shipdate AS DATE) >= DATE '1998-01-01' AND CAST(l_shipdate AS DATE) < DATE '1999-01-01'
        GROUP BY 1""",
}

QUERIES = {
    "q_accounting_entries": accounting_entries_q,
    "q_transfer_orders": transfer_orders_q,
    "q_erp_sales_lines": erp_sales_lines_q,
    "q_processed_sales_rollup": processed_sales_rollup_q,
}
