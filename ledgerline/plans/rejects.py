"""Sources with bad values, split into typed rows and rejects (UD5, Q14, FL12, CV1, CV5, CV6, DT3, DT4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.rejects import Declared, split_rejects
from ..sources.tables import table

INVOICE = [
    Declared("INVOICENUMBER", "VARCHAR(9)", "invoiceNumber", required=True),
    Declared("AMOUNT", "NUMBER(12,2)", "amount", required=True),
    Declared("INVOICEDATE", "TIMESTAMP", "invoiceDate", formats=("dd/MM/yyyy", "yyyy-MM-dd")),
    Declared("CUSTOMER", "BIGINT", "customer", required=True),
    Declared("ISCREDIT", "BOOLEAN", "isCredit"),
]
PRICE = [
    Declared("ITEMNUMBER", "VARCHAR", "itemNumber", required=True),
    Declared("PRICE", "FLOAT", "price", required=True),
    Declared("UNITS", "INT", "units"),
    Declared("FROMDATE", "DATE", "fromDate"),
]
TRANSFER = [
    Declared("TRANSFERORDER", "VARCHAR", "transferOrder", required=True),
    Declared("LINENUMBER", "INT", "lineNumber", required=True),
    Declared("QUANTITY", "NUMBER(8)", "quantity"),
    Declared("SHIPPED", "TIMESTAMP", "shipped"),
    Declared("DONE", "BOOLEAN", "done"),
]


def _sources(spark, sf):
    """The raw texts of three sources: some numbers, dates, flags and names are bad or missing."""
    o, p, li = (table(spark, sf, t) for t in ("orders", "part", "lineitem"))
    pick = lambda c, bad, good: _cases(F.pmod(c, F.lit(20)), bad).otherwise(good)
    key = F.col("o_orderkey")
    invoices = o.select(
        key.alias("id"), pick(key, {8: "INV-00000-X", 9: " "}, F.concat(F.lit("I"), key.cast("string"))).alias("invoiceNumber"),
        pick(key, {1: "n/a", 2: "1e15", 3: None}, F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("amount"),
        pick(key, {1: "31/31/2001", 4: "", 5: "01/02/2001"}, D.ntz_format("o_orderdate", "yyyy-MM-dd")).alias("invoiceDate"),
        pick(key, {6: "2.5", 7: "99999999999999999999", 8: "C-7"}, F.col("o_custkey").cast("string")).alias("customer"),
        pick(key, {5: "maybe", 6: "YES", 7: None}, F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No")).alias("isCredit"))
    key = F.col("p_partkey")
    prices = p.select(
        key.alias("id"), pick(key, {9: None}, F.concat(F.lit("P"), key.cast("string"))).alias("itemNumber"),
        pick(key, {1: "12,50", 2: "free", 3: "1.5e3", 4: ".5"}, F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("price"),
        pick(key, {1: "3000000000", 5: "a dozen", 6: " 12 "}, F.col("p_size").cast("string")).alias("units"),
        pick(key, {7: "2024-02-30", 8: "2024-02-29"}, F.lit("2024-01-01")).alias("fromDate"))
    key = F.col("l_orderkey") + F.col("l_linenumber")
    transfers = li.select(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("TR-"), F.col("l_orderkey").cast("string")).alias("transferOrder"),
        pick(key, {1: "", 2: "one"}, F.col("l_linenumber").cast("string")).alias("lineNumber"),
        pick(key, {2: "123456789", 3: "-0", 4: "4.0"}, F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        pick(key, {5: "yesterday"}, D.ntz_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("shipped"),
        pick(key, {6: "2", 7: "0", 8: "TRUE"}, F.lit(None).cast("string")).alias("done"))
    return {"invoice": (invoices, INVOICE), "price": (prices, PRICE), "transfer": (transfers, TRANSFER)}


def _cases(number, values):
    out = None
    for n, text in values.items():
        out = (F if out is None else out).when(number == n, F.lit(text).cast("string"))
    return out


def source_rejects(spark, sf):
    """UD5/Q14/CV1/CV5/CV6/DT3/DT4: every bad value of invoices, prices and transfers with its row's key, raw text and reason."""
    out = None
    for name, (raw, columns) in _sources(spark, sf).items():
        _, bad = split_rejects(raw, columns, ["id"], store=False)
        bad = bad.select(F.lit(name).alias("source"), "id", "column", "raw", "reason")
        out = bad if out is None else out.unionByName(bad)
    return out


def valid_invoices(spark, sf):
    """UD5/CV5/CV6/DT3/DT4: the invoices without a bad value, typed as declared."""
    raw, columns = _sources(spark, sf)["invoice"]
    valid, _ = split_rejects(raw, columns, ["id"], store=False)
    return valid.withColumn("AMOUNT", F.col("AMOUNT").cast("double"))


ORACLE = {
    "q_source_rejects": """
        WITH i AS (SELECT o_orderkey AS id, o_orderkey % 20 AS m FROM orders),
             p AS (SELECT p_partkey AS id, p_partkey % 20 AS m FROM part),
             t AS (SELECT l_orderkey AS id, (l_orderkey + l_linenumber) % 20 AS m FROM lineitem),
             bad(source, m, "column", raw, reason) AS (VALUES
                ('invoice', 8, 'INVOICENUMBER', 'INV-00000-X', 'too long'), ('invoice', 9, 'INVOICENUMBER', ' ', 'missing'),
                ('invoice', 1, 'AMOUNT', 'n/a', 'not a number'), ('invoice', 2, 'AMOUNT', '1e15', 'out of range'), ('invoice', 3, 'AMOUNT', NULL, 'missing'),
                ('invoice', 1, 'INVOICEDATE', '31/31/2001', 'not a date'), ('invoice', 6, 'CUSTOMER', '2.5', 'not a whole number'),
                ('invoice', 7, 'CUSTOMER', '99999999999999999999', 'out of range'), ('invoice', 8, 'CUSTOMER', 'C-7', 'not a number'),
                ('invoice', 5, 'ISCREDIT', 'maybe', 'not a flag'),
                ('price', 9, 'ITEMNUMBER', NULL, 'missing'), ('price', 1, 'PRICE', '12,50', 'not a number'), ('price', 2, 'PRICE', 'free', 'not a number'),
                ('price', 1, 'UNITS', '3000000000', 'out of range'), ('price', 5, 'UNITS', 'a dozen', 'not a number'),
                ('price', 7, 'FROMDATE', '2024-02-30', 'not a date'),
                ('transfer', 1, 'LINENUMBER', '', 'missing'), ('transfer', 2, 'LINENUMBER', 'one', 'not a number'),
                ('transfer', 2, 'QUANTITY', '123456789', 'out of range'), ('transfer', 4, 'QUANTITY', '4.0', 'not a whole number'),
                ('transfer', 5, 'SHIPPED', 'yesterday', 'not a date'), ('transfer', 6, 'DONE', '2', 'not a flag')),
             r AS (SELECT 'invoice' AS source, * FROM i UNION ALL SELECT 'price', * FROM p UNION ALL SELECT 'transfer', * FROM t)
        SELECT r.source, r.id, bad."column", bad.raw, bad.reason FROM r JOIN bad ON r.source = bad.source AND r.m = bad.m""",
    "q_valid_invoices": """
        SELECT 'I' || CAST(o_orderkey AS VARCHAR) AS INVOICENUMBER, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS AMOUNT,
               CASE WHEN o_orderkey % 20 <> 4 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS INVOICEDATE, o_custkey AS CUSTOMER,
               o_orderstatus = 'F' AS ISCREDIT
        FROM orders WHERE o_orderkey % 20 NOT IN (1, 2, 3, 5, 6, 7, 8, 9)""",
}

QUERIES = {"q_source_rejects": source_rejects, "q_valid_invoices": valid_invoices}
