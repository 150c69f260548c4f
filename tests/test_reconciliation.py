"""PL16 reports with the FIXTURES B7 edge rows."""

import datetime as dt

from ledgerline.plans.reconciliation import (discrepancy_alert, oms_missing, quantity_discrepancies,
                                             shop_missing)

from .conftest import rows

ASOF = "2024-03-20 12:00:00"
ERP = "PURCHORDERFORMNUM string, SALESPOOLID string, ITEMID string, QTY double"


def erp(spark):
    return spark.createDataFrame([
        ("E-1", "ECOM", "A", 1.0),        # matches suborder E-1 in the pool
        ("E-2", "STORE", "A", 1.0),       # key matches but not the pool -> E-2 still missing
        ("1001", "ECOM", "A", 2.0), ("1001", "ECOM", "DESPACHO", 9.0),   # shipping item ignored
        ("1002", "ECOM", "A", 1.0), ("NC-1002", "ECOM", "A", -1.0),      # credit note -> excluded
        ("1003", "ECOM", "A", 1.0), ("10031", "ECOM", "A", 1.0),         # suffixed order -> excluded
        ("1004", "ECOM", "A", 3.0),
    ], ERP)


def test_oms_missing(spark):
    sub = spark.createDataFrame([(1, "E-1", dt.datetime(2024, 3, 18)), (2, "E-2", dt.datetime(2024, 3, 18)),
                                 (3, None, dt.datetime(2024, 3, 19)), (4, "E-4", dt.datetime(2024, 1, 1))],
                                "ORDER_ID bigint, ECOMMERCE_NAME string, ORDER_DATE timestamp_ntz")
    out = oms_missing(sub, erp(spark), ASOF, 7, "https://x/")
    assert rows(out, "order_id", "order_number") == [(2, "E-2"), (3, None)]   # null name never matches


def test_shop_missing(spark):
    o = spark.createDataFrame([(1, "E-1", dt.datetime(2024, 3, 19), dt.datetime(2024, 3, 19), "paid"),
                               (2, "E-9", dt.datetime(2024, 3, 19), dt.datetime(2024, 3, 19), "paid"),
                               (3, "E-8", dt.datetime(2024, 3, 19), dt.datetime(2024, 3, 19), "pending")],
                              "ORDER_ID bigint, NAME string, PROCESSED_AT timestamp_ntz, CREATED_AT timestamp_ntz, "
                              "FINANCIAL_STATUS string")
    assert rows(shop_missing(o, erp(spark), ASOF, 7), "order_id") == [(2,)]


def test_quantity_discrepancies_and_alert(spark):
    lines = spark.createDataFrame([
        (11, 1001, dt.datetime(2024, 3, 13), "2"),      # 2 vs 2 (DESPACHO excluded) -> equal
        (12, 1002, dt.datetime(2024, 3, 13), "5"),      # differs but credit note exists
        (13, 1003, dt.datetime(2024, 3, 13), "4"),      # differs but suffixed order exists
        (14, 1004, dt.datetime(2024, 3, 13), "1"),      # 1 vs 3 -> reported
        (14, 1004, dt.datetime(2024, 3, 13), "x"),      # text quantity -> ignored in the sum
        (15, 1005, dt.datetime(2024, 3, 13), "1"),      # no ERP order -> not reported
    ], "ORDER_ID bigint, ORDER_NAME bigint, CREATED_AT timestamp_ntz, QUANTITY string")
    q = quantity_discrepancies(lines, erp(spark), ASOF, 7)
    assert rows(q, "order_id", "total_shop", "total_erp") == [(14, 1.0, 3)]
    a = discrepancy_alert(q.limit(0), q.limit(0), q, ASOF, max_days=7, number_results=5).first()
    # created 2024-03-13 00:00 vs asof 2024-03-20 12:00 -> 7 whole days, not older than 7
    assert (a["qty_count"], a["qty_older"], a["alert"]) == (1, False, False)
    a = discrepancy_alert(q.limit(0), q.limit(0), q, ASOF, max_days=6, number_results=5).first()
    assert a["alert"] is True
