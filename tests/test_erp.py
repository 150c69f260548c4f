"""ERP load jobs (PL8-PL13) on B11/B12-shaped rows."""

import datetime as dt

from ledgerline.operators.merge import export_csv
from ledgerline.plans import erp

from .conftest import rows


def test_wms_stock_drops_uppercases_dedupes(spark):
    raw = spark.createDataFrame([("W1", "A", 3, "x"), ("W1", "A", 3, "x"), ("W1", "A", 4, "x")],
                                "idWhs string, itemCode string, qty int, ownName string")
    out = erp.wms_stock(raw)
    assert out.columns == ["ITEMCODE", "QTY"]
    assert rows(out) == [("A", 3), ("A", 4)]


def test_price_list_cleaning(spark):
    raw = spark.createDataFrame([("e", "co", "1", "12.5", "2024-01-01", None), ("e", "co", "2", "abc", "bad", "x")],
                                "`@odata.etag` string, dataAreaId string, recordId string, price string, "
                                "priceApplicableFromDate string, note string")
    out = erp.price_list(raw)
    assert out.columns == ["RECORDID", "PRICE", "PRICEAPPLICABLEFROMDATE", "NOTE"]
    assert rows(out) == [(1.0, 12.5, dt.datetime(2024, 1, 1), ""), (2.0, 0.0, None, "x")]


def test_sales_invoices_conform(spark):
    raw = spark.createDataFrame([("e", "F-1", "100", "2024-02-01 10:00:00", "extra"),
                                 ("e", "F-1", "100", "2024-02-01 10:00:00", "extra"),
                                 ("e", "F-2", "n/a", "broken", "extra")],
                                "`@odata.etag` string, invoiceNumber string, totalInvoiceAmount string, "
                                "invoiceDate string, unknownCol string")
    cols = [("INVOICENUMBER", "VARCHAR"), ("TOTALINVOICEAMOUNT", "FLOAT"), ("INVOICEDATE", "TIMESTAMP_NTZ"),
            ("CURRENCYCODE", "VARCHAR(3)")]
    out = erp.sales_invoices(raw, cols)
    assert out.columns == [c for c, _ in cols]
    assert rows(out) == [("F-1", 100.0, dt.datetime(2024, 2, 1, 10), ""), ("F-2", 0.0, None, "")]


def test_accounting_flags_and_period(spark):
    raw = spark.createDataFrame([(dt.datetime(2024, 3, 2), 1, None), (dt.datetime(2024, 4, 1), 0, 1)],
                                "ACCOUNTINGDATE timestamp_ntz, ISSELECTED int, TRANSFERSTATUS int")
    out = erp.accounting_entries(raw, "2024-03-15", "month")
    assert rows(out, "ISSELECTED", "TRANSFERSTATUS") == [(True, False)]


def test_erp_stock_sku(spark):
    raw = spark.createDataFrame([("I1", "RED", "M"), ("I2", None, "L")], "ITEMNUMBER string, PRODUCTCOLORID string, PRODUCTSIZEID string")
    assert rows(erp.erp_stock(raw), "SKU") == [("I1-RED-M",), ("I2-None-L",)]


def test_export_csv(spark, tmp_path):
    df = spark.createDataFrame([("S2", 1), ("S1", 2)], "store string, n int")
    export_csv(df.coalesce(1), str(tmp_path / "out"), order_by=["store"])
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*.csv"))
    assert text.splitlines() == ["store;n", "S1;2", "S2;1"]


def test_transfer_orders(spark):
    assert erp.snake_upper("TransferOrderNumber") == "TRANSFER_ORDER_NUMBER"
    assert erp.snake_upper("ShippingAddressStateId") == "SHIPPING_ADDRESS_STATE_ID"
    hdr = spark.createDataFrame([("TR1", "2024-03-10T00:00:00Z", "x"), ("TR2", "2024-01-01T00:00:00Z", "y"),
                                 ("TR3", "broken", "z")],
                                "TransferOrderNumber string, RequestedReceiptDate string, AXXWMSLocationId string")
    lines = spark.createDataFrame([("TR1", 1, "Yes"), ("TR1", 2, None), ("TR2", 1, "No")],
                                  "TransferOrderNumber string, LineNumber int, IsAutomaticallyReserved string")
    h, ln = erp.transfer_orders(hdr, lines, "2024-03-12", 10)
    assert h.columns == ["TRANSFER_ORDER_NUMBER", "REQUESTED_RECEIPT_DATE", "AXX_WMS_LOCATION_ID"]
    assert rows(h, "TRANSFER_ORDER_NUMBER") == [("TR1",)]
    assert rows(ln, "TRANSFER_ORDER_NUMBER", "LINE_NUMBER", "IS_AUTOMATICALLY_RESERVED") == [("TR1", 1, True), ("TR1", 2, False)]
