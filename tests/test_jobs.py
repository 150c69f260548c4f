"""Jobs on FIXTURES edge rows: B3 variants, B6 ERP lines, B8 footprint
ledger, B9 replenishment."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.nested import flatten_product_variants
from ledgerline.plans import erp
from ledgerline.plans import replenishment as R
from ledgerline.plans.ledger import freight_ledger
from ledgerline.sources import documents as S

from .conftest import rows


def test_variants_edge_rows(spark):
    v = lambda vid, opts, levels=None, unit=None: {"node": {
        "id": f"gid://shopify/ProductVariant/{vid}", "sku": f"S{vid}", "price": "9.5",
        "inventoryItem": {"id": f"gid://shopify/InventoryItem/{vid}",
                          "inventoryLevels": {"edges": levels or []}},
        "selectedOptions": [{"name": n, "value": val} for n, val in opts], "weightUnit": unit}}
    level = {"node": {"quantities": [{"name": "committed", "quantity": 1}, {"name": "available", "quantity": 6}]}}
    doc = {"id": "gid://shopify/Product/77", "title": "P", "status": "ACTIVE", "tags": ["a", "b"],
           "images": {"edges": []},
           "variants": {"edges": [v(1, [("Title", "T"), ("Size", "M"), ("Color", "Red")], [level], "GRAMS"),
                                  v(2, [("Material", "wool")])]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "p string").select(S.parse_json(F.col("p"), S.COMMERCE_PRODUCT).alias("d")).select("d.*")
    out = {r["VARIANT_ID"]: r for r in flatten_product_variants(df).collect()}
    assert (out[1]["OPTION1"], out[1]["OPTION2"], out[1]["OPTION3"]) == ("T", "M", "Red")
    assert (out[1]["INVENTORY_QUANTITY"], out[1]["WEIGHT_UNIT"], out[1]["IMAGE_ID"]) == (6, "g", None)
    assert (out[2]["OPTION1"], out[2]["INVENTORY_QUANTITY"], out[2]["WEIGHT_UNIT"]) == (None, 0, "kg")
    assert out[1]["PRODUCT_ID"] == 77 and out[1]["TAGS"] == "a, b"


def test_erp_lines_edge_rows(spark):
    cols = erp.SALESLINE_KEY + ["QTYORDERED", "SYNCSTARTDATETIME"]
    ts = dt.datetime(2024, 5, 2, 10)
    base = [1.0, "RV", "SO-1", "X", "I", "C", "R", "M", "G", "D", "W", 2.0, 2.5, ts]
    dup_order = base[:2] + ["SO-2"] + base[3:]
    null_part = base[:1] + [None] + ["SO-3"] + base[3:]
    null_line = [None] + base[1:2] + ["SO-4"] + base[3:]
    df = spark.createDataFrame([tuple(base), tuple(dup_order), tuple(dup_order), tuple(null_part), tuple(null_line)],
                               "LINENUM double, RETAILVARIANTID string, SALESORDERNUMBER string, EXTERNALITEMNUMBER string, "
                               "ITEMNUMBER string, PRODUCTCONFIGURATIONID string, PRODUCTCOLORID string, PRODUCTSIZEID string, "
                               "PRODUCTSTYLEID string, ORDEREDINVENTORYSTATUSID string, SHIPPINGWAREHOUSEID string, "
                               "ORDEREDSALESQUANTITY double, QTYORDERED double, SYNCSTARTDATETIME timestamp_ntz")
    out = erp.sales_lines(df, "2024-05-02", "day")
    got = {r["SALESORDERNUMBER"]: (r["LINENUM"], r["SALESLINEPK"], r["QTYORDERED"]) for r in out.collect()}
    assert set(got) == {"SO-1", "SO-3", "SO-4"}                 # the duplicated order is excluded
    assert got["SO-1"] == (1, "1-RV-SO-1-X-I-C-R-M-G-D-W-2.0", 2)
    assert got["SO-3"][1].startswith("1-None-SO-3")            # null part printed, not skipped
    assert got["SO-4"][0] == 0 and got["SO-4"][1].startswith("0-RV")


def test_footprint_ledger_edge_rows(spark):
    H = ("TRANSFER_ORDER_NUMBER string, SHIPPING_WAREHOUSE_ID string, RECEIVING_WAREHOUSE_ID string, "
         "RECEIVING_ADDRESS_CITY string, RECEIVING_ADDRESS_DISTRICT_NAME string, REQUESTED_SHIPPING_DATE timestamp_ntz")
    d = dt.datetime(2024, 6, 10)
    headers = spark.createDataFrame([
        ("T1", "CD", "temuco", "x", "y", d),                   # lower-case warehouse -> Temuco
        ("T2", "CD", "ZZ", "Santiago", "Providencia", d),      # district hit before city hit
        ("T3", "CD", "ZZ", "LAS CONDES", "", d),               # city only by case
        ("T4", "CD", "ZZ", "Comuna de Renca", "", d),          # city only by containment
        ("T5", "CD", "ZZ", "Nowhere", "", d),                  # no hit -> default
        ("T6", "CD", "ZZ", "   ", "", d),                      # blank city -> default
        ("T7", "CD", "ZZ", "Temuco", "", d),                   # header without lines -> dropped
        ("T8", "XX", "ZZ", "Temuco", "", d),                   # not shipped from the centre
    ], H)
    lines = spark.createDataFrame([("T1", "A", 10), ("T2", "A", 1), ("T3", "A", 2), ("T4", "A", 3), ("T5", "A", 4),
                                   ("T6", "A", 5), ("T8", "A", 1), ("T1", "b", 1)],
                                  "TRANSFER_ORDER_NUMBER string, ITEM_NUMBER string, TRANSFER_QUANTITY bigint")
    sales = spark.createDataFrame([("WholeSale", "W1", "A", 1.0, d)],
                                  "CANAL string, PURCHORDERFORMNUM string, ITEMID string, QTY double, CREATEDTRANSACTIONDATE2 timestamp_ntz")
    led = {r["REFERENCE_NUMBER"]: r for r in freight_ledger(headers, lines, sales, "2024-06-01", "2024-06-30").collect()}
    assert set(led) == {"T1", "T2", "T3", "T4", "T5", "T6", "W1"}
    assert (led["T1"]["DESTINATION_ADDRESS"], led["T1"]["DESTINATION_ZIP_CODE"], led["T1"]["DISTANCE_KM"]) == ("Temuco", "4780000", 610.27)
    assert led["T1"]["WEIGHT_KG"] == 3.52                    # 11 x 0.32
    assert led["T2"]["DESTINATION_ADDRESS"] == "Providencia"
    assert led["T3"]["DESTINATION_ZIP_CODE"] == "7550000"
    assert led["T4"]["DESTINATION_ZIP_CODE"] == "8640000"
    assert (led["T5"]["DESTINATION_ZIP_CODE"], led["T5"]["DISTANCE_KM"]) == ("0000000", 10.0)
    assert led["T6"]["DESTINATION_ZIP_CODE"] == "0000000"
    assert (led["W1"]["CHANNEL"], led["W1"]["DESTINATION_ADDRESS"], led["W1"]["DESTINATION_ZIP_CODE"]) == \
        ("Wholesale", "Providencia", "7500000")
    assert led["T1"]["EMISSIONS_FACTOR"] == 0.12418 and led["T1"]["FECHA"] == "2024-06-10"


def test_replenishment_edge_rows(spark):
    L = ("REPLENISHMENT_ID string, STORE string, SKU string, REPLENISHMENT int, DELIVERY string, "
         "ERP_TR_ID string, ERP_LINE_ID string, WMS_SEND_STATUS string")
    lines = spark.createDataFrame([("R1", "S1", "A", 2, "d", None, None, None), ("R1", "S1", "B", 3, "d", None, None, None),
                                   ("R1", "S1", "C", 4, "d", None, None, None), ("R1", "S2", "A", 5, "d", None, None, None)], L)
    products = spark.createDataFrame([("A", "IA"), ("C", "IC")], "SKU string, ITEMNUMBER string") \
        .select("*", *[F.lit(None).cast("string").alias(c) for c in ("COLOR", "CONFIGURATION", "SIZE", "TEAM", "CATEGORY", "PRODUCTNAME")])
    enriched = R.enrich_lines(lines, products, "R1")
    valid, missing = R.split_valid(enriched)
    assert rows(valid, "STORE", "SKU", "LINENUMBER", "LINE_NO") == [("S1", "A", 1, 1), ("S1", "C", 3, 2), ("S2", "A", 1, 1)]
    assert rows(missing, "SKU") == [("B",)]
    res = spark.createDataFrame([("R1", "S1", "A", "TR1", "L1", None, "ok"), ("R1", "S1", "C", "TR1", None, "boom", None),
                                 ("R1", "S2", "A", "TR2", None, "boom", None)],
                                "REPLENISHMENT_ID string, STORE string, SKU string, ERP_TR_ID string, ERP_LINE_ID string, "
                                "ERROR string, WMS_SEND_STATUS string")
    stray = spark.createDataFrame([("R1", "S9", "A", "TR9", "L9", None, "ok")], res.schema)  # no such line: not counted
    o = R.outcome(enriched, res.unionByName(stray)).first()
    assert o == R.outcome(R.matched_lines(lines, products), res).first()
    assert (o["attempted"], o["successful"], o["api_failed"], o["missing"], o["outcome"]) == (3, 1, 2, 1, "partial")
    f = rows(R.failures(missing, res, valid), "STORE", "SKU", "ERROR", "LINE_NUMBER")
    assert f == [("S1", "B", "Missing ERP data", None), ("S1", "C", "boom", 2), ("S2", "A", "boom", 1)]
    with pytest.raises(ValueError):
        R.enrich_lines(lines, products, "nope")


def test_retail_events_edge_rows(spark):
    from ledgerline.plans.events import retail_events
    S_ = ("SALESID string, SALESLINEPK string, LINENUM int, INVOICEID string, CUSTACCOUNT string, ORGANIZATIONNAME string, "
          "PRIMARYCONTACTEMAIL string, CANAL string, CECO string, INVOICEDATE date, CREATEDTRANSACTIONDATE2 timestamp_ntz, "
          "ITEMID string, INVENTCOLORID string, INVENTSIZEID string, QTY double, LINEAMOUNTWITHTAXES double")
    t = dt.datetime(2024, 3, 5, 15, 0)
    sales = spark.createDataFrame([
        ("S1", "1", 1, "1-9", "C1", "Ana Perez", None, "costanera", "Retail", dt.date(2024, 3, 5), t, "I1", "R", "M", 1.0, 10.0),
        ("S1", "2", 2, "1-9", "C1", "Ana Perez", None, "costanera", "Retail", dt.date(2024, 3, 5), t, "I2", "R", "M", 2.0, 5.5),
        ("S2", "1", 1, "61-3", "C2", "Solo", "line@x", "pucon", "Retail", dt.date(2024, 3, 6), t, "I9", "B", "S", 1.0, 3.0),
        ("S0", "1", 1, "1-1", "C2", "Solo", "line@x", "pucon", "Retail", dt.date(2023, 6, 1), t, "I9", "B", "S", 1.0, 1.0),
        ("S3", "1", 1, "1-4", "55555555-5", "X", "x@x", "pucon", "Retail", dt.date(2024, 3, 6), t, "I1", "R", "M", 1.0, 1.0),
        ("S4", "1", 1, "1-5", "C3", "Nadie", None, "pucon", "Retail", dt.date(2024, 3, 6), t, "I1", "R", "M", 1.0, 1.0),
    ], S_)
    erp_c = spark.createDataFrame([("C1", "", "receipt@x"), ("C2", None, None)],
                                  "CUSTOMERACCOUNT string, PRIMARYCONTACTEMAIL string, RECEIPTEMAIL string")
    addrs = spark.createDataFrame([], "CUSTOMER_ID string, ORDER_ID string, EMAIL string")
    variants = spark.createDataFrame([("I1-R-M", 11, 1, "Tee", "Top", "tee", "tops, summer", "im", "alt", "src"),
                                      ("I2-R-M", 12, 2, "Cap", "Hat", "cap", "hats", "im", "alt", "src")],
                                     "VARIANT_SKU string, VARIANT_ID bigint, PRODUCT_ID bigint, PRODUCT_TITLE string, "
                                     "PRODUCT_TYPE string, PRODUCT_HANDLE string, PRODUCT_TAGS string, IMAGE_ID string, "
                                     "IMAGE_ALT string, IMAGE_SRC string")
    profiles = spark.createDataFrame([("receipt@x",)], "EMAIL string")
    ev = retail_events(sales, erp_c, addrs, variants, profiles, "2024-03-01", "2024-03-31")
    got = {(r["SALESID"], r["show_location"]): r for r in ev.collect()}
    assert {k[0] for k in got} == {"S1", "S2", "S0"}        # avoided account and no-email customer dropped;
    s1 = got[("S1", False)]                                  # C2 has no profile -> its older sale S0 too
    assert (s1["EMAIL"], s1["all_matched"], s1["total"], s1["item_count"]) == ("receipt@x", True, 15.5, 2)
    assert s1["tags"] == "hats, summer, tops" and s1["event"] == "Placed Retail Order"
    assert got[("S1", True)]["event"] == "Placed Retail Order - COSTANERA"
    assert got[("S2", True)]["event"] == "[NC] Placed retail return - PUCON"
    doc = json.loads(s1["document"])
    assert doc["customer_properties"]["$first_name"] == "Ana" and doc["customer_properties"]["$last_name"] == "Perez"
    assert doc["properties"]["Items"] == ["Tee", "Cap"] and doc["time"] == "2024-03-05T15:00:00+00:00"
    short = json.loads(got[("S2", False)]["document"])
    assert set(short["properties"]) == {"Order ID", "Categories", "ItemNames", "Skus", "RetailStore", "$value"}
    assert short["properties"]["Skus"] == ["I9-B-S"]
