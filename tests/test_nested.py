"""Flattening source documents (B1, B2, B4, B5, B10 edge rows)."""

import json

from pyspark.sql import functions as F

from ledgerline.operators.nested import (flatten_commerce_customers, flatten_commerce_orders, flatten_incidences,
                                         flatten_oms_orders, parse_tax_payload)
from ledgerline.sources import documents as S

from .conftest import rows


def docs(spark, items, schema):
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "payload string")
    return df.select(S.parse_json(F.col("payload"), schema).alias("d")).select("d.*")


def test_commerce_orders(spark):
    money = lambda a: {"shopMoney": {"amount": a, "currencyCode": "CLP"}}
    items = [
        {"id": "gid://shopify/Order/1", "name": "#1", "displayFinancialStatus": "PAID",
         "customer": {"id": "gid://shopify/Customer/7", "emailMarketingConsent": {"marketingState": "SUBSCRIBED",
                                                                                  "marketingOptInLevel": "SINGLE"}},
         "shippingAddress": {"company": "11-1", "city": "Temuco"},
         "lineItems": {"edges": [{"node": {"id": "gid://shopify/LineItem/10", "sku": "A", "quantity": 2}}]},
         "shippingLines": {"edges": [{"node": {"discountedPriceSet": money("100")}},
                                     {"node": {"discountedPriceSet": money("999")}}]}},
        {"id": "2", "customer": None, "shippingAddress": None, "lineItems": {"edges": []},
         "displayFinancialStatus": None},
        {"id": "gid://shopify/Customer/3", "customer": {"id": "c", "emailMarketingConsent": {"marketingState": None}}},
    ]
    orders, ship, lines = flatten_commerce_orders(docs(spark, items, S.COMMERCE_ORDER))
    o = {r["ORDER_ID"]: r for r in orders.collect()}
    assert set(o) == {"1", "2", "gid://shopify/Customer/3"}
    assert (o["1"]["CUSTOMER_ID"], o["1"]["ACCEPTS_MARKETING"], o["1"]["DISCOUNTED_PRICE"]) == ("7", True, "100")
    assert (o["2"]["FINANCIAL_STATUS"], o["2"]["MARKETING_OPT_IN_LEVEL"], o["2"]["ACCEPTS_MARKETING"]) == ("", "", False)
    assert o["gid://shopify/Customer/3"]["MARKETING_OPT_IN_LEVEL"] is None
    assert rows(lines, "ORDER_ID", "LINE_ITEM_ID", "SKU", "QUANTITY") == [("1", "10", "A", "2")]
    assert rows(ship.where(F.col("ORDER_ID") == "1"), "CUSTOMER_ID", "CITY") == [("11-1", "Temuco")]


def test_customers_modes(spark):
    addr = lambda i, city, phone: {"id": f"gid://shopify/MailingAddress/{i}?model_name=CustomerAddress", "city": city,
                                   "phone": phone}
    items = [{"id": "gid://shopify/Customer/1", "amountSpent": {"amount": "10.5"},
              "addresses": [addr(1, "B", None), addr(2, "A", None), addr(3, "B", None), addr(4, "A", "9")]},
             {"id": "gid://shopify/Customer/2", "addresses": [], "amountSpent": None}]
    cust, addresses = flatten_commerce_customers(docs(spark, items, S.COMMERCE_CUSTOMER))
    c = {r["SHOPIFY_ID"]: r for r in cust.collect()}
    assert c["1"]["MOST_REPEATED_CITY"] == "A"      # tie -> smallest
    assert c["1"]["MOST_REPEATED_PHONE"] == "9"     # nulls ignored
    assert c["2"]["MOST_REPEATED_CITY"] is None and c["2"]["TOTAL_SPENT"] == 0.0
    assert rows(addresses, "SHOPIFY_ID") == [("1",), ("2",), ("3",), ("4",)]


def test_oms_orders(spark):
    items = [{"id": 5, "ecommerce_sale_id": {"id": 50}, "ecommerce_name_child": "E5",
              "partner_id": {"vat": "False"}, "warehouse_id": {"name": "W"},
              "transfer_warehouse_ids": [{"product_id": {"sku": "A"}, "warehouse_name": "T2"},
                                         {"product_id": {"sku": "A"}, "warehouse_name": "T1"},
                                         {"product_id": {"sku": "A"}, "warehouse_name": "T2"}],
              "order_line": [{"id": 1, "product_id": {"default_code": "A"}}, {"id": 1, "product_id": {"default_code": "B"}},
                             {"id": 2, "product_id": {"default_code": "B"}}],
              "status_histories_ids": [{"status": "new", "create_date": "d1"}, {"status": "", "create_date": "d2"},
                                       {"status": "new", "create_date": "d1"}]}]
    lines, hist = flatten_oms_orders(docs(spark, items, S.OMS_ORDER))
    assert rows(lines, "LINE_ID", "DEFAULT_CODE", "TRANSFER_WAREHOUSE", "PARTNER_VAT", "CITY_NAME") == \
        [(1, "A", "T1, T2", "", ""), (2, "B", "", "", "")]
    assert rows(hist, "PRIMARY_KEY", "STATUS") == [("E5-new-d1", "new")]


def test_incidences_latest(spark):
    h = lambda d, n, s=None: {"create_date": d, "name": n, "description": n, "state": s, "user": None}
    items = [{"ecommerce_name_child": "E1", "create_date": "2024-01-01 00:00:00",
              "history": [h("2024-01-02 10:00:00", "a", "open"), h("2024-01-03 10:00:00", "b"),
                          h("2024-01-03 10:00:00", "c")]},
             {"ecommerce_name_child": "E2", "create_date": "2024-01-01 00:00:00", "history": []}]
    current, history = flatten_incidences(docs(spark, items, S.OMS_INCIDENCE))
    assert rows(current, "ECOMMERCE_NAME_CHILD", "NAME", "STATE", "USER") == [("E1", "b", "", "")]
    assert history.count() == 3


def test_tax_payload(spark):
    inner = ("<Documentos><Documento><TipoDTE>33</TipoDTE><Folio>10</Folio><FechEmis>31/12/2024</FechEmis>"
             "<RazonSocialReceptor>Cobre & Co</RazonSocialReceptor><Neto>null</Neto><Total>119</Total></Documento>"
             "<Documento><TipoDTE>39</TipoDTE><FechEmis>2024-12-30</FechEmis><RazonSocialReceptor>A &amp; B"
             "</RazonSocialReceptor><Total>x</Total></Documento></Documentos>")
    esc = inner.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    df = spark.createDataFrame([(f"<soap:Envelope><Respuesta>{esc}</Respuesta></soap:Envelope>",)], "payload string")
    out = {r["TIPO_DTE"]: r for r in parse_tax_payload(df).collect()}
    assert out["33"]["ID"] == "33-10" and out["33"]["NETO"] is None and out["33"]["TOTAL"] == 119.0
    assert out["33"]["RAZON_SOCIAL"] == "Cobre & Co"
    assert str(out["33"]["FECHA_EMISION"])[:10] == "2024-12-31"
    assert out["39"]["ID"] == "" and out["39"]["TOTAL"] is None and out["39"]["RAZON_SOCIAL"] == "A & B"


def test_read_landed_json_files(spark, tmp_path):
    from ledgerline.sources.documents import OMS_INCIDENCE, read_json_documents
    path = tmp_path / "inc.jsonl"
    path.write_text('{"ecommerce_name_child": "E1", "create_date": "2024-01-01 00:00:00", '
                    '"history": [{"create_date": "2024-01-02 00:00:00", "name": "a"}]}\n'
                    '{"ecommerce_name_child": "E2", "history": "not a list"\n')
    df = read_json_documents(spark, str(path), OMS_INCIDENCE)
    got = {r["ecommerce_name_child"]: r["history"] for r in df.collect()}
    assert got["E1"][0]["name"] == "a"
    assert len(got) == 2 and None in got              # malformed record -> nulls, the scan does not fail


def _times(df, call):
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return plan.count(call)


def test_tax_documents_are_parsed_once(spark):
    from ledgerline.operators.nested import rejected_tax_payloads
    doc = lambda *x: "<S><Documentos>" + "".join(f"<Documento><TipoDTE>33</TipoDTE><Folio>{i}</Folio></Documento>" for i in x) + "</Documentos></S>"
    texts = [doc(1, 2), doc(3).replace("<", "&lt;"), "<S><Documentos></Documentos></S>", doc(4)[:-30], " ", None, "<S/>"]
    p = spark.createDataFrame([(t,) for t in texts], "payload string").repartition(2)
    read, bad = parse_tax_payload(p), rejected_tax_payloads(p)
    assert sorted(r["ID"] for r in read.collect()) == ["33-1", "33-2", "33-3"]
    assert sorted(r["REASON"] for r in bad.collect()) == ["empty", "empty", "no documents", "no documents", "unparsable"]
    assert bad.columns == ["payload", "REASON"]
    for df in (read, bad):
        assert _times(df.agg(F.count(F.lit(1))), "from_xml(") == 1


def test_documents_are_parsed_once_and_only_wanted_columns_move(spark):
    order = {"id": 1, "order_line": [{"id": 5, "product_id": {"default_code": "A"}}, {"id": 5, "product_id": {"default_code": "B"}}, {"id": 6}],
             "warehouse_id": {"name": "w"}, "status_histories_ids": []}
    d = docs(spark, [order, {"id": 2, "order_line": []}, {"id": 3, "order_line": [{"id": 5}]}], S.OMS_ORDER)
    lines, hist = flatten_oms_orders(d, columns=["SUBORDER_ID", "DEFAULT_CODE"])
    assert lines.columns == ["LINE_ID", "SUBORDER_ID", "DEFAULT_CODE"]
    assert rows(lines) == rows(flatten_oms_orders(d)[0].select(*lines.columns)) == [(5, 1, "A"), (6, 1, "")]
    plan = spark.createDataFrame([], "payload string").repartition(2).select(S.parse_json(F.col("payload"), S.OMS_ORDER).alias("d")).select("d.*")
    for df in flatten_oms_orders(plan):
        assert _times(df, "from_json(") == 1
