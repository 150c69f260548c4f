"""Document sources: nested JSON / XML extracts flattened into tables
(PL1-PL5, PL12-PL15, SC1-SC17, JS1).

Each query first *lands* documents in the source's shape from the test
tables (orders + lines as commerce orders, users + events as status
histories, parts as product variants and OData pages, orders as tax XML);
that only produces input rows in the documented schema.  The job under test
then parses those documents with the declared read schema and flattens them
with the library's flatteners, exactly as it would a landed extract.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts as C
from ..functions import dates as D
from ..operators.conform import conform
from ..operators.nested import (flatten_commerce_customers, flatten_commerce_orders,
                                flatten_incidences, flatten_oms_orders, flatten_product_variants,
                                parse_tax_payload)
from ..sources import documents as S
from ..sources.tables import column_between, table, where_all

_money = lambda c: F.struct(F.struct(c.cast("string").alias("amount"), F.lit("CLP").alias("currencyCode")).alias("shopMoney"))


# ---------------------------------------------------------------- landing
def land_commerce_orders(spark, sf):
    """Commerce order documents (B1 shape) as JSON text, one per order."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    line_id = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    node = F.struct(F.concat(F.lit("gid://shopify/LineItem/"), line_id).alias("id"),
                    F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
                    _money(F.col("l_extendedprice")).alias("originalUnitPriceSet"))
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(node.alias("node"))).alias("edges"))
    k = F.col("o_orderkey").cast("string")
    doc = F.struct(
        F.concat(F.lit("gid://shopify/Order/"), k).alias("id"), k.alias("name"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@shop.example")).alias("email"),
        D.ntz_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
        F.col("o_orderstatus").alias("displayFinancialStatus"),
        _money(F.col("o_totalprice")).alias("totalPriceSet"),
        F.struct(F.concat(F.lit("gid://shopify/Customer/"), F.col("o_custkey").cast("string")).alias("id")).alias("customer"),
        F.struct(F.coalesce(F.col("edges"), F.array()).alias("edges")).alias("lineItems"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(F.to_json(doc).alias("payload"))


def nest_flatten_orders(spark, sf):
    """PL1/PR1-PR3/AR1/AR4: commerce order documents parsed with the read
    schema and flattened; the line table (orders without lines give none)."""
    docs = land_commerce_orders(spark, sf).select(S.parse_json(F.col("payload"), S.COMMERCE_ORDER).alias("d")).select("d.*")
    _, _, lines = flatten_commerce_orders(docs)
    return lines


def nest_flatten_order_headers(spark, sf):
    """PL1/PR1/NU5: the order header table of the same documents."""
    docs = land_commerce_orders(spark, sf).select(S.parse_json(F.col("payload"), S.COMMERCE_ORDER).alias("d")).select("d.*")
    orders, _, _ = flatten_commerce_orders(docs)
    return orders.select("ORDER_ID", "NAME", "EMAIL", "CREATED_AT", "FINANCIAL_STATUS", "CUSTOMER_ID",
                         "ACCEPTS_MARKETING", "MARKETING_OPT_IN_LEVEL", "DISCOUNTED_PRICE")


def json_props(spark, sf):
    """JS1/AG18: ``props`` JSON parsed per event, aggregated per type with
    an exact distinct count."""
    e = table(spark, sf, "events")
    k = S.parse_json(F.col("props"), "k bigint")["k"]
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum(k).alias("sum_k"),
                                       F.count_distinct(k).alias("n_distinct_k"),
                                       F.max(F.get_json_object("props", "$.k").cast("bigint")).alias("max_k"))


#: Rows of an OData page, and variants of a product document, at most.
PAGE_ROWS, VARIANTS = 10_000, 100


def land_products(spark, sf):
    """Product documents (B3 shape): one product per brand, its parts as
    variants, in documents of VARIANTS at most (inventory level only for larger sizes, image only for some)."""
    p = table(spark, sf, "part")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1)
    opts = F.array(F.struct(F.lit("Title").alias("name"), F.col("p_name").alias("value")),
                   F.struct(F.lit("Size").alias("name"), F.col("p_size").cast("string").alias("value")),
                   F.struct(F.when(F.col("p_type") == "PROMO", F.lit("COLOR")).otherwise(F.lit("Colour")).alias("name"),
                            F.col("p_type").alias("value")))
    level = F.struct(F.struct(F.struct(F.lit("L1").alias("id"), F.lit("Main").alias("name")).alias("location"),
                              F.array(F.struct(F.lit("committed").alias("name"), F.lit(1).alias("quantity")),
                                      F.struct(F.lit("available").alias("name"), F.col("p_size").alias("quantity")))
                              .alias("quantities")).alias("node"))
    variant = F.struct(
        F.concat(F.lit("gid://shopify/ProductVariant/"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("title"), F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.struct(F.concat(F.lit("gid://shopify/InventoryItem/"), F.col("p_partkey").cast("string")).alias("id"),
                 F.struct(F.filter(F.array(level), lambda x: F.col("p_size") > 10)
                          .alias("edges")).alias("inventoryLevels")).alias("inventoryItem"),
        F.lit("DENY").alias("inventoryPolicy"), opts.alias("selectedOptions"),
        F.col("p_retailprice").alias("weight"),
        F.when(F.col("p_size") < 10, F.lit("GRAMS")).when(F.col("p_size") < 30, F.lit("KILOGRAMS")).alias("weightUnit"))
    img = F.struct(F.struct(F.concat(F.lit("img-"), brand_no).alias("id"), F.col("p_brand").alias("altText"),
                            F.concat(F.lit("https://img.example/"), brand_no).alias("url")).alias("node"))
    types = p.groupBy("p_brand").agg(F.collect_set("p_type").alias("types"))
    prods = S.in_pages(p, ["p_brand"], F.struct(variant.alias("node")), ["p_partkey"], VARIANTS, "vedges").join(types, "p_brand")
    doc = F.struct(
        F.concat(F.lit("gid://shopify/Product/"), F.regexp_extract("p_brand", r"(\d+)$", 1)).alias("id"),
        F.col("p_brand").alias("title"), F.lit("ACTIVE").alias("status"),
        F.array_sort("types").alias("tags"),
        F.struct(F.filter(F.array(img), lambda x: brand_no.cast("int") > 10).alias("edges")).alias("images"),
        F.struct(F.col("vedges").alias("edges")).alias("variants"))
    return prods.select(F.to_json(doc).alias("payload"))


def nest_flatten_variants(spark, sf):
    """PL3/SC3/PR6/AR1/AR2/CD2/CV7: product documents -> variant rows with
    product columns, option slots by alias, available quantity, unit."""
    docs = land_products(spark, sf).select(S.parse_json(F.col("payload"), S.COMMERCE_PRODUCT).alias("d")).select("d.*")
    v = flatten_product_variants(docs)
    return v.select("VARIANT_ID", "PRODUCT_ID", "PRODUCT_TITLE", "TAGS", "SKU", F.round("PRICE", 2).alias("PRICE"),
                    "INVENTORY_QUANTITY", "OPTION1", "OPTION2", "OPTION3", "WEIGHT_UNIT", "IMAGE_ID")


def first_match_option(spark, sf):
    """AR2/CD2: the option slots of each variant (first alias match, null
    when none) and the normalised weight unit, straight from a list column."""
    from ..functions import arrays as A
    p = table(spark, sf, "part")
    opts = F.array(F.struct(F.lit("Title").alias("name"), F.col("p_name").alias("value")),
                   F.struct(F.lit("SIZE").alias("name"), F.col("p_size").cast("string").alias("value")),
                   F.struct(F.when(F.col("p_type") == "PROMO", F.lit("Color")).otherwise(F.lit("Colour")).alias("name"),
                            F.col("p_type").alias("value")))
    unit = F.when(F.col("p_size") < 10, F.lit("grams")).when(F.col("p_size") < 30, F.lit("KG"))
    return p.select("p_partkey", opts.alias("o"), unit.alias("u")).select(
        "p_partkey",
        A.first_match("o", "name", A.OPTION_ALIASES["option1"], "value").alias("option1"),
        A.first_match("o", "name", A.OPTION_ALIASES["option2"], "value").alias("option2"),
        A.first_match("o", "name", A.OPTION_ALIASES["option3"], "value").alias("option3"),
        A.weight_unit("u").alias("weight_unit"))


def land_oms_orders(spark, sf):
    """OMS suborder documents (B4 shape): lines sorted by (line, part,
    supplier); line id ``order*100 + line`` repeats where (order, line)
    repeats; transfer warehouses are the line suppliers per part."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    line = F.struct(F.col("l_linenumber").alias("_ln"), F.col("l_partkey").alias("_pk"), F.col("l_suppkey").alias("_sk"),
                    (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                    F.col("l_discount").alias("discount"), F.col("l_extendedprice").alias("price_total"),
                    F.col("l_quantity").alias("product_uom_qty"),
                    F.struct(F.col("l_partkey").cast("string").alias("default_code"),
                             F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name")).alias("product_id"))
    tw = F.struct(F.struct(F.col("l_partkey").cast("string").alias("sku")).alias("product_id"),
                  F.concat(F.lit("WH"), F.col("l_suppkey").cast("string")).alias("warehouse_name"))
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"), F.collect_list(tw).alias("tw"))
    doc = F.struct(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("id")).alias("ecommerce_sale_id"),
        F.col("o_totalprice").alias("amount_total"), F.col("o_orderkey").cast("string").alias("ecommerce_name_child"),
        F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("False"))
                 .otherwise(F.concat(F.lit("V-"), F.col("o_custkey").cast("string"))).alias("vat")).alias("partner_id"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("warehouse_id"),
        F.col("tw").alias("transfer_warehouse_ids"),
        F.transform("lines", lambda x: x.dropFields("_ln", "_pk", "_sk")).alias("order_line"))
    return o.join(g, o.o_orderkey == g.l_orderkey, "inner").select(F.to_json(doc).alias("payload"))


def line_map_lookup(spark, sf):
    """PL4/PR7/NU2/JN14/AR3/DS2/ST16: OMS documents flattened to lines; each
    line's transfer warehouses are looked up inside its own document (same
    SKU), joined as sorted distinct text; repeated line ids keep the first."""
    docs = land_oms_orders(spark, sf).select(S.parse_json(F.col("payload"), S.OMS_ORDER).alias("d")).select("d.*")
    lines, _ = flatten_oms_orders(docs)
    return lines.select("LINE_ID", "SUBORDER_ID", "ORDER_ID", "DEFAULT_CODE", "PRODUCT_UOM_QTY",
                        "PARTNER_VAT", "WAREHOUSE", "TRANSFER_WAREHOUSE", "CITY_NAME")


def land_status_docs(spark, sf):
    """OMS status-history documents: one per user and day, that day's events
    as the history (``error`` events carry a blank status)."""
    e = table(spark, sf, "events")
    e = where_all(e, [("value", ">", 0.5)])  # FL11: source-side tuple predicates
    st = F.struct(F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("status"),
                  D.ntz_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_date"))
    g = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_list(st)).alias("h"))
    doc = F.struct(F.col("user_id").alias("id"), F.col("user_id").cast("string").alias("ecommerce_name_child"),
                   F.col("h").alias("status_histories_ids"))
    return g.select(F.to_json(doc).alias("payload"))


def nest_flatten_status(spark, sf):
    """SC4/PR8/ST6/FL11/FL13: status histories exploded, blank statuses
    dropped, key ``child-status-date``, first occurrence per key kept."""
    docs = land_status_docs(spark, sf).select(S.parse_json(F.col("payload"), S.OMS_ORDER).alias("d")).select("d.*")
    _, hist = flatten_oms_orders(docs)
    return hist


def land_incidences(spark, sf):
    """OMS incidence documents (B5 shape): one per user, event type and day."""
    e = table(spark, sf, "events")
    h = F.struct(D.ntz_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_date"), F.col("event_type").alias("name"),
                 F.col("props").alias("description"),
                 F.when(F.col("value") > 50, F.lit("done")).alias("state"),
                 F.when(F.col("value") <= 80, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user"))
    g = e.groupBy("user_id", "event_type", F.to_date("ts").alias("day")) \
        .agg(F.min("ts").alias("first_ts"), F.array_sort(F.collect_list(h)).alias("history"))
    doc = F.struct(F.col("user_id").cast("string").alias("ecommerce_name_child"),
                   D.ntz_format("first_ts", "yyyy-MM-dd HH:mm:ss").alias("create_date"), "history")
    return g.select(F.to_json(doc).alias("payload"), F.col("event_type").alias("arrival"))


def incidence_current(spark, sf):
    """PL5/SC5/PR9/AG10/NU1: incidence documents -> the latest entry per
    suborder across all its incidences (ties: first arrival)."""
    landed = land_incidences(spark, sf)
    docs = landed.select(S.parse_json(F.col("payload"), S.OMS_INCIDENCE).alias("d"), "arrival").select("d.*", "arrival")
    current, _ = flatten_incidences(docs, arrival_col="arrival")
    return current.select("ECOMMERCE_NAME_CHILD", "LAST_REGISTER_DATE", "NAME", "STATE", "USER")


def land_tax_payloads(spark, sf):
    """Tax-document SOAP payloads: one per customer and day, the XML of its
    documents escaped as text; names hold lone ampersands, some amounts are
    ``null`` and some dates ISO or broken."""
    o = table(spark, sf, "orders")
    fecha = (F.when(F.col("o_orderstatus") == "F", D.ntz_format("o_orderdate", "dd/MM/yyyy"))
             .when(F.col("o_orderstatus") == "O", D.ntz_format("o_orderdate", "yyyy-MM-dd"))
             .otherwise(F.lit("31-31-2001")))
    neto = F.when(F.col("o_orderpriority").startswith("5"), F.lit("null")).otherwise(F.col("o_totalprice").cast("string"))
    doc = F.concat(F.lit("<Documento><TipoDTE>33</TipoDTE><Folio>"), F.col("o_orderkey").cast("string"),
                   F.lit("</Folio><FechEmis>"), fecha, F.lit("</FechEmis><RUTReceptor>"),
                   F.col("o_custkey").cast("string"), F.lit("-K</RUTReceptor><RazonSocialReceptor>"),
                   F.col("o_orderpriority"), F.lit(" & Co</RazonSocialReceptor><Neto>"), neto,
                   F.lit("</Neto><Total>"), F.col("o_totalprice").cast("string"), F.lit("</Total></Documento>"))
    g = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.array_sort(F.collect_list(doc)).alias("docs"))
    raw = F.concat(F.lit("<Documentos>"), F.array_join("docs", ""), F.lit("</Documentos>"))
    esc = F.replace(F.replace(F.replace(raw, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return g.select(F.concat(F.lit("<soap:Envelope><soap:Body><Respuesta>"), esc,
                             F.lit("</Respuesta></soap:Body></soap:Envelope>")).alias("payload"))


def xml_documents(spark, sf):
    """PL15/SC17/ST14/ST15/ST17/CV1/DT4: payloads unescaped, ampersands
    repaired, parsed with ``from_xml`` and exploded; typed columns."""
    d = parse_tax_payload(land_tax_payloads(spark, sf))
    return d.select("ID", "FOLIO", "FECHA_EMISION", "RUT_RECEPTOR", "RAZON_SOCIAL",
                    F.round("NETO", 2).alias("NETO"), F.round("TOTAL", 2).alias("TOTAL"))


PART_ODATA = [("PARTID", "BIGINT"), ("NAME", "VARCHAR"), ("BRAND", "VARCHAR"), ("PRICE", "FLOAT"),
              ("SIZE", "INT"), ("ISPROMO", "BOOLEAN")]


def json_array_docs(spark, sf):
    """SC11/SC13-SC15/PL12/PL13: OData pages ``{"@odata.etag", "value": [...]}``
    (per brand and type, of PAGE_ROWS rows at most) parsed, inlined, conformed to the declared
    schema; text price made numeric; ``Yes``/``No`` flag to boolean."""
    p = table(spark, sf, "part")
    row = F.struct(F.col("p_partkey").alias("partId"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
                   F.col("p_retailprice").cast("string").alias("price"), F.col("p_size").alias("size"),
                   F.when(F.col("p_type") == "PROMO", F.lit("Yes")).when(F.col("p_size") > 25, F.lit("No")).alias("isPromo"))
    pages = S.in_pages(p, ["p_brand", "p_type"], row, ["p_partkey"], PAGE_ROWS) \
        .select(F.to_json(F.struct(F.lit("W/\"1\"").alias("@odata.etag"), "value")).alias("payload"))
    schema = "`@odata.etag` string, value array<struct<partId:bigint,name:string,brand:string,price:string,size:int,isPromo:string>>"
    rows = S.odata_rows(pages.select(S.parse_json(F.col("payload"), schema).alias("d")).select("d.*"))
    rows = rows.withColumn("isPromo", C.flag_from_yes_no("isPromo"))
    return conform(rows, PART_ODATA)


def land_customers(spark, sf):
    """Customer documents (B2 shape): each customer with its orders as
    addresses (city = priority, company = status, id with query suffix)."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    a = F.struct(F.concat(F.lit("gid://shopify/MailingAddress/"), F.col("o_orderkey").cast("string"),
                          F.lit("?model_name=CustomerAddress")).alias("id"),
                 F.col("o_orderpriority").alias("city"), F.col("o_orderstatus").alias("company"),
                 F.lit("CL").alias("country"))
    g = o.groupBy("o_custkey").agg(F.collect_list(a).alias("addresses"), F.count(F.lit(1)).alias("n"),
                                   F.sum("o_totalprice").alias("spent"))
    doc = F.struct(F.concat(F.lit("gid://shopify/Customer/"), F.col("c_custkey").cast("string")).alias("id"),
                   F.col("c_name").alias("firstName"), F.col("n").alias("numberOfOrders"),
                   F.struct(F.round("spent", 2).cast("string").alias("amount")).alias("amountSpent"),
                   F.coalesce("addresses", F.array()).alias("addresses"))
    return c.join(g, c.c_custkey == g.o_custkey, "left").select(F.to_json(doc).alias("payload"))


def nest_flatten_customers(spark, sf):
    """PL2/SC2/PR4/PR5/ST3/AG8/JN12: customer documents -> address rows with
    the parent id, and per customer the most repeated address fields."""
    docs = land_customers(spark, sf).select(S.parse_json(F.col("payload"), S.COMMERCE_CUSTOMER).alias("d")).select("d.*")
    with_modes, addresses = flatten_commerce_customers(docs)
    return with_modes.select("SHOPIFY_ID", "FIRST_NAME", "ORDERS_COUNT", F.round("TOTAL_SPENT", 2).alias("TOTAL_SPENT"),
                             "MOST_REPEATED_CITY", "MOST_REPEATED_RUT")


def nest_flatten_addresses(spark, sf):
    """SC1/SC2/PR5: the exploded address table of the same documents."""
    docs = land_customers(spark, sf).select(S.parse_json(F.col("payload"), S.COMMERCE_CUSTOMER).alias("d")).select("d.*")
    _, addresses = flatten_commerce_customers(docs)
    return addresses.select("SHOPIFY_ID", "CUSTOMER_ID", "CITY", "COMPANY", "COUNTRY_NAME")


def semi_join_keys(spark, sf):
    """SC16/SC19/JN19/JN11/FL8: headers of a date range; their lines by a left
    semi join (one scan instead of one call per header); header + line sum
    inner-joined (headers without lines drop out)."""
    o = table(spark, sf, "orders")
    hdr = o.where(F.to_date("o_orderdate").between(F.lit("2000-01-01").cast("date"), F.lit("2000-06-30").cast("date"))) \
        .select("o_orderkey", "o_orderdate", "o_orderstatus")
    keys = column_between(o, "o_orderkey", "o_orderdate", "2000-01-01", "2000-06-30")  # SC19: kept distributed
    li = table(spark, sf, "lineitem")
    lines = li.join(keys.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    sums = lines.groupBy("l_orderkey").agg(F.round(F.sum("l_quantity"), 2).alias("total_qty"))
    return hdr.join(sums, hdr.o_orderkey == sums.l_orderkey, "inner").select("o_orderkey", "o_orderdate", "o_orderstatus", "total_qty")


ORACLE = {
    "q_nest_flatten_orders": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ORDER_ID,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                 || '-' || CAST(l_linenumber AS VARCHAR) AS LINE_ITEM_ID,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS CREATED_AT, CAST(o_orderkey AS VARCHAR) AS ORDER_NAME,
               'SKU-' || CAST(l_partkey AS VARCHAR) AS SKU, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS QUANTITY
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "q_nest_flatten_order_headers": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID, CAST(o_orderkey AS VARCHAR) AS NAME,
               'c' || CAST(o_custkey AS VARCHAR) || '@shop.example' AS EMAIL,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS CREATED_AT, lower(o_orderstatus) AS FINANCIAL_STATUS,
               CAST(o_custkey AS VARCHAR) AS CUSTOMER_ID, FALSE AS ACCEPTS_MARKETING, '' AS MARKETING_OPT_IN_LEVEL,
               CAST(NULL AS VARCHAR) AS DISCOUNTED_PRICE
        FROM orders""",
    "q_json_props": """
        SELECT event_type, COUNT(*) AS n_events, SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS sum_k,
               COUNT(DISTINCT CAST(json_extract(props, '$.k') AS BIGINT)) AS n_distinct_k,
               MAX(CAST(json_extract(props, '$.k') AS BIGINT)) AS max_k
        FROM events GROUP BY event_type""",
    "q_nest_flatten_variants": """
        SELECT p_partkey AS VARIANT_ID, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS PRODUCT_ID,
               p_brand AS PRODUCT_TITLE,
               (SELECT string_agg(t, ', ' ORDER BY t) FROM (SELECT DISTINCT p_type AS t FROM part q WHERE q.p_brand = part.p_brand)) AS TAGS,
               'SKU-' || CAST(p_partkey AS VARCHAR) AS SKU, ROUND(p_retailprice, 2) AS PRICE,
               CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS INVENTORY_QUANTITY,
               p_name AS OPTION1, CAST(p_size AS VARCHAR) AS OPTION2,
               CASE WHEN p_type = 'PROMO' THEN p_type END AS OPTION3,
               CASE WHEN p_size < 10 THEN 'g' WHEN p_size < 30 THEN 'kilograms' ELSE 'kg' END AS WEIGHT_UNIT,
               CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) > 10
                    THEN 'img-' || regexp_extract(p_brand, '(\\d+)$', 1) END AS IMAGE_ID
        FROM part""",
    "q_first_match_option": """
        SELECT p_partkey, p_name AS option1, CAST(p_size AS VARCHAR) AS option2,
               CASE WHEN p_type = 'PROMO' THEN p_type END AS option3,
               CASE WHEN p_size < 10 THEN 'g' WHEN p_size < 30 THEN 'kg' ELSE 'kg' END AS weight_unit
        FROM part""",
    "q_line_map_lookup": """
        WITH l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey * 100 + l_linenumber
                                                ORDER BY l_linenumber, l_partkey, l_suppkey, l_discount,
                                                         l_extendedprice, l_quantity) AS rn
                   FROM lineitem),
             tw AS (SELECT l_orderkey AS k, l_partkey AS p,
                           string_agg(DISTINCT 'WH' || CAST(l_suppkey AS VARCHAR), ', ' ORDER BY 'WH' || CAST(l_suppkey AS VARCHAR)) AS w
                    FROM lineitem GROUP BY 1, 2)
        SELECT l.l_orderkey * 100 + l.l_linenumber AS LINE_ID, o.o_orderkey AS SUBORDER_ID, o.o_custkey AS ORDER_ID,
               CAST(l.l_partkey AS VARCHAR) AS DEFAULT_CODE, l.l_quantity AS PRODUCT_UOM_QTY,
               CASE WHEN o.o_orderstatus = 'F' THEN '' ELSE 'V-' || CAST(o.o_custkey AS VARCHAR) END AS PARTNER_VAT,
               o.o_orderpriority AS WAREHOUSE, tw.w AS TRANSFER_WAREHOUSE, '' AS CITY_NAME
        FROM l JOIN orders o ON o.o_orderkey = l.l_orderkey
               JOIN tw ON tw.k = l.l_orderkey AND tw.p = l.l_partkey
        WHERE l.rn = 1""",
    "q_nest_flatten_status": """
        SELECT CAST(user_id AS VARCHAR) || '-' || event_type || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS PRIMARY_KEY,
               CAST(user_id AS VARCHAR) AS ECOMMERCE_NAME_CHILD, event_type AS STATUS,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS REGISTER_DATE
        FROM events WHERE value > 0.5 AND event_type != 'error'""",
    "q_incidence_current": """
        SELECT ECOMMERCE_NAME_CHILD, LAST_REGISTER_DATE, NAME, STATE, "USER" FROM (
          SELECT CAST(user_id AS VARCHAR) AS ECOMMERCE_NAME_CHILD,
                 strftime(ts, '%Y-%m-%d %H:%M:%S') AS LAST_REGISTER_DATE,
                 event_type AS NAME, CASE WHEN value > 50 THEN 'done' ELSE '' END AS STATE,
                 CASE WHEN value <= 80 THEN 'u' || CAST(user_id AS VARCHAR) ELSE '' END AS "USER",
                 ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_type ASC, props ASC) AS rn
          FROM events) WHERE rn = 1""",
    "q_xml_documents": """
        SELECT '33-' || CAST(o_orderkey AS VARCHAR) AS ID, CAST(o_orderkey AS VARCHAR) AS FOLIO,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS FECHA_EMISION,
               CAST(o_custkey AS VARCHAR) || '-K' AS RUT_RECEPTOR, o_orderpriority || ' & Co' AS RAZON_SOCIAL,
               CASE WHEN starts_with(o_orderpriority, '5') THEN NULL ELSE ROUND(o_totalprice, 2) END AS NETO,
               ROUND(o_totalprice, 2) AS TOTAL
        FROM orders""",
    "q_json_array_docs": """
        SELECT p_partkey AS PARTID, p_name AS NAME, p_brand AS BRAND, p_retailprice AS PRICE, p_size AS SIZE,
               p_type = 'PROMO' AS ISPROMO FROM part""",
    "q_nest_flatten_customers": """
        WITH a AS (SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS spent FROM orders GROUP BY 1),
             mc AS (SELECT o_custkey, o_orderpriority AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey
                           ORDER BY COUNT(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2),
             mr AS (SELECT o_custkey, o_orderstatus AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey
                           ORDER BY COUNT(*) DESC, o_orderstatus) AS rn FROM orders GROUP BY 1, 2)
        SELECT CAST(c.c_custkey AS VARCHAR) AS SHOPIFY_ID, c.c_name AS FIRST_NAME, a.n AS ORDERS_COUNT,
               ROUND(COALESCE(a.spent, 0.0), 2) AS TOTAL_SPENT, mc.v AS MOST_REPEATED_CITY, mr.v AS MOST_REPEATED_RUT
        FROM customer c LEFT JOIN a ON a.o_custkey = c.c_custkey
             LEFT JOIN mc ON mc.o_custkey = c.c_custkey AND mc.rn = 1
             LEFT JOIN mr ON mr.o_custkey = c.c_custkey AND mr.rn = 1""",
    "q_nest_flatten_addresses": """
        SELECT CAST(o_orderkey AS VARCHAR) AS SHOPIFY_ID, CAST(o_custkey AS VARCHAR) AS CUSTOMER_ID,
               o_orderpriority AS CITY, o_orderstatus AS COMPANY, 'CL' AS COUNTRY_NAME
        FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)""",
    "q_semi_join_keys": """
        SELECT o_orderkey, o_orderdate, o_orderstatus, ROUND(SUM(l_quantity), 2) AS total_qty
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-06-30'
        GROUP BY o_orderkey, o_orderdate, o_orderstatus""",
}

QUERIES = {
    "q_nest_flatten_orders": nest_flatten_orders,
    "q_nest_flatten_order_headers": nest_flatten_order_headers,
    "q_json_props": json_props,
    "q_nest_flatten_variants": nest_flatten_variants,
    "q_first_match_option": first_match_option,
    "q_line_map_lookup": line_map_lookup,
    "q_nest_flatten_status": nest_flatten_status,
    "q_incidence_current": incidence_current,
    "q_xml_documents": xml_documents,
    "q_json_array_docs": json_array_docs,
    "q_nest_flatten_customers": nest_flatten_customers,
    "q_nest_flatten_addresses": nest_flatten_addresses,
    "q_semi_join_keys": semi_join_keys,
}
