"""Flatten nested source documents into fixed tables, and build nested
result documents (PR1-PR9, AR1-AR5, NU2, NU5, JS1-JS3, SC17, ST14-ST17).

Flattening is ``select`` of struct paths plus ``explode``/``inline`` of the
child lists; every path is null-safe, so the reference's "default at every
level" becomes one ``coalesce`` at the leaf.  No document ever passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import casts as C
from ..functions import text as T
from ..functions.dates import ntz_format, parse_day_first, ts_micros
from ..operators.dedupe import keep_first
from ..operators.rollup import mode_per_group
from ..sources.documents import TAX_DOCUMENT

SUBSCRIBED = "SUBSCRIBED"


def _exploded(c, name: str, pos: str = "_pos") -> Column:
    """``posexplode`` whose parsed document is read once: the plain generator has Spark filter on the list's
    size below it, which parses the document again for each such term.  Rows of null or empty lists have a null ``pos``."""
    return F.posexplode_outer(c).alias(pos, name)


# ---------------------------------------------------------------- PL1 orders
def flatten_commerce_orders(docs: DataFrame):
    """PL1: commerce order documents -> ``(orders, shipping_addresses, lines)``.

    ``docs`` has the columns of ``sources.documents.COMMERCE_ORDER``.
    Missing customer / address give null fields; an order without line items
    gives no line rows; only the first shipping line counts.
    """
    cust = F.col("customer")
    consent = cust["emailMarketingConsent"]
    opt_in = F.when(consent.isNull(), F.lit("")).otherwise(consent["marketingOptInLevel"])
    accepts = C.equals_null_safe(consent["marketingState"], SUBSCRIBED)
    money = lambda c: F.col(c)["shopMoney"]["amount"]
    ship_first = A.first_or_null(A.unwrap_edges(F.col("shippingLines")))
    base = docs.select(
        T.strip_gid(F.col("id"), "Order").alias("ORDER_ID"), "*",
        opt_in.alias("_opt_in"), accepts.alias("_accepts"))
    orders = base.select(
        "ORDER_ID", F.col("email").alias("EMAIL"), F.col("createdAt").alias("CREATED_AT"),
        money("currentSubtotalPriceSet").alias("CURRENT_SUBTOTAL_PRICE"),
        money("currentTotalDiscountsSet").alias("CURRENT_TOTAL_DISCOUNTS"),
        money("currentTotalPriceSet").alias("CURRENT_TOTAL_PRICE"),
        F.lower(F.coalesce(F.col("displayFinancialStatus"), F.lit(""))).alias("FINANCIAL_STATUS"),
        F.col("name").alias("NAME"), F.col("processedAt").alias("PROCESSED_AT"),
        money("subtotalPriceSet").alias("SUBTOTAL_PRICE"), F.col("updatedAt").alias("UPDATED_AT"),
        T.strip_gid(cust["id"], "Customer").alias("CUSTOMER_ID"),
        F.lit(None).cast("string").alias("SMS_MARKETING_CONSENT"),
        F.array_join(cust["tags"], ", ").alias("TAGS"),
        F.col("_accepts").alias("ACCEPTS_MARKETING"),
        consent["consentUpdatedAt"].alias("ACCEPTS_MARKETING_UPDATED_AT"),
        F.col("_opt_in").alias("MARKETING_OPT_IN_LEVEL"),
        ship_first["discountedPriceSet"]["shopMoney"]["amount"].alias("DISCOUNTED_PRICE"))
    addr = F.col("shippingAddress")
    shipping = base.select(
        "ORDER_ID", addr["company"].alias("CUSTOMER_ID"), F.col("email").alias("EMAIL"),
        F.col("createdAt").alias("ORDER_DATE"), addr["firstName"].alias("FIRST_NAME"),
        addr["lastName"].alias("LAST_NAME"), addr["address1"].alias("ADDRESS1"),
        addr["address2"].alias("ADDRESS2"), addr["city"].alias("CITY"), addr["zip"].alias("ZIP"),
        addr["province"].alias("PROVINCE"), addr["country"].alias("COUNTRY"), addr["phone"].alias("PHONE"),
        addr["latitude"].alias("LATITUDE"), addr["longitude"].alias("LONGITUDE"),
        F.col("_accepts").alias("ACCEPTS_MARKETING"), F.col("_opt_in").alias("MARKETING_OPT_IN_LEVEL"))
    lines = base.select("ORDER_ID", "createdAt", "name",
                        _exploded(A.unwrap_edges(F.col("lineItems")), "li")).where("_pos IS NOT NULL").select(
        "ORDER_ID", T.strip_gid(F.col("li.id"), "LineItem").alias("LINE_ITEM_ID"),
        F.col("createdAt").alias("CREATED_AT"), F.col("name").alias("ORDER_NAME"),
        F.col("li.sku").alias("SKU"), F.col("li.quantity").cast("string").alias("QUANTITY"))
    return orders, shipping, lines


# ------------------------------------------------------------- PL2 customers
ADDRESS_MODE_COLUMNS = {"NAME": "MOST_REPEATED_NAME", "PHONE": "MOST_REPEATED_PHONE",
                        "ADDRESS1": "MOST_REPEATED_ADDRESS1", "ADDRESS2": "MOST_REPEATED_ADDRESS2",
                        "COMPANY": "MOST_REPEATED_RUT", "PROVINCE": "MOST_REPEATED_PROVINCE",
                        "CITY": "MOST_REPEATED_CITY"}


def flatten_commerce_customers(docs: DataFrame):
    """PL2: customer documents -> ``(customers_with_modes, addresses)``.

    Addresses are exploded with the parent id (PR5), their ids cut at the
    ``?model_name=CustomerAddress`` suffix (ST3), ``COUNTRY_NAME`` copies
    ``COUNTRY``.  Per customer the most repeated value of seven address
    fields (AG8) is left-joined to the customer rows (JN12).
    """
    consent = F.col("emailMarketingConsent")
    customers = docs.select(
        T.strip_gid(F.col("id"), "Customer").alias("SHOPIFY_ID"), F.col("email").alias("EMAIL"),
        consent["marketingState"].alias("ACCEPTS_MARKETING"), F.col("createdAt").alias("CREATED_AT"),
        F.col("updatedAt").alias("UPDATED_AT"), F.col("firstName").alias("FIRST_NAME"),
        F.col("lastName").alias("LAST_NAME"), F.col("numberOfOrders").alias("ORDERS_COUNT"),
        F.lit(None).cast("string").alias("STATE"),
        F.coalesce(F.col("amountSpent.amount").try_cast("double"), F.lit(0.0)).alias("TOTAL_SPENT"),
        F.lit(None).cast("string").alias("LAST_ORDER_ID"),
        consent["consentUpdatedAt"].alias("ACCEPTS_MARKETING_UPDATED_AT"),
        consent["marketingOptInLevel"].alias("MARKETING_OPT_IN_LEVEL"))
    addresses = docs.select(T.strip_gid(F.col("id"), "Customer").alias("CUSTOMER_ID"),
                            _exploded("addresses", "a")).where("_pos IS NOT NULL").select(
        T.cut_query_suffix(T.strip_gid(F.col("a.id"), "MailingAddress")).alias("SHOPIFY_ID"), "CUSTOMER_ID",
        F.col("a.firstName").alias("FIRST_NAME"), F.col("a.lastName").alias("LAST_NAME"),
        F.col("a.company").alias("COMPANY"), F.col("a.address1").alias("ADDRESS1"),
        F.col("a.address2").alias("ADDRESS2"), F.col("a.city").alias("CITY"),
        F.col("a.province").alias("PROVINCE"), F.col("a.country").alias("COUNTRY"), F.col("a.zip").alias("ZIP"),
        F.col("a.phone").alias("PHONE"), F.col("a.name").alias("NAME"),
        F.col("a.provinceCode").alias("PROVINCE_CODE"), F.col("a.countryCode").alias("COUNTRY_CODE"),
        F.col("a.country").alias("COUNTRY_NAME"))
    modes = mode_per_group(addresses, ["CUSTOMER_ID"], list(ADDRESS_MODE_COLUMNS))
    modes = modes.select(F.col("CUSTOMER_ID").alias("_mid"),
                         *[F.col(k).alias(v) for k, v in ADDRESS_MODE_COLUMNS.items()])
    with_modes = customers.join(modes, customers.SHOPIFY_ID == modes._mid, "left").drop("_mid")
    return with_modes, addresses


# -------------------------------------------------------------- PL3 variants
def flatten_product_variants(docs: DataFrame, variant_image: bool = False) -> DataFrame:
    """PL3: product documents -> one row per variant with product columns.

    Options fill ``option1..3`` by the first selected option whose name
    matches the slot's aliases (AR2); inventory is the ``available`` quantity
    of the first inventory level, 0 when none (AR1/AR2); the image is the
    product's first image (the reference never copies the variant image,
    quirk Q8; ``variant_image=True`` prefers it).
    """
    first_img = A.first_or_null(A.unwrap_edges(F.col("images")))
    prod = docs.select(
        T.strip_gid_after_prefix(F.col("id"), "Product").alias("PRODUCT_ID"), F.col("title").alias("PRODUCT_TITLE"),
        F.col("bodyHtml").alias("BODY_HTML"), F.col("vendor").alias("VENDOR"),
        F.col("productType").alias("PRODUCT_TYPE"), F.col("handle").alias("HANDLE"),
        F.array_join("tags", ", ").alias("TAGS"), F.lower("status").alias("STATUS"),
        first_img.alias("_img"), _exploded(A.unwrap_edges(F.col("variants")), "v")).where("_pos IS NOT NULL")
    v = F.col("v")
    level = A.first_or_null(A.unwrap_edges(v["inventoryItem"]["inventoryLevels"]))
    img = F.coalesce(v["image"], F.col("_img")) if variant_image else F.col("_img")
    opts = {slot: A.first_match(v["selectedOptions"], "name", names, "value")
            for slot, names in A.OPTION_ALIASES.items()}
    return prod.select(
        C.numeric_id(v["id"]).alias("VARIANT_ID"), C.numeric_id(F.col("PRODUCT_ID")).alias("PRODUCT_ID"),
        "PRODUCT_TITLE", "BODY_HTML", "VENDOR", "PRODUCT_TYPE", "HANDLE", "TAGS", "STATUS",
        v["title"].alias("VARIANT_TITLE"), v["sku"].alias("SKU"), v["price"].try_cast("double").alias("PRICE"),
        v["compareAtPrice"].try_cast("double").alias("COMPARE_AT_PRICE"),
        T.strip_gid(v["inventoryItem"]["id"], "InventoryItem").alias("INVENTORY_ITEM_ID"),
        F.when(level.isNull(), F.lit(0)).otherwise(A.available_quantity(level["quantities"])).alias("INVENTORY_QUANTITY"),
        F.lower(v["inventoryPolicy"]).alias("INVENTORY_POLICY"),
        opts["option1"].alias("OPTION1"), opts["option2"].alias("OPTION2"), opts["option3"].alias("OPTION3"),
        v["taxable"].alias("TAXABLE"), v["barcode"].alias("BARCODE"),
        F.coalesce(v["weight"], F.lit(0.0)).alias("WEIGHT"), A.weight_unit(v["weightUnit"]).alias("WEIGHT_UNIT"),
        img["id"].alias("IMAGE_ID"), img["url"].alias("IMAGE_SRC"), img["altText"].alias("IMAGE_ALT"))


# ------------------------------------------------------------------ PL4 OMS
def flatten_oms_orders(docs: DataFrame, arrival_col: str | None = None, columns: list[str] | None = None):
    """PL4: OMS suborder documents -> ``(lines, status_history)``.

    Each line carries 20+ suborder columns; deep address paths default to
    '' at the leaf (NU2); the partner tax id maps ``nan``/``False`` to ''
    (ST16); ``TRANSFER_WAREHOUSE`` is the sorted distinct set of transfer
    warehouses of the same SKU in the same document (JN14/AR3, no shuffle).
    A repeated line id keeps its first occurrence (DS2): "first" is the
    smallest ``arrival_col`` (e.g. the document's position in the landed
    file), or the smallest suborder id when none is given.  ``columns`` names
    the line columns wanted beside ``LINE_ID`` (all by default): whole rows are
    picked, so Spark cannot leave out the others by itself.
    """
    addr = F.col("ecommerce_sale_id.shipment_address_id")
    partner = F.col("partner_id")
    arrival = F.col(arrival_col) if arrival_col else F.col("id")
    lines = docs.select("*", arrival.alias("_arrival"), _exploded("order_line", "l")).where("_pos IS NOT NULL")
    code = F.col("l.product_id.default_code")
    tw = F.filter("transfer_warehouse_ids", lambda t: t["product_id"]["sku"] == code)
    out = lines.select(
        F.col("l.id").alias("LINE_ID"), F.col("id").alias("SUBORDER_ID"),
        F.col("ecommerce_sale_id.id").alias("ORDER_ID"),
        F.col("amount_discount").alias("AMOUNT_DISCOUNT"), F.col("amount_tax").alias("AMOUNT_TAX"),
        F.col("amount_total").alias("AMOUNT_TOTAL"), F.col("amount_untaxed").alias("AMOUNT_UNTAXED"),
        F.col("current_state_id.state_option_id.name").alias("STATE_OPTION_NAME"),
        F.col("date_order").alias("DATE_ORDER"), F.col("delivery_client_date").alias("DELIVERY_CLIENT_DATE"),
        F.col("delivery_method_id.name").alias("DELIVERY_METHOD_NAME"),
        F.col("ecommerce_date_order").alias("ECOMMERCE_DATE_ORDER"),
        F.col("ecommerce_name").alias("ECOMMERCE_NAME"), F.col("ecommerce_name_child").alias("ECOMMERCE_NAME_CHILD"),
        C.leaf_or_blank(addr["city_id"]["name"]).alias("CITY_NAME"), C.leaf_or_blank(addr["street"]).alias("STREET"),
        C.leaf_or_blank(addr["phone"]).alias("PHONE"), C.leaf_or_blank(addr["state_id"]["name"]).alias("STATE_NAME"),
        F.col("l.discount").alias("DISCOUNT"), F.col("l.price_reduce").alias("PRICE_REDUCE"),
        F.col("l.price_total").alias("PRICE_TOTAL"), F.col("l.price_unit").alias("PRICE_UNIT"),
        F.col("l.product_uom_qty").alias("PRODUCT_UOM_QTY"),
        F.coalesce(F.nullif(code, F.lit("False")), F.lit("")).alias("DEFAULT_CODE"),
        F.col("l.product_id.name").alias("PRODUCT_NAME"),
        C.leaf_or_blank(partner["email"]).alias("EMAIL"), C.leaf_or_blank(partner["name"]).alias("PARTNER_NAME"),
        C.leaf_or_blank(partner["phone"]).alias("PARTNER_PHONE"),
        C.leaf_or_blank(partner["street"]).alias("PARTNER_STREET"),
        T.blank_sentinels(C.leaf_or_blank(partner["vat"])).alias("PARTNER_VAT"),
        F.coalesce(F.col("payment_method_id.name"), F.lit("")).alias("PAYMENT_METHOD_NAME"),
        F.col("warehouse_id.name").alias("WAREHOUSE"),
        A.joined_set(F.transform(tw, lambda t: t["warehouse_name"])).alias("TRANSFER_WAREHOUSE"),
        "_arrival", "_pos")
    if columns is not None:
        out = out.select("LINE_ID", *columns, "_arrival", "_pos")
    lines_out = keep_first(out, ["LINE_ID"], ["_arrival", "_pos"]).drop("_arrival", "_pos")
    hist = docs.select("ecommerce_name_child", arrival.alias("_arrival"),
                       _exploded("status_histories_ids", "s")) \
        .where(F.col("_pos").isNotNull() & C.truthy(F.col("s.status")))
    hist = hist.select(
        T.key_text("ecommerce_name_child", F.col("s.status"), F.col("s.create_date")).alias("PRIMARY_KEY"),
        F.col("ecommerce_name_child").alias("ECOMMERCE_NAME_CHILD"), F.col("s.status").alias("STATUS"),
        F.col("s.create_date").alias("REGISTER_DATE"), "_arrival", "_pos")
    hist_out = keep_first(hist, ["PRIMARY_KEY"], ["_arrival", "_pos"]).drop("_arrival", "_pos")
    return lines_out, hist_out


# ------------------------------------------------------------ PL5 incidences
def flatten_incidences(docs: DataFrame, arrival_col: str | None = None):
    """PL5: incidence documents -> ``(current, history)``.

    ``history`` has one row per history entry (distinct, state/user '' when
    null); ``current`` keeps per suborder the entry with the latest date,
    the first one on equal dates (arrival order, then list position).
    """
    arrival = F.col(arrival_col) if arrival_col else F.lit(0)
    h = docs.select("ecommerce_name_child", F.col("create_date").alias("_inc_date"), arrival.alias("_arrival"),
                    _exploded("history", "h")).where("_pos IS NOT NULL")
    ts = F.col("h.create_date").try_cast("timestamp_ntz")
    rows = h.select(
        "ecommerce_name_child", "_inc_date", "_arrival", "_pos", ts.alias("_ts"),
        F.concat_ws("-", F.col("ecommerce_name_child"), ntz_format(ts, "yyyy-MM-dd HH:mm:ss"),
                    F.col("h.name")).alias("PRIMARY_KEY"),
        F.col("h.description").alias("DESCRIPTION"), F.col("h.name").alias("NAME"),
        F.coalesce(F.col("h.state"), F.lit("")).alias("STATE"), F.coalesce(F.col("h.user"), F.lit("")).alias("USER"))
    history = rows.select("PRIMARY_KEY", F.col("ecommerce_name_child").alias("ECOMMERCE_NAME_CHILD"),
                          ntz_format("_ts", "yyyy-MM-dd HH:mm:ss").alias("CREATE_DATE"),
                          "DESCRIPTION", "NAME", "STATE", "USER").distinct()
    # latest entry; on equal dates the earliest arrival, then list position
    # (the reference replaces only on a strictly later date); null dates lose
    newest_first = F.coalesce(-ts_micros(F.col("_ts")), F.lit(2 ** 62))
    cur = keep_first(rows.select("ecommerce_name_child", "_inc_date", "_ts", newest_first.alias("_nf"),
                                 "_arrival", "_pos", "DESCRIPTION", "NAME", "STATE", "USER"),
                     ["ecommerce_name_child"], ["_nf", "_arrival", "_pos"])
    current = cur.select(
        F.col("ecommerce_name_child").alias("ECOMMERCE_NAME_CHILD"),
        ntz_format(F.col("_inc_date").try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("INCIDENCE_CREATE_DATE"),
        ntz_format("_ts", "yyyy-MM-dd HH:mm:ss").alias("LAST_REGISTER_DATE"),
        "DESCRIPTION", "NAME", "STATE", "USER")
    return current, history


# ------------------------------------------------------------- PL15 tax XML
def _tax_documents(text_col: str) -> Column:
    xml = T.repair_ampersands(T.html_unescape(F.col(text_col)))
    docs_schema = f"Documento array<struct<{TAX_DOCUMENT.replace(' string', ':string')}>>"
    return F.from_xml(F.regexp_extract(xml, r"(?s)(<Documentos>.*</Documentos>)", 1), docs_schema)


def rejected_tax_payloads(payload: DataFrame, text_col: str = "payload") -> DataFrame:
    """PL15/Q14: the payloads no document could be read from, with the reason:
    ``empty`` (null or blank text), ``no documents`` (no such element) or
    ``unparsable``."""
    text, found = F.col(text_col), F.col("_d.Documento")
    # behind the generator the XML is read once a payload; a filter right above would read it again in each of its terms
    d = payload.select("*", F.explode_outer(F.array(_tax_documents(text_col))).alias("_d")).where(found.isNull() | (F.size(found) == 0))
    reason = (F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit("empty"))
              .when(~T.html_unescape(text).contains("<Documento>"), F.lit("no documents")).otherwise(F.lit("unparsable")))
    return d.withColumn("REASON", reason).drop("_d")


def parse_tax_payload(payload: DataFrame, text_col: str = "payload") -> DataFrame:
    """SC17/PL15: escaped XML payload -> one row per tax document.

    Entities are unescaped (``&amp;`` last, ST15), lone ampersands repaired
    (ST14), the ``<Documento>`` elements parsed with ``from_xml`` against the
    declared schema and exploded; ``null`` text becomes null (ST17), amounts
    are safe doubles (CV1), the date accepts ``dd/MM/yyyy`` or ISO (DT4) and
    the id is ``type-folio`` ('' when a part is missing, ST6).  Rows whose
    date does not parse keep ``FECHA`` null; payloads without any document
    give no row here and are listed by :func:`rejected_tax_payloads` (Q14).
    """
    d = payload.select(_tax_documents(text_col).alias("d")).select(_exploded("d.Documento", "x")).where("_pos IS NOT NULL").select("x.*")
    n = lambda c: T.null_sentinel(F.col(c))
    return d.select(
        T.key_if_all(n("TipoDTE"), n("Folio")).alias("ID"),
        n("TipoDTE").alias("TIPO_DTE"), n("Folio").alias("FOLIO"),
        parse_day_first(n("FechEmis")).alias("FECHA_EMISION"),
        n("RUTReceptor").alias("RUT_RECEPTOR"), n("RazonSocialReceptor").alias("RAZON_SOCIAL"),
        C.safe_double(n("Neto")).alias("NETO"), C.safe_double(n("Exento")).alias("EXENTO"),
        C.safe_double(n("IVA")).alias("IVA"), C.safe_double(n("Total")).alias("TOTAL"),
        n("EstadoSII").alias("ESTADO_SII"), n("URL").alias("URL"))
