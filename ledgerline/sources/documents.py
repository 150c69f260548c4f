"""Semi-structured source documents (SC1-SC5, SC11, SC13-SC17).

Each source document has a declared read schema (the shape its query asks
for), so nothing is inferred: ``spark.read.schema(S).json(path)`` for landed
files, or ``from_json(text, S)`` for documents held in a text column.  The
transport that fetched them (HTTP, GraphQL, OData, SOAP) is not part of the
engine; its data side starts here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MONEY = "struct<shopMoney:struct<amount:string,currencyCode:string>>"

# B1: commerce order (one node of the orders connection)
COMMERCE_ORDER = (
    "id string, name string, email string, createdAt string, updatedAt string, processedAt string, "
    "displayFinancialStatus string, "
    f"subtotalPriceSet {_MONEY}, totalDiscountsSet {_MONEY}, totalPriceSet {_MONEY}, "
    f"currentSubtotalPriceSet {_MONEY}, currentTotalDiscountsSet {_MONEY}, currentTotalPriceSet {_MONEY}, "
    "customer struct<id:string,email:string,emailMarketingConsent:struct<marketingState:string,"
    "marketingOptInLevel:string,consentUpdatedAt:string>,tags:array<string>>, "
    "shippingAddress struct<firstName:string,lastName:string,company:string,address1:string,address2:string,"
    "city:string,province:string,provinceCode:string,country:string,countryCode:string,zip:string,"
    "phone:string,latitude:double,longitude:double>, "
    "lineItems struct<edges:array<struct<node:struct<id:string,name:string,quantity:int,sku:string,"
    f"originalUnitPriceSet:{_MONEY},discountedUnitPriceSet:{_MONEY}>>>>, "
    "shippingLines struct<edges:array<struct<node:struct<id:string,title:string,"
    f"discountedPriceSet:{_MONEY}>>>>"
)

# B2: commerce customer
COMMERCE_CUSTOMER = (
    "id string, email string, firstName string, lastName string, numberOfOrders bigint, "
    "amountSpent struct<amount:string,currencyCode:string>, createdAt string, updatedAt string, "
    "emailMarketingConsent struct<marketingState:string,marketingOptInLevel:string,consentUpdatedAt:string>, "
    "addresses array<struct<id:string,firstName:string,lastName:string,address1:string,address2:string,"
    "company:string,phone:string,city:string,province:string,country:string,zip:string,name:string,"
    "provinceCode:string,countryCode:string>>"
)

# B3: product with variants
COMMERCE_PRODUCT = (
    "id string, title string, bodyHtml string, vendor string, productType string, createdAt string, "
    "handle string, updatedAt string, publishedAt string, tags array<string>, status string, "
    "images struct<edges:array<struct<node:struct<id:string,altText:string,url:string>>>>, "
    "variants struct<edges:array<struct<node:struct<id:string,title:string,sku:string,price:string,"
    "compareAtPrice:string,inventoryItem:struct<id:string,inventoryLevels:struct<edges:array<struct<node:struct<"
    "location:struct<id:string,name:string>,quantities:array<struct<name:string,quantity:int>>>>>>>,"
    "inventoryPolicy:string,selectedOptions:array<struct<name:string,value:string>>,createdAt:string,"
    "updatedAt:string,taxable:boolean,barcode:string,weight:double,weightUnit:string,"
    "image:struct<id:string,altText:string,url:string>>>>>"
)

# B4: order-management (OMS) suborder
OMS_ORDER = (
    "id bigint, ecommerce_sale_id struct<id:bigint,shipment_address_id:struct<city_id:struct<name:string>,"
    "street:string,phone:string,state_id:struct<name:string>>>, "
    "amount_discount double, amount_tax double, amount_total double, amount_untaxed double, "
    "current_state_id struct<state_option_id:struct<name:string>>, date_order string, delivery_client_date string, "
    "delivery_method_id struct<name:string>, ecommerce_date_order string, ecommerce_name string, "
    "ecommerce_name_child string, partner_id struct<email:string,name:string,phone:string,street:string,vat:string>, "
    "payment_method_id struct<name:string>, warehouse_id struct<name:string>, "
    "transfer_warehouse_ids array<struct<product_id:struct<sku:string>,warehouse_name:string>>, "
    "order_line array<struct<id:bigint,discount:double,price_reduce:double,price_total:double,price_unit:double,"
    "product_uom_qty:double,product_id:struct<default_code:string,name:string>>>, "
    "status_histories_ids array<struct<status:string,create_date:string>>"
)

# B5: OMS incidence
OMS_INCIDENCE = (
    "ecommerce_name_child string, create_date string, "
    "history array<struct<create_date:string,name:string,description:string,state:string,user:string>>"
)

# B10: one tax document inside the SOAP payload
TAX_DOCUMENT = (
    "TipoDTE string, Folio string, FechEmis string, RUTReceptor string, RazonSocialReceptor string, "
    "Neto string, Exento string, IVA string, Total string, EstadoSII string, URL string"
)


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC1-SC5/SC11: landed JSON documents (one per line) with a declared
    schema; malformed records become nulls instead of failing the scan."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def parse_json(text: Column, schema: str) -> Column:
    """JS1: parse a JSON document held in a text column."""
    return F.from_json(text, schema)


def odata_rows(df: DataFrame, value_col: str = "value") -> DataFrame:
    """SC13-SC15: one row per element of an OData ``value`` array."""
    return df.select(F.inline(F.col(value_col)))


def in_pages(rows: DataFrame, keys: list[str], row: Column, order: list[str], size: int, name: str = "value") -> DataFrame:
    """SC11/SC13-SC15 the other way: (keys, page, ``name``): each group's rows as arrays of at most ``size``.

    The rows of a group are dealt to pages by their number in the group
    (:func:`~ledgerline.operators.dedupe.number_within`), so a page, and what a
    task gathers for it, has a bound however many rows share the keys.
    """
    from ..operators.dedupe import number_within
    numbered = number_within(rows.withColumn("_row", row).select(*keys, *order, "_row"), keys, order, "_number")
    page = F.floor((F.col("_number") - 1) / size).cast("int")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_number", "_row"))), lambda x: x["_row"])
    return numbered.groupBy(*keys, page.alias("page")).agg(listed.alias(name))
