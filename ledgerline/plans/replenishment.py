"""PL19: store replenishment -> transfer orders (SC20, JN9, JN10, JN18, FL12,
WN2, WN3, AG9, AG12, AG22, CD3, SE5, JS3, SK11-SK14, DT9).

The reference processes one replenishment per run with a Python loop per
store and per line; here every step is a DataFrame step over all
replenishments at once (numbering is per replenishment and store), and the
ERP's answers come back as a results table joined by key (SK11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.dedupe import number_within
from ..operators.lookup import exact_lookup
from ..operators.merge import export_csv_file, update_from
from ..session import shared_folder
from ..sources.tables import table

# Fixed values of the transfer documents (must equal the reference's).
INVENTORY_STATUS = "DISPONIBLE"
PRODUCT_STYLE = "GEN"
SHIPPING_WAREHOUSE = "CD"
SHIPPING_LOCATION = "GENERICA"
WMS_WAREHOUSE = "04"
# The owner / client identity of the outbound documents is deployment
# configuration (arguments of transfer_documents), not a library constant.
DEFAULT_OWNER = "OWNER"
DEFAULT_CLIENT_ID = ""
DEFAULT_CLIENT_NAME = ""
MISSING_ERROR = "Missing ERP data"

# Store -> delivery address (region, comuna, city, street).
STORE_DELIVERY_INFO = [
    ("BNAVENTURA", "RM", "Quilicura", "Santiago", "San Ignacio 500. Local 12-H"),
    ("MALLSPORT", "RM", "Las Condes", "Santiago", "Avda. Las Condes 13451. Local 225"),
    ("PTOVARAS", "X", "Puerto Varas", "Puerto Varas", "San José 192"),
    ("TEMUCO", "IX", "Temuco", "Temuco", "Avda. Alemania 0671. Local 3011"),
    ("ALERCE", "X", "Puerto Montt", "Puerto Montt", "local 127 - 128"),
    ("CONCEPCION", "VIII", "Concepción", "Concepción", "Avda. Jorge Alessandri 3177. Local f-114. f-116"),
    ("COYHAIQUE", "XI", "Coyhaique", "Coyhaique", "Calle Plaza 485"),
    ("LADEHESA", "RM", "Lo Barnechea", "Santiago", "Avda. La Dehesa 1445. Local 2074"),
    ("LASCONDES", "RM", "Las Condes", "Santiago", "Avda. Presidente Kennedy 9001. Local 3024"),
    ("OSORNO", "X", "Osorno", "Osorno", "Juan Mackenna 1069"),
    ("PUCON", "IX", "Pucón", "Pucón", "Fresia 248. Local C"),
    ("COSTANERA", "RM", "Providencia", "Santiago", "Avenida Andres Bello 2425. piso 4. local 4169"),
]

KEYS = ["REPLENISHMENT_ID", "STORE", "SKU"]

#: Columns of the enriched lines, in order, and where each comes from (None: made after the join).
ENRICHED = {"REPLENISHMENT_ID": "REPLENISHMENT_ID", "LINENUMBER": None, "ITEMNUMBER": "ITEMNUMBER", "ORDEREDINVENTORYSTATUSID": None,
            "PRODUCTCOLORID": "COLOR", "PRODUCTCONFIGURATIONID": "CONFIGURATION", "PRODUCTSIZEID": "SIZE", "PRODUCTSTYLEID": None,
            "SHIPPINGWAREHOUSEID": None, "SHIPPINGWAREHOUSELOCATIONID": None, "TRANSFERQUANTITY": "REPLENISHMENT", "STORE": "STORE",
            "SKU": "SKU", "TEAM": "TEAM", "CATEGORY": "CATEGORY", "PRODUCTNAME": "PRODUCTNAME", "DELIVERY": "DELIVERY",
            "IS_MISSING_ERP_DATA": None, "LINE_NO": None}


def store_info_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STORE_DELIVERY_INFO, "store string, region string, comuna string, "
                                                      "ciudad string, direccion string")


def enrich_lines(lines: DataFrame, products: DataFrame, replenishment_id: str | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """JN9/WN2/PR15/PR16/CD1: replenishment lines left-joined to the product
    master by SKU, numbered per (replenishment, store) by SKU, with the
    constant transfer columns and ``IS_MISSING_ERP_DATA``.  ``replenishment_id``
    restricts to one replenishment (SC20 raises when it has no lines).
    ``columns`` names the output columns wanted (all by default): numbering
    stores its rows, so Spark cannot leave out the others by itself."""
    if replenishment_id is not None:
        lines = lines.where(F.col("REPLENISHMENT_ID") == replenishment_id)
        if lines.isEmpty():
            raise ValueError(f"replenishment {replenishment_id} not found")
    prod = products.select("SKU", "ITEMNUMBER", "COLOR", "CONFIGURATION", "SIZE", "TEAM", "CATEGORY", "PRODUCTNAME")
    j = lines.join(prod, "SKU", "left")
    # LINENUMBER over all lines (WN2) and LINE_NO, the 1..n renumbering of
    # the lines with a product (WN3), in one numbering pass
    known, fixed = F.col("ITEMNUMBER").isNotNull(), {
        "ORDEREDINVENTORYSTATUSID": INVENTORY_STATUS, "PRODUCTSTYLEID": PRODUCT_STYLE,
        "SHIPPINGWAREHOUSEID": SHIPPING_WAREHOUSE, "SHIPPINGWAREHOUSELOCATIONID": SHIPPING_LOCATION}
    wanted = [c for c in ENRICHED if columns is None or c in columns]
    stored = [F.col(source).alias(c) for c, source in ENRICHED.items() if source and (c in wanted or c in KEYS)]
    j = number_within(j.select(*stored, known.alias("_known")), ["REPLENISHMENT_ID", "STORE"], ["SKU"], "LINENUMBER",
                      counters={"LINE_NO": F.col("_known")})
    made = {"IS_MISSING_ERP_DATA": ~F.col("_known")} | {c: F.lit(v) for c, v in fixed.items()}
    return j.select(*[made[c].alias(c) if c in made else F.col(c) for c in wanted])


def matched_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """JN9/CD1: the lines' keys, quantity and ``IS_MISSING_ERP_DATA``, for
    the steps that return no line number."""
    known = products.select("SKU", F.col("ITEMNUMBER").isNotNull().alias("_known"))
    return lines.join(known, "SKU", "left").select(
        *KEYS, F.col("REPLENISHMENT").alias("TRANSFERQUANTITY"), (~F.coalesce("_known", F.lit(False))).alias("IS_MISSING_ERP_DATA"))


def split_valid(enriched: DataFrame):
    """FL12/WN3: ``(valid, missing)``; the valid lines carry ``LINE_NO``,
    their 1..n renumbering per (replenishment, store) in line order, which
    :func:`enrich_lines` computed in its numbering pass."""
    valid = enriched.where(~F.col("IS_MISSING_ERP_DATA"))
    missing = enriched.where(F.col("IS_MISSING_ERP_DATA")).drop("LINE_NO")
    return valid, missing


def apply_results(lines: DataFrame, results: DataFrame) -> DataFrame:
    """SK11/SK13: write the ERP's answers back to the replenishment lines:
    ``ERP_TR_ID``, ``ERP_LINE_ID`` and ``WMS_SEND_STATUS`` set where the
    (replenishment, store, SKU) key matches; other lines keep their values."""
    # dealt out first: the check for repeated keys would else fill a table of all keys in the tasks that make the results
    ch = results.select(*KEYS, "ERP_TR_ID", "ERP_LINE_ID", "WMS_SEND_STATUS").repartition(*KEYS)
    return update_from(lines, ch, KEYS, ["ERP_TR_ID", "ERP_LINE_ID", "WMS_SEND_STATUS"])


def failures(missing: DataFrame, results: DataFrame, valid: DataFrame) -> DataFrame:
    """SE5: missing-product lines (no transfer, no line number) unioned with
    the lines the ERP refused (with their transfer and line number)."""
    m = missing.select("REPLENISHMENT_ID", "STORE", "SKU", F.col("TRANSFERQUANTITY").alias("QUANTITY"),
                       F.lit(MISSING_ERROR).alias("ERROR"))
    failed = results.where(F.col("ERROR").isNotNull()).join(valid.select(*KEYS, "TRANSFERQUANTITY", "LINE_NO"), KEYS)
    f = failed.select("REPLENISHMENT_ID", "STORE", "SKU", F.col("TRANSFERQUANTITY").alias("QUANTITY"), "ERROR",
                      F.coalesce("ERP_TR_ID", F.lit("N/A")).alias("TR_NUMBER"), F.col("LINE_NO").alias("LINE_NUMBER"))
    return m.unionByName(f, allowMissingColumns=True)


def outcome(lines: DataFrame, results: DataFrame) -> DataFrame:
    """AG22/CD3: per replenishment: attempted, successful, refused, missing,
    total failed, and the outcome: ``failed`` when nothing succeeded,
    ``partial`` when something failed, else ``ok``.

    ``lines`` carry their key and ``IS_MISSING_ERP_DATA``.  Lines and answers are
    counted together per key, in counters of fixed size, instead of being sorted
    for a join: each valid line has all answers of its key.  Answers for keys without
    a valid line do not count, and a key with a null part has no answer."""
    valid, none, error = ~F.col("IS_MISSING_ERP_DATA"), F.lit(0), F.col("ERROR")
    one = lambda c: F.when(c, 1).otherwise(0)
    # packed, and not combined before the shuffle: nearly every key has one line and one answer
    kinds = lines.select(*KEYS, (one(valid) + 2 * one(~valid)).alias("_kind"), F.lit(1).alias("_line")).unionByName(
        results.select(*KEYS, (4 * one(error.isNull()) + 8 * one(error.isNotNull())).alias("_kind"), F.lit(0).alias("_line")))
    per_key = kinds.repartition(*KEYS).groupBy(*KEYS).agg(F.sum("_line").alias("_lines"), *[F.count_if(F.col("_kind") == k).alias(c) for k, c in ((1, "_valid"), (2, "_missing"), (4, "_ok"), (8, "_bad"))])
    whole = F.lit(True)
    for k in KEYS:
        whole = whole & F.col(k).isNotNull()
    answered = lambda c: F.sum(F.when(whole, F.col("_valid") * F.col(c)).otherwise(none)).cast("bigint")
    t = per_key.where("_lines > 0").groupBy("REPLENISHMENT_ID").agg(
        F.sum("_valid").alias("attempted"), answered("_ok").alias("successful"), answered("_bad").alias("api_failed"),
        F.sum("_missing").alias("missing"))
    t = t.withColumn("total_failed", F.col("api_failed") + F.col("missing"))
    return t.withColumn("outcome", F.when(F.col("successful") == 0, F.lit("failed"))
                        .when(F.col("total_failed") > 0, F.lit("partial")).otherwise(F.lit("ok")))


def transfer_summary(lines: DataFrame) -> DataFrame:
    """AG9/DT9: per transfer and store: line count, units, WMS status."""
    # first per status, in counters of fixed size: a greatest text among all lines would have them sorted
    per_status = (lines.where(F.col("ERP_TR_ID").isNotNull())
                  .groupBy("ERP_TR_ID", "STORE", "WMS_SEND_STATUS").agg(F.count(F.lit(1)).alias("_lines"), F.sum("REPLENISHMENT").alias("_units")))
    return per_status.groupBy("ERP_TR_ID", "STORE").agg(F.sum("_lines").alias("LINE_COUNT"), F.sum("_units").cast("bigint").alias("TOTAL_UNITS"),
                                                        F.max("WMS_SEND_STATUS").alias("WMS_STATUS"))


def transfer_documents(valid: DataFrame, results: DataFrame, fecha: str,
                       store_info: DataFrame | None = None, owner: str = DEFAULT_OWNER,
                       client_id: str = DEFAULT_CLIENT_ID, client_name: str = DEFAULT_CLIENT_NAME) -> DataFrame:
    """AG12/JN18/JS3/AR5: one outbound-document XML per transfer with the lines
    the ERP accepted (``SKU``, line number, integer quantity) and the store's
    delivery address (default '' when the store is unknown).  Text is
    XML-escaped (the reference writes it raw)."""
    spark = valid.sparkSession
    store_info = store_info if store_info is not None else store_info_table(spark)
    ok = valid.join(results.where(F.col("ERROR").isNull()).select(*KEYS, "ERP_TR_ID"), KEYS)
    det = F.struct(F.col("LINE_NO").alias("_o"), F.col("SKU").alias("IdArticulo"), F.col("LINE_NO").alias("NroLinea"),
                   F.lit("").alias("NroLote"), F.col("TRANSFERQUANTITY").cast("int").alias("Cantidad"))
    g = ok.groupBy("ERP_TR_ID", "STORE").agg(F.array_sort(F.collect_list(det)).alias("d"))
    g = exact_lookup(g, F.col("STORE"), store_info, "store", ["region", "comuna", "ciudad", "direccion"],
                     default={"region": "", "comuna": "", "ciudad": "", "direccion": ""})
    doc = F.struct(
        F.lit(WMS_WAREHOUSE).alias("IdAlmacen"), F.lit(owner).alias("IdOwner"), F.col("ERP_TR_ID").alias("IdDocSalida"),
        F.col("ERP_TR_ID").alias("NroReferencia"), F.lit("TRF").alias("Tipo"), F.lit(fecha).alias("FechaEmision"),
        F.lit(fecha).alias("FechaCompromiso"), F.lit(fecha).alias("FechaExpiracion"),
        F.lit(WMS_WAREHOUSE).alias("IdAlmacenDestino"), F.lit(client_id).alias("IdCliente"),
        F.lit(client_id).alias("CodCliente"), F.lit(client_name).alias("NomCliente"),
        F.col("direccion").alias("DireccionDespacho"), F.col("comuna").alias("ComunaDespacho"),
        F.col("ciudad").alias("CiudadDespacho"), F.col("region").alias("LocalidadDespacho"),
        F.lit("CHL").alias("PaisDespacho"), F.lit(0).alias("Prioridad"),
        T.address_text(F.col("direccion"), F.col("ciudad")).alias("Observaciones"),
        F.col("STORE").alias("IdSucursal"), F.lit("NOR").alias("CobroTransporte"), F.lit("C").alias("EstadoInterfaz"),
        F.struct(F.transform("d", lambda x: x.dropFields("_o")).alias("DetalleSalida")).alias("Detalles"))
    xml = F.concat(F.lit('<soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/"><soap:Body>'
                         '<RegistrarDocumentoSalida>'),
                   F.to_xml(doc, {"rowTag": "documento"}),
                   F.lit("</RegistrarDocumentoSalida></soap:Body></soap:Envelope>"))
    return g.select("ERP_TR_ID", "STORE", xml.alias("document"))


def export_rows(lines: DataFrame, products: DataFrame) -> DataFrame:
    """SK14/JN10: rows of the results CSV: lines inner-joined to products,
    numbered per store by SKU, sorted by store and line number."""
    j = lines.join(products.select("SKU", "ITEMNUMBER", "PRODUCTNAME"), "SKU", "inner")
    j = number_within(j, ["REPLENISHMENT_ID", "STORE"], ["SKU"], "LINENUMBER")
    return j.orderBy("STORE", "LINENUMBER")


# ------------------------------------------------------- test-table inputs
def _inputs(spark, sf):
    li, p, s = table(spark, sf, "lineitem"), table(spark, sf, "part"), table(spark, sf, "supplier")
    lines = (li.groupBy("l_returnflag", "l_suppkey", "l_partkey")
             .agg(F.sum("l_quantity").cast("int").alias("REPLENISHMENT"),
                  F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("DELIVERY"))
             .select(F.concat(F.lit("RPL-"), F.col("l_returnflag")).alias("REPLENISHMENT_ID"),
                     F.concat(F.lit("ST"), F.col("l_suppkey").cast("string")).alias("STORE"),
                     F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("SKU"),
                     "REPLENISHMENT", "DELIVERY")
             .withColumn("ERP_TR_ID", F.lit(None).cast("string")).withColumn("ERP_LINE_ID", F.lit(None).cast("string"))
             .withColumn("WMS_SEND_STATUS", F.lit(None).cast("string")))
    products = p.where(F.col("p_size") > 5).select(
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("SKU"),
        F.concat(F.lit("IT"), F.col("p_partkey").cast("string")).alias("ITEMNUMBER"),
        F.col("p_brand").alias("COLOR"), F.col("p_type").alias("CONFIGURATION"), F.col("p_size").cast("string").alias("SIZE"),
        F.lit("TEAM").alias("TEAM"), F.col("p_type").alias("CATEGORY"), F.col("p_name").alias("PRODUCTNAME"))
    store_info = s.select(F.concat(F.lit("ST"), F.col("s_suppkey").cast("string")).alias("store"),
                          F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("region"),
                          F.col("s_name").alias("comuna"),
                          F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("City "), F.col("s_nationkey").cast("string")))
                           .otherwise(F.lit("")).alias("ciudad"),
                          F.when(F.col("s_acctbal") > 0, F.concat(F.lit("Street & "), F.col("s_suppkey").cast("string")))
                           .otherwise(F.lit("")).alias("direccion"))
    return lines, products, store_info


def _results(enriched):
    """The ERP's answers for the lines with a product: refused when the
    quantity is large; the transfer id is per replenishment and store."""
    ok = enriched.where(~F.col("IS_MISSING_ERP_DATA"))
    return ok.select(*KEYS,
                     F.concat(F.lit("TR-"), F.col("REPLENISHMENT_ID"), F.lit("-"), F.col("STORE")).alias("ERP_TR_ID"),
                     F.when(F.col("TRANSFERQUANTITY") <= 150, F.concat(F.col("SKU"), F.lit("-L"))).alias("ERP_LINE_ID"),
                     F.when(F.col("TRANSFERQUANTITY") > 150, F.lit("API error")).alias("ERROR"),
                     F.lit("sent").alias("WMS_SEND_STATUS"))


def _numbered(spark, sf, *columns):
    """Numbered lines (materialised where they are numbered) with their keys, quantity,
    flag and number and the other ``columns``, split into valid and missing, and the answers for them."""
    lines, products, store_info = _inputs(spark, sf)
    enriched = enrich_lines(lines, products, columns=[*KEYS, "TRANSFERQUANTITY", "IS_MISSING_ERP_DATA", "LINE_NO", *columns])
    valid, missing = split_valid(enriched)
    return store_info, valid, missing, _results(enriched)


def replenish_summary(spark, sf):
    """PL19/AG22/CD3: per replenishment attempted / successful / refused /
    missing counts and the outcome class."""
    lines, products, _ = _inputs(spark, sf)
    matched = matched_lines(lines, products)
    return outcome(matched, _results(matched))


def replenish_transfers(spark, sf):
    """SK11/AG9: answers applied to the lines, summarised per transfer."""
    lines, products, _ = _inputs(spark, sf)
    return transfer_summary(apply_results(lines, _results(matched_lines(lines, products))))


def replenish_lines(spark, sf):
    """JN9/WN2/WN3/FL12: enriched lines with their store numbering, the
    missing flag and the renumbering of the valid ones."""
    _, valid, missing, _ = _numbered(spark, sf, "LINENUMBER", "ITEMNUMBER")
    return valid.unionByName(missing, allowMissingColumns=True).select(
        "REPLENISHMENT_ID", "STORE", "SKU", "LINENUMBER", "LINE_NO", "IS_MISSING_ERP_DATA", "ITEMNUMBER",
        "TRANSFERQUANTITY")


def replenish_failures(spark, sf):
    """SE5: missing-product lines and refused lines in one list."""
    _, valid, missing, res = _numbered(spark, sf)
    return failures(missing, res, valid)


def replenish_export(spark, sf):
    """SK14/JN10/WN2: rows of the results CSV (lines inner-joined to the
    product master, numbered per replenishment and store by SKU, sorted);
    ``export_csv`` writes them ``;``-separated with a header."""
    lines, products, _ = _inputs(spark, sf)
    return export_rows(lines, products).select("REPLENISHMENT_ID", "STORE", "LINENUMBER", "SKU", "ITEMNUMBER",
                                               "PRODUCTNAME", F.col("REPLENISHMENT").alias("TRANSFERQUANTITY"))


def replenish_csv(spark, sf):
    """SK14: the results CSV as one file in order, and its lines read back (the mark at its start taken off)."""
    path = f"{shared_folder(spark, 'export')}/replenishment.csv"
    export_csv_file(replenish_export(spark, sf), path, ["REPLENISHMENT_ID", "STORE", "LINENUMBER"])
    return spark.read.text(path).select(F.regexp_replace("value", "^\\x{FEFF}", "").alias("line"))


def replenish_one(spark, sf):
    """SC20: the lines of one replenishment, which must have some."""
    lines, products, _ = _inputs(spark, sf)
    wanted = ["REPLENISHMENT_ID", "STORE", "SKU", "LINENUMBER", "ITEMNUMBER"]
    return enrich_lines(lines, products, "RPL-N", wanted).select("REPLENISHMENT_ID", "STORE", "SKU", "LINENUMBER", "ITEMNUMBER")


def transfer_documents_q(spark, sf):
    """AG12/JS3/JN18: transfer documents; the XML is parsed back and its
    detail count, unit total and observations are returned."""
    store_info, valid, _, res = _numbered(spark, sf)
    docs = transfer_documents(valid, res, "2001-08-01", store_info)
    schema = ("IdDocSalida string, IdSucursal string, Observaciones string, "
              "Detalles struct<DetalleSalida:array<struct<IdArticulo:string,NroLinea:int,Cantidad:int>>>")
    parsed = F.from_xml(F.regexp_extract("document", r"(?s)(<documento>.*</documento>)", 1), schema,
                        {"ignoreSurroundingSpaces": "false"})
    d = docs.select("ERP_TR_ID", "STORE", parsed.alias("x"))
    det = F.col("x.Detalles.DetalleSalida")
    return d.select("ERP_TR_ID", "STORE", F.col("x.IdDocSalida").alias("doc_id"),
                    F.coalesce(F.col("x.Observaciones"), F.lit("")).alias("observaciones"),
                    F.size(det).alias("n_details"),
                    F.aggregate(det, F.lit(0).cast("bigint"), lambda a, x: a + x["Cantidad"]).alias("total_units"),
                    F.array_max(F.transform(det, lambda x: x["NroLinea"])).alias("max_line"))


_R_INPUTS = """
  lines AS (SELECT 'RPL-' || l_returnflag AS rid, 'ST' || CAST(l_suppkey AS VARCHAR) AS store,
                   'SKU' || CAST(l_partkey AS VARCHAR) AS sku, CAST(SUM(l_quantity) AS INTEGER) AS qty
            FROM lineitem GROUP BY 1, 2, 3),
  prod AS (SELECT 'SKU' || CAST(p_partkey AS VARCHAR) AS sku, 'IT' || CAST(p_partkey AS VARCHAR) AS item FROM part
           WHERE p_size > 5),
  enr AS (SELECT l.*, p.item, CAST(ROW_NUMBER() OVER (PARTITION BY l.rid, l.store ORDER BY l.sku) AS INTEGER) AS ln
          FROM lines l LEFT JOIN prod p ON l.sku = p.sku),
  valid AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY rid, store ORDER BY ln) AS INTEGER) AS line_no
            FROM enr WHERE item IS NOT NULL),
  missing AS (SELECT * FROM enr WHERE item IS NULL),
  res AS (SELECT rid, store, sku, 'TR-' || rid || '-' || store AS tr,
                 CASE WHEN qty <= 150 THEN sku || '-L' END AS line_id,
                 CASE WHEN qty > 150 THEN 'API error' END AS err
          FROM lines WHERE sku IN (SELECT sku FROM prod))
"""

ORACLE = {
    "q_replenish_csv": "WITH " + _R_INPUTS + """,
        x AS (SELECT l.rid, l.store, ROW_NUMBER() OVER (PARTITION BY l.rid, l.store ORDER BY l.sku) AS ln, l.sku, p.item, pp.p_name, l.qty
              FROM lines l JOIN prod p ON l.sku = p.sku JOIN part pp ON 'SKU' || CAST(pp.p_partkey AS VARCHAR) = l.sku)
        SELECT 'REPLENISHMENT_ID;STORE;LINENUMBER;SKU;ITEMNUMBER;PRODUCTNAME;TRANSFERQUANTITY' AS line
        UNION ALL SELECT CONCAT_WS(';', rid, store, ln, sku, item, p_name, qty) FROM x""",
    "q_replenish_one": "WITH " + _R_INPUTS + """
        SELECT rid AS REPLENISHMENT_ID, store AS STORE, sku AS SKU, ln AS LINENUMBER, item AS ITEMNUMBER FROM enr WHERE rid = 'RPL-N'""",
    "q_replenish_export": "WITH " + _R_INPUTS + """
        SELECT l.rid AS REPLENISHMENT_ID, l.store AS STORE,
               CAST(ROW_NUMBER() OVER (PARTITION BY l.rid, l.store ORDER BY l.sku) AS INTEGER) AS LINENUMBER,
               l.sku AS SKU, p.item AS ITEMNUMBER, pp.p_name AS PRODUCTNAME, l.qty AS TRANSFERQUANTITY
        FROM lines l JOIN prod p ON l.sku = p.sku
             JOIN part pp ON 'SKU' || CAST(pp.p_partkey AS VARCHAR) = l.sku""",
    "q_replenish_summary": "WITH " + _R_INPUTS + """,
        att AS (SELECT rid, COUNT(*) AS attempted FROM valid GROUP BY rid),
        r AS (SELECT rid, COUNT(*) FILTER (WHERE err IS NULL) AS successful,
                     COUNT(*) FILTER (WHERE err IS NOT NULL) AS api_failed FROM res GROUP BY rid),
        m AS (SELECT rid, COUNT(*) AS missing FROM missing GROUP BY rid),
        ids AS (SELECT rid FROM att UNION SELECT rid FROM m),
        t AS (SELECT ids.rid AS REPLENISHMENT_ID, COALESCE(attempted, 0) AS attempted, COALESCE(successful, 0) AS successful,
                     COALESCE(api_failed, 0) AS api_failed, COALESCE(missing, 0) AS missing
              FROM ids LEFT JOIN att ON ids.rid = att.rid LEFT JOIN r ON ids.rid = r.rid LEFT JOIN m ON ids.rid = m.rid)
        SELECT *, api_failed + missing AS total_failed,
               CASE WHEN successful = 0 THEN 'failed' WHEN api_failed + missing > 0 THEN 'partial' ELSE 'ok' END AS outcome
        FROM t""",
    "q_replenish_transfers": "WITH " + _R_INPUTS + """
        SELECT res.tr AS ERP_TR_ID, lines.store AS STORE, COUNT(*) AS LINE_COUNT, CAST(SUM(lines.qty) AS BIGINT) AS TOTAL_UNITS,
               'sent' AS WMS_STATUS
        FROM lines JOIN res ON lines.rid = res.rid AND lines.store = res.store AND lines.sku = res.sku
        GROUP BY 1, 2""",
    "q_replenish_lines": "WITH " + _R_INPUTS + """
        SELECT rid AS REPLENISHMENT_ID, store AS STORE, sku AS SKU, ln AS LINENUMBER,
               CASE WHEN item IS NOT NULL THEN CAST(COUNT(item) OVER (PARTITION BY rid, store ORDER BY ln) AS INTEGER) END AS LINE_NO,
               item IS NULL AS IS_MISSING_ERP_DATA, item AS ITEMNUMBER, qty AS TRANSFERQUANTITY
        FROM enr""",
    "q_replenish_failures": "WITH " + _R_INPUTS + """
        SELECT rid AS REPLENISHMENT_ID, store AS STORE, sku AS SKU, qty AS QUANTITY, 'Missing ERP data' AS ERROR,
               CAST(NULL AS VARCHAR) AS TR_NUMBER, CAST(NULL AS INTEGER) AS LINE_NUMBER FROM missing
        UNION ALL
        SELECT v.rid, v.store, v.sku, v.qty, r.err, r.tr, v.line_no
        FROM res r JOIN valid v ON r.rid = v.rid AND r.store = v.store AND r.sku = v.sku WHERE r.err IS NOT NULL""",
    "q_transfer_documents": "WITH " + _R_INPUTS + """,
        si AS (SELECT 'ST' || CAST(s_suppkey AS VARCHAR) AS store,
                      CASE WHEN s_acctbal > 5000 THEN 'City ' || CAST(s_nationkey AS VARCHAR) ELSE '' END AS ciudad,
                      CASE WHEN s_acctbal > 0 THEN 'Street & ' || CAST(s_suppkey AS VARCHAR) ELSE '' END AS direccion
               FROM supplier)
        SELECT r.tr AS ERP_TR_ID, v.store AS STORE, r.tr AS doc_id,
               CASE WHEN COALESCE(si.direccion, '') != '' OR COALESCE(si.ciudad, '') != ''
                    THEN COALESCE(si.direccion, '') || ', ' || COALESCE(si.ciudad, '') ELSE '' END AS observaciones,
               CAST(COUNT(*) AS INTEGER) AS n_details, CAST(SUM(v.qty) AS BIGINT) AS total_units,
               CAST(MAX(v.line_no) AS INTEGER) AS max_line
        FROM res r JOIN valid v ON r.rid = v.rid AND r.store = v.store AND r.sku = v.sku
             LEFT JOIN si ON v.store = si.store
        WHERE r.err IS NULL
        GROUP BY r.tr, v.store, si.direccion, si.ciudad""",
}

QUERIES = {
    "q_replenish_csv": replenish_csv,
    "q_replenish_one": replenish_one,
    "q_replenish_export": replenish_export,
    "q_replenish_summary": replenish_summary,
    "q_replenish_transfers": replenish_transfers,
    "q_replenish_lines": replenish_lines,
    "q_replenish_failures": replenish_failures,
    "q_transfer_documents": transfer_documents_q,
}
