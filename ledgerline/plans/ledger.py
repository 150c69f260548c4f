"""PL18: freight-footprint ledger (transfers from the distribution centre and
wholesale orders) plus its lookups and unions (JN6, JN11, JN15-JN17, AG4,
AG5, AG19, MA1, SE1-SE5, PR15, FL3, FL5, FL6, FL10).

The lookups run against small reference tables (the fixed distance table has
~180 rows, a proven bound) and resolve each distinct destination once; the
shipment side stays distributed throughout.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators.dedupe import not_in
from ..operators.lookup import cascading_lookup, exact_lookup
from ..session import ensure_checkpoint_dir
from ..sources.tables import table
from . import footprint_tables as FT

LEDGER_COLUMNS = ["ORIGIN_NAME", "ORIGIN_ZIP_CODE", "CHANNEL", "DESTINATION_ZIP_CODE", "DESTINATION_ADDRESS",
                  "MODE", "DISTANCE_KM", "WEIGHT_KG", "EMISSIONS_FACTOR", "IS_ELECTRIC", "FECHA", "REFERENCE_NUMBER"]


def distance_table(spark: SparkSession) -> DataFrame:
    """The fixed distance table as ``(city, zip, km, ordinal)``; a repeated
    city keeps its first position (Q9)."""
    seen, rows = set(), []
    for i, (city, zip_code, km) in enumerate(FT.DISTANCE_TABLE):
        if city not in seen:
            seen.add(city)
            rows.append((city, zip_code, float(km), i))
    return spark.createDataFrame(rows, "city string, zip string, km double, ordinal int")


def warehouse_table(spark: SparkSession) -> DataFrame:
    """The fixed receiving-warehouse -> city map as ``(warehouse_id, city)``."""
    return spark.createDataFrame(FT.WAREHOUSE_TO_CITY, "warehouse_id string, city string")


def _end_of_day(d) -> F.Column:
    d = d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)[:10])
    return F.lit(f"{d.isoformat()} 23:59:59").cast("timestamp_ntz")


def destination_city(df: DataFrame, distances: DataFrame, warehouses: DataFrame,
                     warehouse_col="RECEIVING_WAREHOUSE_ID", city_col="RECEIVING_ADDRESS_CITY",
                     district_col="RECEIVING_ADDRESS_DISTRICT_NAME") -> DataFrame:
    """JN15/JN17: destination by cascading source choice: warehouse map
    (upper-cased id) -> district if it is a table city -> city if it is a
    table city -> raw city -> raw district -> ``Unknown``; adds ``DEST``."""
    df = exact_lookup(df, F.upper(F.col(warehouse_col)), warehouses, "warehouse_id", ["city"]).withColumnRenamed("city", "_wh_city")
    names = distances.select(F.col("city").alias("_name")).distinct()
    d = df.join(names.withColumnRenamed("_name", "_dist_hit"),
                F.trim(F.col(district_col)) == F.col("_dist_hit"), "left")
    d = d.join(names.withColumnRenamed("_name", "_city_hit"), F.trim(F.col(city_col)) == F.col("_city_hit"), "left")
    dest = F.coalesce("_wh_city", "_dist_hit", "_city_hit", F.nullif(F.col(city_col), F.lit("")),
                      F.nullif(F.col(district_col), F.lit("")), F.lit(FT.UNKNOWN_CITY))
    return d.withColumn("DEST", dest).drop("_wh_city", "_dist_hit", "_city_hit")


def transfer_quantities(headers: DataFrame, lines: DataFrame, start, end) -> DataFrame:
    """AG4/JN6/JN11/FL3/FL5/FL6: headers shipped from the distribution centre
    in ``[start, end 23:59:59]`` with their summed line quantity (move item
    excluded; transfers containing it dropped with ``NOT IN``; ``HAVING
    SUM > 0``), inner-joined so headers without lines drop out."""
    h = headers.where((F.col("SHIPPING_WAREHOUSE_ID") == FT.SHIPPING_WAREHOUSE)
                      & (F.col("REQUESTED_SHIPPING_DATE") >= F.lit(str(start)[:10]).cast("timestamp_ntz"))
                      & (F.col("REQUESTED_SHIPPING_DATE") <= _end_of_day(end)))
    moves = lines.where(F.upper("ITEM_NUMBER") == FT.MOVE_ITEM).select("TRANSFER_ORDER_NUMBER").distinct()
    l = lines.join(h.select("TRANSFER_ORDER_NUMBER"), "TRANSFER_ORDER_NUMBER", "left_semi") \
        .where(F.upper("ITEM_NUMBER") != FT.MOVE_ITEM)
    l = not_in(l, "TRANSFER_ORDER_NUMBER", moves, "TRANSFER_ORDER_NUMBER")
    sums = l.groupBy("TRANSFER_ORDER_NUMBER").agg(F.sum("TRANSFER_QUANTITY").alias("TOTAL_QUANTITY")) \
        .where(F.col("TOTAL_QUANTITY") > 0)
    return h.join(sums, "TRANSFER_ORDER_NUMBER", "inner")


def wholesale_quantities(sales: DataFrame, start, end) -> DataFrame:
    """AG4/AG5/FL10/JN6: wholesale orders of the period: quantity total and
    first day per order number; orders holding the move item are excluded
    (the subquery drops nulls, so a plain anti join is exact)."""
    day = F.to_date("CREATEDTRANSACTIONDATE2")
    ws = F.col("CANAL") == FT.WHOLESALE_CHANNEL_VALUE
    pon = F.col("PURCHORDERFORMNUM")
    w = sales.where(ws & day.between(F.lit(str(start)[:10]).cast("date"), F.lit(str(end)[:10]).cast("date"))
                    & (F.col("QTY") > 0) & pon.isNotNull() & (F.trim(pon) != "")
                    & (F.upper("ITEMID") != FT.MOVE_ITEM))
    moved = sales.where(ws & (F.upper("ITEMID") == FT.MOVE_ITEM) & pon.isNotNull()).select("PURCHORDERFORMNUM").distinct()
    w = w.join(moved, "PURCHORDERFORMNUM", "left_anti")
    return (w.groupBy("PURCHORDERFORMNUM").agg(F.sum("QTY").alias("TOTAL_QUANTITY"), F.min(day).alias("ORDER_DATE"))
            .where(F.col("TOTAL_QUANTITY") > 0))


def freight_ledger(headers: DataFrame, lines: DataFrame, sales: DataFrame, start, end,
                   distances: DataFrame | None = None, warehouses: DataFrame | None = None,
                   emissions_factor: str = FT.DEFAULT_EMISSIONS_FACTOR,
                   weight_kg: str = FT.AVERAGE_PRODUCT_WEIGHT_KG,
                   wholesale_destination: str = FT.WHOLESALE_DESTINATION) -> DataFrame:
    """PL18: one ledger row per transfer (channel Retail) and per wholesale
    order (channel Wholesale, fixed destination), aligned and unioned (SE4);
    destination by :func:`destination_city`, zip and distance by the
    cascading lookup (JN16); weight = quantity x average weight and all
    decimals HALF_UP (MA1).  Keyed by ``REFERENCE_NUMBER``."""
    spark = headers.sparkSession
    distances = distance_table(spark) if distances is None else distances
    warehouses = warehouse_table(spark) if warehouses is None else warehouses
    t = destination_city(transfer_quantities(headers, lines, start, end), distances, warehouses)
    tr = t.select(F.lit("Retail").alias("CHANNEL"), F.col("TRANSFER_ORDER_NUMBER").alias("REFERENCE_NUMBER"),
                  "DEST", F.col("TOTAL_QUANTITY").cast("double").alias("TOTAL_QUANTITY"),
                  F.to_date("REQUESTED_SHIPPING_DATE").alias("FECHA"))
    wh = wholesale_quantities(sales, start, end).select(
        F.lit("Wholesale").alias("CHANNEL"), F.col("PURCHORDERFORMNUM").alias("REFERENCE_NUMBER"),
        F.lit(wholesale_destination).alias("DEST"), F.col("TOTAL_QUANTITY").cast("double").alias("TOTAL_QUANTITY"),
        F.col("ORDER_DATE").alias("FECHA"))
    # one row per shipment; materialised once because the lookup reads it
    # twice (its distinct destinations, then the join back)
    ensure_checkpoint_dir(spark)
    recs = tr.unionByName(wh).checkpoint(eager=True)
    recs = cascading_lookup(recs, "DEST", distances, "city", ["zip", "km"], "ordinal",
                            {"zip": FT.DEFAULT_ZIP, "km": FT.DEFAULT_KM})
    return recs.select(
        F.lit(FT.ORIGIN_NAME).alias("ORIGIN_NAME"), F.lit(FT.ORIGIN_ZIP_CODE).alias("ORIGIN_ZIP_CODE"), "CHANNEL",
        F.col("match_zip").alias("DESTINATION_ZIP_CODE"),
        F.coalesce(F.left("DEST", F.lit(500)), F.lit("")).alias("DESTINATION_ADDRESS"),
        F.lit(FT.MODE).alias("MODE"),
        F.round(F.col("match_km").cast("decimal(38,18)"), 2).cast("double").alias("DISTANCE_KM"),
        A.decimal_product(F.coalesce("TOTAL_QUANTITY", F.lit(0.0)), F.lit(weight_kg), 2).cast("double").alias("WEIGHT_KG"),
        F.round(F.lit(emissions_factor).cast("decimal(18,8)"), 6).cast("double").alias("EMISSIONS_FACTOR"),
        F.lit(FT.IS_ELECTRIC).alias("IS_ELECTRIC"), F.date_format("FECHA", "yyyy-MM-dd").alias("FECHA"),
        "REFERENCE_NUMBER")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """AG19: grand totals of a ledger: records per channel, distance and weight."""
    return ledger.agg(F.count(F.lit(1)).alias("n_records"),
                      F.count_if(F.col("CHANNEL") == "Retail").alias("n_transfers"),
                      F.count_if(F.col("CHANNEL") == "Wholesale").alias("n_wholesale"),
                      F.round(F.sum("DISTANCE_KM"), 2).alias("total_distance_km"),
                      F.round(F.sum("WEIGHT_KG"), 2).alias("total_weight_kg"))


# ------------------------------------------------------- test-table inputs
def _ledger_inputs(spark, sf):
    """Transfer headers / lines, sales lines and lookup tables in the
    ledger's input schemas, from orders, lineitem, customer, nation, region."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    hdr = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
           .join(r, n.n_regionkey == r.r_regionkey))
    pr = F.col("o_orderpriority")
    headers = hdr.select(
        F.concat(F.lit("TR"), F.col("o_orderkey").cast("string")).alias("TRANSFER_ORDER_NUMBER"),
        F.when(pr == "5-LOW", F.lit("WH2")).otherwise(F.lit("CD")).alias("SHIPPING_WAREHOUSE_ID"),
        F.when(F.col("o_orderstatus") == "F", F.lower("r_name"))
         .otherwise(F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))).alias("RECEIVING_WAREHOUSE_ID"),
        F.when(pr == "3-MEDIUM", F.lower("n_name")).when(pr == "4-NOT SPECIFIED", F.lit(""))
         .otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))).alias("RECEIVING_ADDRESS_CITY"),
        F.when(pr == "2-HIGH", F.col("n_name")).otherwise(F.lit("District 9")).alias("RECEIVING_ADDRESS_DISTRICT_NAME"),
        F.col("o_orderdate").alias("REQUESTED_SHIPPING_DATE"))
    moved = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    lines = li.select(F.concat(F.lit("TR"), F.col("l_orderkey").cast("string")).alias("TRANSFER_ORDER_NUMBER"),
                      F.when(moved, F.lit("traslado")).otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
                      .alias("ITEM_NUMBER"), F.col("l_quantity").cast("bigint").alias("TRANSFER_QUANTITY"))
    s = li.join(o, li.l_orderkey == o.o_orderkey)
    sales = s.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("WholeSale")).otherwise(F.lit("Retail")).alias("CANAL"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" "))
         .otherwise(F.concat(F.lit("W"), F.col("o_orderkey").cast("string"))).alias("PURCHORDERFORMNUM"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("Traslado"))
         .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("ITEMID"),
        F.col("l_quantity").alias("QTY"), F.col("l_shipdate").alias("CREATEDTRANSACTIONDATE2"))
    distances = n.select(F.col("n_name").alias("city"), F.lpad(F.col("n_nationkey").cast("string"), 7, "0").alias("zip"),
                         (F.col("n_regionkey") * 100 + F.col("n_nationkey") + 0.125).alias("km"),
                         F.col("n_nationkey").alias("ordinal"))
    warehouses = r.select(F.col("r_name").alias("warehouse_id"),
                          F.concat(F.lit("NATION_"), (F.col("r_regionkey") + 5).cast("string")).alias("city"))
    return headers, lines, sales, distances, warehouses


def ledger_union(spark, sf):
    """PL18/SE4/AG5/PR15/JN15-JN17/MA1: the whole ledger for 1998."""
    headers, lines, sales, distances, warehouses = _ledger_inputs(spark, sf)
    return freight_ledger(headers, lines, sales, "1998-01-01", "1998-12-31", distances, warehouses,
                          wholesale_destination="NATION_9")


def ledger_totals(spark, sf):
    """AG19: grand totals of the same ledger."""
    return ledger_summary(ledger_union(spark, sf))


def cascading_lookup_q(spark, sf):
    """JN16/ST18: exact -> case-fold -> containment either way (first in
    table order) -> default, for text values against a name table; blank
    values get the default."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    seg = F.col("c_mktsegment")
    v = (F.when(F.col("c_acctbal") < 0, F.lit("  "))
         .when(seg == "BUILDING", F.col("n_name")).when(seg == "MACHINERY", F.lower("n_name"))
         .when(seg == "FURNITURE", F.concat(F.lit("City of "), F.col("n_name")))
         .when(seg == "HOUSEHOLD", F.substring("n_name", 2, 6))
         .otherwise(F.concat(F.lit("zz"), F.col("c_custkey").cast("string"))))
    values = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", v.alias("city"))
    names = n.select("n_name", "n_nationkey", F.lpad(F.col("n_nationkey").cast("string"), 7, "0").alias("zip"),
                     (F.col("n_regionkey") * 10.5).alias("km"))
    out = cascading_lookup(values, "city", names, "n_name", ["zip", "km"], "n_nationkey",
                           {"zip": FT.DEFAULT_ZIP, "km": FT.DEFAULT_KM})
    return out.select("c_custkey", "city", "match_zip", "match_km",
                      F.coalesce("match_rank", F.lit(0)).alias("match_rank"))


def union_distinct(spark, sf):
    """SE1/SE2/SE5: an early and a late frame of the orders (the early one
    carries an extra column, undated orders count as late), unioned by name
    with missing columns as null, then made distinct."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    early = F.coalesce(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
    frames = [o.where(early).select("o_custkey", "o_orderstatus", "o_orderpriority"),
              o.where(~early).select("o_custkey", "o_orderstatus")]
    return frames[0].unionByName(frames[1], allowMissingColumns=True).distinct()


_LEDGER_INPUTS_SQL = """
  h AS (SELECT 'TR' || CAST(o_orderkey AS VARCHAR) AS ton,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'WH2' ELSE 'CD' END AS swi,
               CASE WHEN o_orderstatus = 'F' THEN lower(r_name) ELSE 'S' || CAST(c_nationkey AS VARCHAR) END AS rwi,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN lower(n_name) WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
                    ELSE ' ' || n_name || ' ' END AS city,
               CASE WHEN o_orderpriority = '2-HIGH' THEN n_name ELSE 'District 9' END AS district,
               o_orderdate AS rsd
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey),
  l AS (SELECT 'TR' || CAST(l_orderkey AS VARCHAR) AS ton,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'traslado' ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS item,
               CAST(l_quantity AS BIGINT) AS q FROM lineitem),
  dist AS (SELECT n_name AS city, lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS zip,
                  n_regionkey * 100 + n_nationkey + 0.125 AS km, n_nationkey AS ord FROM nation),
  wh AS (SELECT r_name AS wid, 'NATION_' || CAST(r_regionkey + 5 AS VARCHAR) AS city FROM region),
  hf AS (SELECT * FROM h WHERE swi = 'CD' AND rsd >= TIMESTAMP '1998-01-01 00:00:00'
                                 AND rsd <= TIMESTAMP '1998-12-31 23:59:59'),
  sums AS (SELECT ton, SUM(q) AS total FROM l
           WHERE ton IN (SELECT ton FROM hf) AND upper(item) != 'TRASLADO'
             AND ton NOT IN (SELECT DISTINCT ton FROM l WHERE upper(item) = 'TRASLADO')
           GROUP BY ton HAVING SUM(q) > 0),
  t AS (SELECT hf.ton, hf.rsd, sums.total,
               COALESCE(wh.city,
                        CASE WHEN trim(hf.district) IN (SELECT city FROM dist) THEN trim(hf.district) END,
                        CASE WHEN trim(hf.city) IN (SELECT city FROM dist) THEN trim(hf.city) END,
                        NULLIF(hf.city, ''), NULLIF(hf.district, ''), 'Unknown') AS dest
        FROM hf JOIN sums ON hf.ton = sums.ton LEFT JOIN wh ON upper(hf.rwi) = wh.wid),
  s AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'WholeSale' ELSE 'Retail' END AS canal,
               CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'W' || CAST(o_orderkey AS VARCHAR) END AS pon,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Traslado' ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS itemid,
               l_quantity AS qty, l_shipdate AS ctd
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  ws AS (SELECT pon AS ton, SUM(qty) AS total, MIN(CAST(ctd AS DATE)) AS d FROM s
         WHERE canal = 'WholeSale' AND CAST(ctd AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
           AND qty > 0 AND pon IS NOT NULL AND trim(pon) != '' AND upper(itemid) != 'TRASLADO'
           AND pon NOT IN (SELECT DISTINCT pon FROM s WHERE canal = 'WholeSale' AND upper(itemid) = 'TRASLADO'
                                                      AND pon IS NOT NULL)
         GROUP BY pon HAVING SUM(qty) > 0),
  recs AS (SELECT 'Retail' AS channel, ton, dest, CAST(total AS DOUBLE) AS total, CAST(rsd AS DATE) AS d FROM t
           UNION ALL SELECT 'Wholesale', ton, 'NATION_9', total, d FROM ws),
  cand AS (SELECT r.ton, d.zip, d.km, d.ord,
                  CASE WHEN trim(r.dest) = d.city THEN 1 WHEN lower(trim(r.dest)) = lower(d.city) THEN 2 ELSE 3 END AS rk
           FROM recs r JOIN dist d ON trim(r.dest) != '' AND (trim(r.dest) = d.city OR lower(trim(r.dest)) = lower(d.city)
                OR contains(lower(trim(r.dest)), lower(d.city)) OR contains(lower(d.city), lower(trim(r.dest))))),
  best AS (SELECT ton, zip, km FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ton ORDER BY rk, ord) AS rn FROM cand)
           WHERE rn = 1),
  ledger AS (
    SELECT 'Pudahuel' AS ORIGIN_NAME, '9020000' AS ORIGIN_ZIP_CODE, r.channel AS CHANNEL,
           COALESCE(b.zip, '0000000') AS DESTINATION_ZIP_CODE, COALESCE(left(r.dest, 500), '') AS DESTINATION_ADDRESS,
           'Ground' AS MODE, CAST(ROUND(CAST(COALESCE(b.km, 10.0) AS DECIMAL(38,18)), 2) AS DOUBLE) AS DISTANCE_KM,
           CAST(ROUND(CAST(COALESCE(r.total, 0.0) AS DECIMAL(18,4)) * CAST('0.32' AS DECIMAL(10,4)), 2) AS DOUBLE) AS WEIGHT_KG,
           CAST(ROUND(CAST('0.12418' AS DECIMAL(18,8)), 6) AS DOUBLE) AS EMISSIONS_FACTOR, 'NO' AS IS_ELECTRIC,
           strftime(r.d, '%Y-%m-%d') AS FECHA, r.ton AS REFERENCE_NUMBER
    FROM recs r LEFT JOIN best b ON r.ton = b.ton)
"""

ORACLE = {
    "q_ledger_union": "WITH " + _LEDGER_INPUTS_SQL + " SELECT * FROM ledger",
    "q_ledger_totals": "WITH " + _LEDGER_INPUTS_SQL + """
        SELECT COUNT(*) AS n_records, COUNT(*) FILTER (WHERE CHANNEL = 'Retail') AS n_transfers,
               COUNT(*) FILTER (WHERE CHANNEL = 'Wholesale') AS n_wholesale,
               ROUND(SUM(DISTANCE_KM), 2) AS total_distance_km, ROUND(SUM(WEIGHT_KG), 2) AS total_weight_kg
        FROM ledger""",
    "q_cascading_lookup": """
        WITH v AS (SELECT c_custkey,
                     CASE WHEN c_acctbal < 0 THEN '  ' WHEN c_mktsegment = 'BUILDING' THEN n_name
                          WHEN c_mktsegment = 'MACHINERY' THEN lower(n_name)
                          WHEN c_mktsegment = 'FURNITURE' THEN 'City of ' || n_name
                          WHEN c_mktsegment = 'HOUSEHOLD' THEN substr(n_name, 2, 6)
                          ELSE 'zz' || CAST(c_custkey AS VARCHAR) END AS city
                   FROM customer JOIN nation ON c_nationkey = n_nationkey),
             t AS (SELECT n_name AS name, n_nationkey AS ord, lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS zip,
                          n_regionkey * 10.5 AS km FROM nation),
             c AS (SELECT v.c_custkey, t.zip, t.km, t.ord,
                          CASE WHEN trim(v.city) = t.name THEN 1 WHEN lower(trim(v.city)) = lower(t.name) THEN 2 ELSE 3 END AS rk
                   FROM v JOIN t ON trim(v.city) != '' AND (trim(v.city) = t.name OR lower(trim(v.city)) = lower(t.name)
                        OR contains(lower(trim(v.city)), lower(t.name)) OR contains(lower(t.name), lower(trim(v.city))))),
             b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY rk, ord) AS rn FROM c)
                   WHERE rn = 1)
        SELECT v.c_custkey, v.city, COALESCE(b.zip, '0000000') AS match_zip, COALESCE(b.km, 10.0) AS match_km,
               COALESCE(b.rk, 0) AS match_rank
        FROM v LEFT JOIN b ON v.c_custkey = b.c_custkey""",
    "q_union_distinct": """
        SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderdate < TIMESTAMP '1998-01-01'
        UNION
        SELECT DISTINCT o_custkey, o_orderstatus, NULL FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderdate IS NULL""",
}

QUERIES = {
    "q_ledger_union": ledger_union,
    "q_ledger_totals": ledger_totals,
    "q_cascading_lookup": cascading_lookup_q,
    "q_union_distinct": union_distinct,
}
