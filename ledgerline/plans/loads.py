"""Keyed loads: upsert, stats, update-from, snapshot + history, full refresh,
period scans and calendars (PL6-PL11, SK1-SK13, FL1-FL3, DT10, DT11, SC6-SC12).

``events`` plays a keyed table receiving overlapping batches, ``orders`` /
``lineitem`` the ERP headers and lines, ``part`` the product master.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import double_or_zero, fill_blank_strings
from ..functions.dates import lookback_filter, period_filter
from ..operators.calendar import calendar_from, day_pairs
from ..operators.dedupe import latest_by
from ..operators.intervals import add_capture, state_at
from ..operators.merge import update_from, update_where, upsert, upsert_parts, upsert_stats, upsert_table
from ..session import shared_folder
from ..sources.parts import PartTable, bucket_of
from ..sources.tables import scan, table
from ..sources.versions import VersionedTable

UPSERT_ASOF = "2024-01-31 00:00:00"


def _upsert_inputs(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    target = (e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
              .withColumn("created_at", F.col("ts")).withColumn("updated_at", F.col("ts")).drop("ts"))
    source = (e.where(F.col("ts") >= F.lit("2024-01-18").cast("timestamp_ntz"))
              .withColumn("value", F.round(F.col("value") + 1.0, 2)).drop("ts"))
    return target, source


def upsert_events(spark, sf):
    """SK1/SM1/JN20: merge an overlapping batch (values changed) into the
    table by ``event_id``: matched rows take the batch values and a new
    ``updated_at``, new keys are inserted, others stay as they were."""
    target, source = _upsert_inputs(spark, sf)
    res = upsert(target, source, ["event_id"], UPSERT_ASOF)
    return res.table.select("event_id", "user_id", "event_type", F.round("value", 2).alias("value"),
                            "created_at", "updated_at")


def upsert_events_stats(spark, sf):
    """SK4/AG21: inserted / updated counts of the same merge."""
    target, source = _upsert_inputs(spark, sf)
    return upsert_stats(upsert(target, source, ["event_id"], UPSERT_ASOF).table, UPSERT_ASOF)


FIRST_LOAD, SECOND_LOAD = "2024-01-30 06:00:00", "2024-01-31 06:00:00"


def _order_loads(spark, sf):
    """All ``orders``, and a later load that changes some and brings new ones (with negative keys)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = o.where(F.col("o_orderkey") % 50 == 0).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    new = o.where(F.col("o_orderkey") % 97 == 0).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return o, changed.unionByName(new)


def upsert_whole_table(spark, sf):
    """SK1-SK5 end to end: two loads through the single writer, each publishing a whole new state."""
    base = shared_folder(spark, "loads")
    for batch, asof in zip(_order_loads(spark, sf), (FIRST_LOAD, SECOND_LOAD)):
        upsert_table(spark, base, batch, ["o_orderkey"], asof)
    return VersionedTable(spark, base).latest()


def _loaded_parts(spark, sf):
    t = PartTable(spark, shared_folder(spark, "loads"), bucket_of(["o_orderkey"], 64))
    stats = None
    for batch, asof in zip(_order_loads(spark, sf), (FIRST_LOAD, SECOND_LOAD)):
        _, stats = upsert_parts(t, batch, ["o_orderkey"], asof)
    return t, stats


def upsert_touched_parts(spark, sf):
    """SK1/SK3/SM1: the same two loads into a table of parts; the second reads and writes only the parts of its keys."""
    return _loaded_parts(spark, sf)[0].read()


def upsert_touched_stats(spark, sf):
    """SK4/AG21: rows the second load inserted and updated."""
    return _loaded_parts(spark, sf)[1]


CAPTURES = ("2024-01-06 00:00:00", "2024-01-11 00:00:00", "2024-01-16 00:00:00", "2024-01-16 12:00:00", "2024-01-21 00:00:00", "2024-01-31 00:00:00")


def history_from_intervals(spark, sf):
    """SK7/SM5: six captures (the latest event type of each user seen in the ten
    days before) kept as intervals of validity, and every capture rebuilt from them."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    t = PartTable(spark, shared_folder(spark, "loads"), bucket_of(["user_id"], 8))
    for at in CAPTURES:
        until = F.lit(at).cast("timestamp_ntz")
        seen = e.where((F.col("ts") < until) & (F.col("ts") >= until - F.expr("INTERVAL 10 DAYS")))
        add_capture(t, latest_by(seen, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type"), ["user_id"], at)
    out = None
    for at in CAPTURES:
        state = state_at(t, at).select(F.lit(at).alias("capture"), "user_id", "event_type")
        out = state if out is None else out.unionByName(state)
    return out


def update_order_status(spark, sf, since="2001-01-01"):
    """SK11-SK13: set each order's status from a keyed change set (orders
    with a line shipped since ``since``: the latest line status)."""
    li = table(spark, sf, "lineitem")
    changes = (latest_by(li.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
                         .select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"),
                         ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])
               .select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return update_from(o, changes, ["o_orderkey"], ["o_orderstatus"])


def point_update(spark, sf):
    """SK12: the header of one order set by its id; every other row as it was."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return update_where(o, F.col("o_orderkey") == 100, {"o_orderstatus": "X", "o_totalprice": F.col("o_totalprice") + 1})


def orders_by_day_pair(spark, sf):
    """DT11: the orders of each day ``[d, d + 1)`` of a half-open range, by the pairs that the tax load asks for."""
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("2000-01-28", "2000-03-02"))
    o = table(spark, sf, "orders").where((F.col("o_orderdate") >= since) & (F.col("o_orderdate") < until))
    pairs = day_pairs(spark, "2000-01-28", "2000-03-02")
    counts = o.groupBy(F.to_date("o_orderdate").alias("day_start")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(counts, "day_start", "left").select(F.date_format("day_start", "yyyy-MM-dd").alias("day_start"),
                                                          F.date_format("day_end", "yyyy-MM-dd").alias("day_end"),
                                                          F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"))


def snapshot_history(spark, sf):
    """PL10/SK7/SM5: closing row per user per day (latest capture of the day)."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return latest_by(e.select("user_id", "day", "ts", "event_id", "value"), ["user_id", "day"], ["ts", "event_id"]) \
        .select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id",
                F.col("ts").alias("closing_ts"), "value")


def full_refresh_clean(spark, sf):
    """PL11/SK8/CV2/NU1: product master with a price coerced from text (bad ->
    0) and blank strings filled; one overwrite job publishes it."""
    p = table(spark, sf, "part")
    dirty = p.select(
        "p_partkey", "p_name",
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") < 5, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("price_text"))
    clean = dirty.select("p_partkey", "p_name", "p_brand",
                         F.round(double_or_zero("price_text"), 2).alias("price"))
    return fill_blank_strings(clean)


def _period(spark, sf, day, period):
    li = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return li.where(period_filter(F.col("l_shipdate"), day, period)).select(
        "*", F.year("l_shipdate").alias("ship_year"), F.month("l_shipdate").alias("ship_month"))


def period_day(spark, sf):
    """FL1/DT13: lines shipped on one day (range predicate, pushed down)."""
    return _period(spark, sf, "1998-03-15", "day")


def period_month(spark, sf):
    """FL1/DT13: lines shipped in one month."""
    return _period(spark, sf, "1998-03-15", "month")


def period_year(spark, sf):
    """FL1/DT13: lines shipped in one year."""
    return _period(spark, sf, "1998-03-15", "year")


def period_calendar(spark, sf):
    """DT10/DT11: month calendar spanning the order dates (bounds from the
    data, both ends inclusive), left-joined to order counts per month."""
    o = table(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    cal = calendar_from(bounds, "lo", "hi", "month", "month_start") \
        .withColumn("month_end", F.date_sub(F.add_months("month_start", 1), 1))
    counts = o.groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("month_start")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    return cal.join(counts, "month_start", "left").select(
        F.date_format("month_start", "yyyy-MM-dd").alias("month_start"),
        F.date_format("month_end", "yyyy-MM-dd").alias("month_end"),
        F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"))


def lookback_window(spark, sf, asof="2024-01-30 12:00:00", days=3):
    """PL9/FL2/FL3/SC9: rows changed within ``days`` of ``asof`` (and an
    inclusive-day variant on the midnight-truncated bound)."""
    e = scan(spark, sf, "events", ["event_id", "user_id", "ts"])
    return e.where(lookback_filter("ts", asof, days)).withColumn(
        "since_midnight_bound", lookback_filter("ts", asof, days, midnight=True))


_ORDER_LOADS = """
        WITH b AS (
            SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 50 = 0
            UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 97 = 0)
        SELECT COALESCE(b.o_orderkey, o.o_orderkey) AS o_orderkey, COALESCE(b.o_custkey, o.o_custkey) AS o_custkey,
               COALESCE(b.o_orderstatus, o.o_orderstatus) AS o_orderstatus, COALESCE(b.o_totalprice, o.o_totalprice) AS o_totalprice,
               CASE WHEN o.o_orderkey IS NULL THEN TIMESTAMP '2024-01-31 06:00:00' ELSE TIMESTAMP '2024-01-30 06:00:00' END AS created_at,
               CASE WHEN b.o_orderkey IS NULL THEN TIMESTAMP '2024-01-30 06:00:00' ELSE TIMESTAMP '2024-01-31 06:00:00' END AS updated_at
        FROM orders o FULL OUTER JOIN b ON o.o_orderkey = b.o_orderkey"""

ORACLE = {
    "q_upsert": """
        WITH t AS (SELECT event_id, user_id, event_type, value, ts AS created_at, ts AS updated_at
                   FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
             s AS (SELECT event_id, user_id, event_type, ROUND(value + 1.0, 2) AS value
                   FROM events WHERE ts >= TIMESTAMP '2024-01-18 00:00:00')
        SELECT COALESCE(s.event_id, t.event_id) AS event_id,
               CASE WHEN s.event_id IS NOT NULL THEN s.user_id ELSE t.user_id END AS user_id,
               CASE WHEN s.event_id IS NOT NULL THEN s.event_type ELSE t.event_type END AS event_type,
               ROUND(CASE WHEN s.event_id IS NOT NULL THEN s.value ELSE t.value END, 2) AS value,
               CASE WHEN s.event_id IS NOT NULL AND t.event_id IS NOT NULL THEN t.created_at
                    WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.created_at END AS created_at,
               CASE WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.updated_at END AS updated_at
        FROM t FULL OUTER JOIN s ON t.event_id = s.event_id""",
    "q_upsert_stats": """
        WITH t AS (SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
             s AS (SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-18 00:00:00'),
             m AS (SELECT CASE WHEN s.event_id IS NOT NULL AND t.event_id IS NOT NULL THEN t.ts
                               WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.ts END AS created_at,
                          CASE WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.ts END AS updated_at
                   FROM t FULL OUTER JOIN s ON t.event_id = s.event_id)
        SELECT COUNT(*) FILTER (WHERE CAST(created_at AS DATE) = DATE '2024-01-31') AS inserted_rows,
               COUNT(*) FILTER (WHERE CAST(updated_at AS DATE) = DATE '2024-01-31'
                                  AND CAST(created_at AS DATE) != DATE '2024-01-31') AS updated_rows
        FROM m""",
    "q_update_from": """
        WITH ch AS (SELECT l_orderkey, l_linestatus FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                                         l_partkey DESC, l_suppkey DESC) AS rn
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01 00:00:00') WHERE rn = 1)
        SELECT o.o_orderkey, o.o_custkey, COALESCE(ch.l_linestatus, o.o_orderstatus) AS o_orderstatus, o.o_orderdate
        FROM orders o LEFT JOIN ch ON o.o_orderkey = ch.l_orderkey""",
    "q_upsert_table": _ORDER_LOADS,
    "q_upsert_parts": _ORDER_LOADS,
    "q_upsert_parts_stats": """
        SELECT CAST(COUNT(*) FILTER (WHERE o_orderkey % 97 = 0) AS BIGINT) AS inserted_rows,
               CAST(COUNT(*) FILTER (WHERE o_orderkey % 50 = 0) AS BIGINT) AS updated_rows FROM orders""",
    "q_point_update": """
        SELECT o_orderkey, CASE WHEN o_orderkey = 100 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority,
               CASE WHEN o_orderkey = 100 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "q_day_pairs": """
        WITH d AS (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '2000-01-28', DATE '2000-03-01', INTERVAL 1 DAY)) AS DATE) AS day_start),
             c AS (SELECT CAST(o_orderdate AS DATE) AS day_start, COUNT(*) AS n FROM orders GROUP BY 1)
        SELECT STRFTIME(d.day_start, '%Y-%m-%d') AS day_start, STRFTIME(CAST(d.day_start + INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS day_end,
               CAST(COALESCE(n, 0) AS BIGINT) AS n_orders
        FROM d LEFT JOIN c ON d.day_start = c.day_start""",
    "q_history_intervals": """
        WITH c(capture) AS (VALUES ('2024-01-06 00:00:00'), ('2024-01-11 00:00:00'), ('2024-01-16 00:00:00'), ('2024-01-16 12:00:00'),
                                   ('2024-01-21 00:00:00'), ('2024-01-31 00:00:00'))
        SELECT capture, user_id, event_type FROM (
          SELECT capture, user_id, event_type, ROW_NUMBER() OVER (PARTITION BY capture, user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events JOIN c ON ts < CAST(capture AS TIMESTAMP) AND ts >= CAST(capture AS TIMESTAMP) - INTERVAL 10 DAY) WHERE rn = 1""",
    "q_snapshot_history": """
        SELECT user_id, STRFTIME(day, '%Y-%m-%d') AS day, event_id, ts AS closing_ts, value FROM (
          SELECT *, CAST(ts AS DATE) AS day, ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                                               ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""",
    "q_full_refresh_clean": """
        SELECT p_partkey, COALESCE(p_name, '') AS p_name,
               COALESCE(CASE WHEN p_size > 45 THEN NULL ELSE p_brand END, '') AS p_brand,
               ROUND(COALESCE(TRY_CAST(CASE WHEN p_size < 5 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE), 0.0), 2) AS price
        FROM part""",
    "q_period_day": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               CAST(YEAR(l_shipdate) AS INTEGER) AS ship_year, CAST(MONTH(l_shipdate) AS INTEGER) AS ship_month
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-15' AND l_shipdate < TIMESTAMP '1998-03-16'""",
    "q_period_month": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               CAST(YEAR(l_shipdate) AS INTEGER) AS ship_year, CAST(MONTH(l_shipdate) AS INTEGER) AS ship_month
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01'""",
    "q_period_year": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               CAST(YEAR(l_shipdate) AS INTEGER) AS ship_year, CAST(MONTH(l_shipdate) AS INTEGER) AS ship_month
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'""",
    "q_period_calendar": """
        WITH b AS (SELECT CAST(DATE_TRUNC('month', MIN(o_orderdate)) AS DATE) AS lo,
                          CAST(DATE_TRUNC('month', MAX(o_orderdate)) AS DATE) AS hi FROM orders),
             cal AS (SELECT CAST(UNNEST(GENERATE_SERIES(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b),
             c AS (SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month_start, COUNT(*) AS n
                   FROM orders GROUP BY 1)
        SELECT STRFTIME(cal.month_start, '%Y-%m-%d') AS month_start,
               STRFTIME(CAST(cal.month_start + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS month_end,
               CAST(COALESCE(c.n, 0) AS BIGINT) AS n_orders
        FROM cal LEFT JOIN c ON cal.month_start = c.month_start""",
    "q_lookback_window": """
        SELECT event_id, user_id, ts,
               ts >= DATE_TRUNC('day', TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 3 DAY) AS since_midnight_bound
        FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 3 DAY""",
}

QUERIES = {
    "q_upsert": upsert_events,
    "q_upsert_stats": upsert_events_stats,
    "q_upsert_table": upsert_whole_table,
    "q_upsert_parts": upsert_touched_parts,
    "q_upsert_parts_stats": upsert_touched_stats,
    "q_update_from": update_order_status,
    "q_history_intervals": history_from_intervals,
    "q_point_update": point_update,
    "q_day_pairs": orders_by_day_pair,
    "q_snapshot_history": snapshot_history,
    "q_full_refresh_clean": full_refresh_clean,
    "q_period_day": period_day,
    "q_period_month": period_month,
    "q_period_year": period_year,
    "q_period_calendar": period_calendar,
    "q_lookback_window": lookback_window,
}
