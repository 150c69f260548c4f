"""Column functions on tiny frames with the edge rows of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import arrays as A
from ledgerline.functions import casts as C
from ledgerline.functions import dates as D
from ledgerline.functions import text as T


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_strip_gid(spark):
    data = [("gid://shopify/Order/123",), ("gid://shopify/Customer/9",), ("456",), ("",), (None,)]
    assert one(spark, T.strip_gid("v", "Order"), data, "v string") == ["123", "gid://shopify/Customer/9", "456", "", None]
    assert one(spark, T.strip_gid_after_prefix("v", "Order"), data, "v string") == \
        ["123", "gid://shopify/Customer/9", "456", None, None]


def test_cut_query_suffix(spark):
    data = [("77?model_name=CustomerAddress&x=1",), ("78?other",), (None,)]
    assert one(spark, T.cut_query_suffix("v"), data, "v string") == ["77", "78?other", None]


def test_key_text_null_marker_and_floats(spark):
    df = spark.createDataFrame([("A", None, 12345678.0), ("B", "x", None)], "a string, b string, q double")
    got = [r[0] for r in df.select(T.key_text("a", "b", "q", float_cols=("q",))).collect()]
    assert got == ["A-None-12345678.0", "B-x-nan"]


def test_key_if_all(spark):
    data = [("33", "10"), ("33", ""), (None, "1")]
    assert one(spark, T.key_if_all("a", "b"), data, "a string, b string") == ["33-10", "", ""]


def test_names_and_sentinels(spark):
    data = [("Ana Maria Perez",), ("Solo",)]
    assert one(spark, T.first_word("v"), data, "v string") == ["Ana", "Solo"]
    assert one(spark, T.rest_words("v"), data, "v string") == ["Maria Perez", ""]
    data = [("nan",), ("False",), ("12-3",), (None,)]
    assert one(spark, T.blank_sentinels("v"), data, "v string") == ["", "", "12-3", None]
    assert one(spark, T.null_sentinel("v"), [("null",), ("1.5",)], "v string") == [None, "1.5"]


def test_xml_text_repair(spark):
    data = [("A &amp; B &lt;x&gt;",), ("Cobre & Co",), ("&#39;ok&#39;",)]
    assert one(spark, T.html_unescape("v"), data, "v string") == ["A & B <x>", "Cobre & Co", "'ok'"]
    data = [("Cobre & Co",), ("A &amp; B",), ("&#233;",)]
    assert one(spark, T.repair_ampersands("v"), data, "v string") == ["Cobre &amp; Co", "A &amp; B", "&#233;"]


def test_event_name_and_address(spark):
    data = [("61-100", "costanera"), ("1-100", "pucon")]
    assert one(spark, T.sale_event_name("i"), data, "i string, s string") == \
        ["[NC] Placed retail return", "Placed Retail Order"]
    assert one(spark, T.sale_event_name("i", "s"), data, "i string, s string") == \
        ["[NC] Placed retail return - COSTANERA", "Placed Retail Order - PUCON"]
    data = [("Calle 1", "Santiago"), ("", "Temuco"), ("", ""), (None, None)]
    assert one(spark, T.address_text("a", "b"), data, "a string, b string") == \
        ["Calle 1, Santiago", ", Temuco", "", ""]


def test_safe_casts(spark):
    data = [("12.5",), ("",), ("abc",), (None,)]
    assert one(spark, C.safe_double("v"), data, "v string") == [12.5, None, None, None]
    assert one(spark, C.double_or_zero("v"), data, "v string") == [12.5, 0.0, 0.0, 0.0]
    assert one(spark, C.int_or_zero("v"), [(2.5,), (-2.7,), (None,)], "v double") == [2, -2, 0]
    assert one(spark, C.flag_from_01("v"), [(1,), (0,), (None,)], "v int") == [True, False, False]
    assert one(spark, C.flag_from_yes_no("v"), [("Yes",), ("No",), (None,)], "v string") == [True, False, False]
    data = [("gid://shopify/Product/42",), ("17",), ("gid://shopify/Product/x",), ("abc",), (None,)]
    assert one(spark, C.numeric_id("v"), data, "v string") == [42, 17, None, None, None]


def test_first_truthy_and_source(spark):
    df = spark.createDataFrame([("", None, "c@x"), (None, "b@x", "c@x"), (None, "", None)], "a string, b string, c string")
    named = [("a", F.col("a")), ("b", F.col("b")), ("c", F.col("c"))]
    got = [(r[0], r[1]) for r in df.select(C.first_truthy("a", "b", "c"), C.first_truthy_source(named)).collect()]
    assert got == [("c@x", "c"), ("b@x", "b"), (None, None)]


def test_null_safe_flag_and_fill(spark):
    assert one(spark, C.equals_null_safe("v", "SUBSCRIBED"), [("SUBSCRIBED",), (None,)], "v string") == [True, False]
    df = spark.createDataFrame([(None, None, 1.0)], "a string, b timestamp_ntz, c double")
    r = C.fill_blank_strings(df).collect()[0]
    assert r["a"] == "" and r["b"] is None and r["c"] == 1.0


def test_dates(spark):
    data = [("31/12/2024",), ("2024-12-31",), ("31-31-2024",)]
    assert one(spark, D.parse_day_first("v"), data, "v string") == \
        [dt.datetime(2024, 12, 31), dt.datetime(2024, 12, 31), None]
    assert one(spark, D.date_from_prefix("v"), [("2024-03-05T10:00:00",), ("bad",)], "v string") == \
        [dt.date(2024, 3, 5), None]
    data = [(dt.datetime(2024, 7, 1, 12, 0),)]
    assert one(spark, D.utc_to_local("v"), data, "v timestamp_ntz") == [dt.datetime(2024, 7, 1, 8, 0)]
    assert one(spark, D.local_to_utc(D.utc_to_local("v")), data, "v timestamp_ntz") == [dt.datetime(2024, 7, 1, 12, 0)]
    data = [(dt.datetime(2024, 1, 1, 0, 0, 1),), (dt.datetime(2023, 12, 31, 23, 59, 59),)]
    assert one(spark, D.whole_days("2024-01-08 00:00:00", "v"), data, "v timestamp_ntz") == [6, 7]
    assert one(spark, D.iso_week_label("v"), [(dt.date(2024, 1, 1),)], "v date") == ["W1"]


def test_month_end_fixed_list(spark):
    data = [(dt.date(2024, 1, 31),), (dt.date(2024, 2, 28),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 15),)]
    assert one(spark, D.is_month_end("v"), data, "v date") == [True, True, False, False]
    assert one(spark, D.is_month_end("v", leap_aware=True), data, "v date") == [True, False, True, False]


def test_period_bounds_and_resolve_range():
    assert D.period_bounds("2024-02-10", "month") == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    assert D.period_bounds("2024-12-10", "month") == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    assert D.period_bounds("2024-12-10", "year") == (dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    today = dt.date(2024, 5, 10)
    assert D.resolve_range("2024-01-01", "2024-01-31", today=today) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert D.resolve_range("2024-05-01", None, today=today) == (dt.date(2024, 5, 1), today)
    assert D.resolve_range(None, "2024-03-31", lookback_days=30, today=today) == (dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    assert D.resolve_range(None, None, lookback_days=7, today=today) == (dt.date(2024, 5, 3), today)


def test_arrays(spark):
    df = spark.createDataFrame([([{"name": "Talla", "value": "M"}, {"name": "SIZE", "value": "L"}],), ([],)],
                               "o array<struct<name:string,value:string>>")
    got = [r[0] for r in df.select(A.first_match("o", "name", A.OPTION_ALIASES["option2"], "value")).collect()]
    assert got == ["L", None]
    df = spark.createDataFrame([([{"name": "committed", "quantity": 1}, {"name": "available", "quantity": 7}],), ([],)],
                               "q array<struct<name:string,quantity:int>>")
    assert [r[0] for r in df.select(A.available_quantity("q")).collect()] == [7, 0]
    assert one(spark, A.joined_set("a"), [(["b", "a", "b"],)], "a array<string>") == ["a, b"]
    assert one(spark, A.weight_unit("v"), [("GRAMS",), ("KG",), (None,)], "v string") == ["g", "kg", "kg"]


def test_decimal_half_up(spark):
    got = one(spark, A.decimal_product("q", F.lit("0.32"), 2), [(3.0,), (7.0,), (None,)], "q double")
    assert [None if g is None else float(g) for g in got] == [0.96, 2.24, None]
    # 0.125 and 2.675 round up (HALF_UP on decimals, not binary floats)
    assert [float(x) for x in one(spark, A.round_half_up("v", 2), [(0.125,), (2.675,)], "v double")] == [0.13, 2.68]


def test_calendars_and_rate_fanout(spark):
    from ledgerline.operators.calendar import day_pairs, period_calendar, rate_fanout
    months = [r[0] for r in period_calendar(spark, "2024-01-15", "2024-03-02", "month").collect()]
    assert months == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    pairs = [(r[0], r[1]) for r in day_pairs(spark, "2024-02-28", "2024-03-01").collect()]
    assert pairs == [(dt.date(2024, 2, 28), dt.date(2024, 2, 29)), (dt.date(2024, 2, 29), dt.date(2024, 3, 1))]
    assert day_pairs(spark, "2024-03-01", "2024-03-01").count() == 0
    rates = spark.createDataFrame([(dt.date(2024, 2, 28), 1.0), (dt.date(2024, 2, 29), 2.0), (dt.date(2024, 3, 15), 3.0)],
                                  "d date, rate double")
    got = sorted((r["d"].isoformat(), r["rate_type"]) for r in rate_fanout(rates, "d").collect())
    assert got == [("2024-02-28", "Cierre"), ("2024-02-28", "Predeterminado"), ("2024-02-28", "Tienda"),
                   ("2024-02-29", "Predeterminado"), ("2024-02-29", "Tienda"),
                   ("2024-03-15", "Predeterminado"), ("2024-03-15", "Tienda")]


def test_ntz_text_ignores_session_zone(spark):
    """A wall time in a DST gap of the session zone keeps its text."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        df = spark.createDataFrame([(dt.datetime(1995, 10, 15, 0, 0, 0, 1500),)], "t timestamp_ntz")
        r = df.select(D.ntz_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), D.ts_text("t"),
                      D.parse_day_first(F.lit("15/10/1995")), D.safe_timestamp(F.lit("1995-10-15T00:00:00Z"))).first()
        assert r[0] == "1995-10-15T00:00:00.001500Z" and r[1] == "1995-10-15 00:00:00"
        assert r[2] == dt.datetime(1995, 10, 15) and r[3] == dt.datetime(1995, 10, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
