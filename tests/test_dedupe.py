"""Per-key picking, NOT IN semantics and skew-safe numbering."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import exclude_duplicated, keep_first, latest_by, not_in, number_within

from .conftest import rows


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 5, "w")], "k string, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", None, "z")]
    assert rows(latest_by(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 5, "w")]


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    vals = spark.createDataFrame([(2,)], "v int")
    assert rows(not_in(left, "k", vals, "v")) == [(1,)]
    empty = spark.createDataFrame([], "v int")
    assert len(rows(not_in(left, "k", empty, "v"))) == 3
    with_null = spark.createDataFrame([(2,), (None,)], "v int")
    assert rows(not_in(left, "k", with_null, "v")) == []


def test_exclude_duplicated(spark):
    df = spark.createDataFrame([("S1", 1, "a"), ("S1", 1, "b"), ("S2", 1, "c"), ("S2", 2, "d")], "s string, ln int, x string")
    assert rows(exclude_duplicated(df, ["s", "ln"], "s"), "x") == [("c",), ("d",)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 10_000)),
                min_size=1, max_size=300, unique_by=lambda t: t[1]))
def test_number_within_matches_window(spark, data):
    df = spark.createDataFrame(data, "store string, sku int")
    got = rows(number_within(df, ["store"], ["sku"], "n"), "store", "sku", "n")
    w = Window.partitionBy("store").orderBy("sku")
    want = rows(df.withColumn("n", F.row_number().over(w)), "store", "sku", "n")
    assert got == want


def test_number_within_hot_and_cold_groups(spark):
    data = [("hot", i) for i in range(200)] + [("cold", i) for i in range(5)] + [(None, i) for i in range(30)]
    df = spark.createDataFrame(data, "store string, sku int")
    got = rows(number_within(df, ["store"], ["sku"], "n"), "store", "sku", "n")
    want = [(s, k, i + 1) for s, n in (("hot", 200), ("cold", 5), (None, 30)) for i, k in enumerate(range(n))]
    assert got == sorted(want, key=lambda t: tuple((x is not None, "" if x is None else x) for x in t))


def test_number_within_counters(spark):
    data = [("hot", i, i % 3 != 0) for i in range(120)] + [("cold", i, i % 2 == 0) for i in range(7)]
    df = spark.createDataFrame(data, "g string, o int, ok boolean")
    got = rows(number_within(df, ["g"], ["o"], "n", counters={"m": F.col("ok")}), "g", "o", "n", "m")
    want = []
    for g in ("hot", "cold"):
        k = 0
        for i, (gg, o, ok) in enumerate([d for d in data if d[0] == g]):
            k += ok
            want.append((g, o, i + 1, k if ok else None))
    assert got == sorted(want, key=lambda t: tuple((x is not None, "" if x is None else x) for x in t))


def test_number_within_two_counters(spark):
    data = [(f"g{i % 3}" if i % 7 else None, i, i % 2 == 0, None if i % 5 == 0 else i % 3 == 0) for i in range(200)]
    df = spark.createDataFrame(data, "g string, o int, a boolean, b boolean")
    got = rows(number_within(df, ["g"], ["o"], "n", counters={"na": F.col("a"), "nb": F.col("b")}), "g", "o", "n", "na", "nb")
    want, seen = [], {}
    for g, o, a, b in data:
        c = seen.setdefault(g, [0, 0, 0])
        c[0] += 1
        c[1] += a
        c[2] += bool(b)
        want.append((g, o, c[0], c[1] if a else None, c[2] if b else None))
    assert got == sorted(want, key=lambda t: tuple((x is not None, "" if x is None else x) for x in t))
