"""Property tests: upsert key uniqueness and idempotence,
anti + semi joins partition the left side, keep-first equals the ordered
window pick."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.merge import duplicate_keys, merge_next_state
from ledgerline.operators.reconcile import missing_in

from .conftest import rows

keys = st.integers(0, 30)
vals = st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(keys, vals, max_size=40), st.dictionaries(keys, vals, min_size=1, max_size=40))
def test_upsert_unique_and_idempotent(spark, tgt, src):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(k, v, t0, t0) for k, v in tgt.items()],
                                   "k int, v double, created_at timestamp_ntz, updated_at timestamp_ntz")
    source = spark.createDataFrame(list(src.items()), "k int, v double")
    once = merge_next_state(target, source, ["k"], asof="2024-02-01 00:00:00")
    assert duplicate_keys(once, ["k"]).count() == 0
    assert once.count() == len(set(tgt) | set(src))
    twice = merge_next_state(once, source, ["k"], asof="2024-03-01 00:00:00")
    assert rows(once, "k", "v", "created_at") == rows(twice, "k", "v", "created_at")
    got = {r["k"]: r["v"] for r in once.collect()}
    assert got == {**tgt, **src}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), keys), max_size=50), st.lists(st.one_of(st.none(), keys), max_size=50))
def test_anti_and_semi_partition_left(spark, left, right):
    l = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "id int, k int")
    r = spark.createDataFrame([(k,) for k in right], "rk int")
    anti = missing_in(l, r, "k", "rk")
    semi = l.join(r.where(F.col("rk").isNotNull()).select("rk").distinct(), F.col("k") == F.col("rk"), "left_semi")
    ids = sorted([x[0] for x in rows(anti, "id")] + [x[0] for x in rows(semi, "id")])
    assert ids == list(range(len(left)))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 1000)), min_size=1, max_size=60,
                unique_by=lambda t: t))
def test_keep_first_equals_window(spark, data):
    df = spark.createDataFrame(data, "g string, o int")
    w = Window.partitionBy("g").orderBy("o")
    want = rows(df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn"))
    assert rows(keep_first(df, ["g"], ["o"])) == want
