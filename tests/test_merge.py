"""Upsert and sinks (SK1-SK13) with the B13 edge rows, plus properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.merge import (check_unique, duplicate_keys, merge_next_state, snapshot_and_history,
                                        update_from, update_where, upsert, upsert_stats, write_version)

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
ASOF = "2024-02-01 10:00:00"
NOW = dt.datetime(2024, 2, 1, 10, 0)
TGT = "k1 string, k2 string, v double, created_at timestamp_ntz, updated_at timestamp_ntz"


def target(spark):
    return spark.createDataFrame([("a", "1", 1.0, T0, T0), ("b", "1", 2.0, T0, T0), ("c", None, 3.0, T0, T0),
                                  ("d", "1", 4.0, T0, T0)], TGT)


def test_upsert_edge_rows(spark):
    src = spark.createDataFrame([("a", "1", 10.0), ("b", "1", 2.0), ("c", None, 30.0), ("e", "1", 5.0)],
                                "k1 string, k2 string, v double")
    res = upsert(target(spark), src, ["k1", "k2"], ASOF)
    assert res.accepted
    got = rows(res.table, "k1", "k2", "v", "created_at", "updated_at")
    assert got == sorted([
        ("a", "1", 10.0, T0, NOW),      # changed value
        ("b", "1", 2.0, T0, NOW),       # unchanged value still updated
        ("c", None, 3.0, T0, T0),       # null key part never matches ...
        ("c", None, 30.0, NOW, NOW),    # ... so it is inserted again
        ("d", "1", 4.0, T0, T0),        # untouched
        ("e", "1", 5.0, NOW, NOW),      # new key
    ], key=lambda t: tuple((x is not None, "" if x is None else x) for x in t))
    st = upsert_stats(res.table, ASOF).collect()[0]
    assert (st["inserted_rows"], st["updated_rows"]) == (2, 2)


def test_duplicate_batch_rejected(spark):
    src = spark.createDataFrame([("a", "1", 10.0), ("a", "1", 11.0)], "k1 string, k2 string, v double")
    res = upsert(target(spark), src, ["k1", "k2"], ASOF)
    assert not res.accepted
    assert rows(res.rejected, "k1", "k2", "n_rows") == [("a", "1", 2)]
    assert res.table.count() == 4
    with pytest.raises(ValueError):
        upsert(target(spark), src, ["k1", "k2"], ASOF, on_duplicate="raise")


def test_empty_batch_is_noop(spark):
    src = spark.createDataFrame([], "k1 string, k2 string, v double")
    res = upsert(target(spark), src, ["k1", "k2"], ASOF)
    assert res.accepted and res.table.count() == 4


def test_upsert_idempotent_and_unique(spark):
    src = spark.createDataFrame([("a", "1", 10.0), ("e", "1", 5.0)], "k1 string, k2 string, v double")
    once = merge_next_state(target(spark), src, ["k1", "k2"], asof=ASOF)
    twice = merge_next_state(once, src, ["k1", "k2"], asof="2024-03-01 00:00:00")
    strip = lambda df: rows(df, "k1", "k2", "v", "created_at")
    assert strip(once) == strip(twice)
    check_unique(once.where(F.col("k2").isNotNull()), ["k1", "k2"])
    assert duplicate_keys(once, ["k1", "k2"]).count() == 0


def test_check_unique_raises(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        check_unique(df, ["k"])


def test_update_from_and_point_update(spark):
    t = spark.createDataFrame([("r1", "S1", "A", None), ("r1", "S1", "B", None), ("r1", "S2", "A", None)],
                              "rid string, store string, sku string, tr string")
    ch = spark.createDataFrame([("r1", "S1", "A", "TR1"), ("r1", "S2", "A", "TR2")],
                               "rid string, store string, sku string, tr string")
    out = update_from(t, ch, ["rid", "store", "sku"], ["tr"])
    assert rows(out) == [("r1", "S1", "A", "TR1"), ("r1", "S1", "B", None), ("r1", "S2", "A", "TR2")]
    out2 = update_where(out, F.col("sku") == "B", {"tr": "N/A"})
    assert rows(out2, "sku", "tr") == [("A", "TR1"), ("A", "TR2"), ("B", "N/A")]


def test_update_from_refuses_repeated_keys(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError):
        update_from(t, spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int"), ["k"], ["v"])


def test_merge_keeps_columns_the_batch_does_not_list(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v int, extra string")
    b = spark.createDataFrame([("a", 10), ("c", 30), (None, 40)], "k string, v int")
    out = merge_next_state(t, b, ["k"], asof=ASOF)
    assert rows(out, "k", "v", "extra") == [(None, 3, "z"), (None, 40, None), ("a", 10, "x"), ("b", 2, "y"), ("c", 30, None)]


def test_snapshot_history(spark):
    hist = spark.createDataFrame([], "sku string, qty int, ts timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
    old = spark.createDataFrame([("w", 9, T0)], "sku string, qty int, ts timestamp_ntz")
    cap = spark.createDataFrame([("x", 1, T0), ("y", 2, T0)], "sku string, qty int, ts timestamp_ntz")
    snap, res = snapshot_and_history(old, hist, cap, ["sku"], "ts", ASOF)
    assert res.accepted and rows(snap, "sku") == [("x",), ("y",)] and res.table.count() == 2
    twice = cap.unionByName(spark.createDataFrame([("x", 5, T0)], cap.schema))
    snap, res = snapshot_and_history(old, hist, twice, ["sku"], "ts", ASOF)
    assert not res.accepted and rows(res.rejected, "sku") == [("x",)]
    assert rows(snap, "sku") == [("w",)] and res.table.count() == 0     # snapshot and history stay


def test_write_version_and_versioned_table_agree(spark, tmp_path):
    from ledgerline.sources.versions import VersionedTable
    base = str(tmp_path / "tbl")
    assert spark.read.parquet(write_version(spark.range(3), base, 1)).count() == 3
    table = VersionedTable(spark, base)
    assert table.versions() == [1] and table.latest().count() == 3
    assert table.version_for("s-0") == (2, 1)
    table.publish(spark.range(4), 2, tag="s-0")
    assert table.version_for("s-0") == (2, 1) and table.version_for("s-1") == (3, 2) and table.latest().count() == 4


def test_upsert_table_versions(spark):
    import uuid
    from ledgerline.operators.merge import upsert_table
    from ledgerline.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/tbl-{uuid.uuid4().hex}"
    b1 = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    v, st = upsert_table(spark, base, b1, ["k"], "2024-01-01 00:00:00")
    assert v == 1 and (st.first()["inserted_rows"], st.first()["updated_rows"]) == (2, 0)
    b2 = spark.createDataFrame([("b", 20.0), ("c", 3.0)], "k string, v double")
    v, st = upsert_table(spark, base, b2, ["k"], "2024-01-02 00:00:00")
    assert v == 2 and (st.first()["inserted_rows"], st.first()["updated_rows"]) == (1, 1)
    v, rejected = upsert_table(spark, base, spark.createDataFrame([("d", 1.0), ("d", 2.0)], "k string, v double"),
                               ["k"], "2024-01-03 00:00:00")
    assert v is None and rejected.count() == 1
    assert upsert_table(spark, base, b1.limit(0), ["k"], "2024-01-03 00:00:00") == (None, None)
    latest = spark.read.parquet(f"{base}/v=0000000002")
    assert rows(latest, "k", "v") == [("a", 1.0), ("b", 20.0), ("c", 3.0)]


def test_upsert_table_partitioned(spark):
    import uuid
    from ledgerline.operators.merge import upsert_table
    from ledgerline.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/ptbl-{uuid.uuid4().hex}"
    b = spark.createDataFrame([("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0)], "k string, day string, v double")
    v, _ = upsert_table(spark, base, b, ["k"], "2024-01-02 00:00:00", partition_by=["day"])
    df = spark.read.parquet(f"{base}/v={v:010d}")
    assert rows(df.where("day = '2024-01-02'"), "k") == [("b",)]


def test_merge_takes_a_column_named_present(spark):
    t = spark.createDataFrame([("a", True, 1)], "k string, present boolean, hit int")
    out = merge_next_state(t, spark.createDataFrame([("a", False, 2), ("b", True, 3)], t.schema), ["k"], asof=ASOF)
    assert rows(out, "k", "present", "hit") == [("a", False, 2), ("b", True, 3)]
