"""Table scans (SC6-SC12, SC18-SC20, FL11): predicates reach the Parquet
scan, projections prune the read schema, required rows raise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.tables import column_between, require_row, scan, scan_period, where_all

from .conftest import SF_SMALL


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_period_scan_is_pushed_and_pruned(spark):
    df = scan_period(spark, SF_SMALL, "lineitem", "l_shipdate", "1998-03-15", "month",
                     ["l_orderkey", "l_shipdate"])
    p = plan(df)
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01T00:00)" in p and "LessThan(l_shipdate,1998-04-01T00:00)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p
    got = df.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    assert got[0] >= dt.datetime(1998, 3, 1) and got[1] < dt.datetime(1998, 4, 1)


def test_tuple_predicates(spark):
    e = scan(spark, SF_SMALL, "events", ["event_id", "value", "event_type"])
    out = where_all(e, [("value", ">", 50.0), ("event_type", "<>", "error")])
    assert out.where((F.col("value") <= 50) | (F.col("event_type") == "error")).count() == 0
    assert out.count() == e.where((F.col("value") > 50) & (F.col("event_type") != "error")).count()


def test_column_between_and_require_row(spark):
    o = scan(spark, SF_SMALL, "orders")
    keys = column_between(o, "o_orderkey", "o_orderdate", "1998-01-01", "1998-01-31")
    assert keys.columns == ["o_orderkey"] and keys.count() > 0
    assert require_row(o, F.col("o_orderkey") == 1).count() == 1
    with pytest.raises(ValueError):
        require_row(o, F.col("o_orderkey") == -1, "order")
