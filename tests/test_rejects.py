"""Declared schemas with rejects (UD5, Q14), the one-file CSV (SK14), history as intervals (SK7)."""

import datetime as dt
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.intervals import ENDED, HOLDING, add_capture, state_at
from ledgerline.operators.merge import export_csv_file
from ledgerline.operators.rejects import Declared, split_rejects
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.parts import PartTable, bucket_of

from .conftest import rows


def outcome(spark, column, texts):
    """(value, reason) of each raw text of one declared column."""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    valid, bad = split_rejects(df, [Declared("id", "INT"), column], ["id"])
    good = {r["id"]: (r[column.name], None) for r in valid.collect()}
    return [good.get(i) or tuple(bad.where(F.col("id") == i).select("raw", "reason").first()) for i in range(len(texts))]


def test_numbers(spark):
    assert outcome(spark, Declared("x", "FLOAT"), ["1", " -2.5 ", ".5", "1e3", "1d", "NaN", "1,5", "", None]) == [
        (1.0, None), (-2.5, None), (0.5, None), (1000.0, None), ("1d", "not a number"), ("NaN", "not a number"), ("1,5", "not a number"), (None, None), (None, None)]
    assert outcome(spark, Declared("x", "INT", required=True), ["7", "7.0", "3000000000", "x", " ", None]) == [
        (7, None), ("7.0", "not a whole number"), ("3000000000", "out of range"), ("x", "not a number"), (" ", "missing"), (None, "missing")]
    got = outcome(spark, Declared("x", "NUMBER(5,2)"), ["123.456", "1234", "-999.99"])
    assert [str(v) for v, _ in got] == ["123.46", "1234", "-999.99"] and got[1][1] == "out of range"


def test_dates_flags_and_texts(spark):
    d = Declared("x", "TIMESTAMP", formats=("dd/MM/yyyy", "yyyy-MM-dd"))
    assert outcome(spark, d, ["29/02/2024", "2024-01-02", "30/02/2024", "2024-13-01"]) == [
        (dt.datetime(2024, 2, 29), None), (dt.datetime(2024, 1, 2), None), ("30/02/2024", "not a date"), ("2024-13-01", "not a date")]
    assert outcome(spark, Declared("x", "DATE"), ["2024-02-29", "2023-02-29"]) == [(dt.date(2024, 2, 29), None), ("2023-02-29", "not a date")]
    assert outcome(spark, Declared("x", "BOOLEAN"), ["Yes", "no", "TRUE", "0", "2"]) == [(True, None), (False, None), (True, None), (False, None), ("2", "not a flag")]
    assert outcome(spark, Declared("x", "VARCHAR(3)"), ["abc", " a ", "abcd", ""]) == [("abc", None), (" a ", None), ("abcd", "too long"), ("", None)]


def test_every_bad_value_of_a_row_is_listed_and_no_row_is_lost(spark):
    df = spark.createDataFrame([("k1", "x", "y"), ("k2", "1", "2024-01-01"), (None, "z", None)], "key string, n string, d string")
    columns = [Declared("KEY", "VARCHAR", "key", required=True), Declared("N", "INT", "n"), Declared("D", "DATE", "d"), Declared("GONE", "INT", required=True)]
    valid, bad = split_rejects(df, columns[:3], ["key"])
    assert rows(valid, "KEY", "N") == [("k2", 1)]
    assert rows(bad) == [(None, "KEY", None, "missing"), (None, "N", "z", "not a number"), ("k1", "D", "y", "not a date"), ("k1", "N", "x", "not a number")]
    valid, bad = split_rejects(df, columns, ["key"])
    assert valid.count() == 0 and bad.where("column = 'GONE' AND reason = 'missing'").count() == 3
    assert split_rejects(df.limit(0), columns, ["key"])[1].count() == 0


def test_csv_is_one_file_in_order_with_mark_and_header(spark, tmp_path):
    data = [(i, f"name {i}" if i % 3 else f'quo"te; {i}\nline', None if i % 7 == 0 else f" {i} é ") for i in range(500)]
    df = spark.createDataFrame(data, "id int, name string, `no;te` string").repartition(6)
    path = export_csv_file(df, str(tmp_path / "out.csv"), [F.col("id").desc()])
    duckdb.connect().execute(f"""
        COPY (SELECT * FROM (VALUES {", ".join("(%d, '%s', %s)" % (i, n, "NULL" if x is None else f"'{x}'") for i, n, x in data)}) t(id, name, "no;te")
              ORDER BY id DESC) TO '{tmp_path}/want.csv' (HEADER, DELIMITER ';')""")
    assert open(path, "rb").read() == b"\xef\xbb\xbf" + open(tmp_path / "want.csv", "rb").read()
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.csv", "want.csv"]
    export_csv_file(df.limit(0), path, ["id"], sep=",", bom=False)
    assert open(path).read() == "id,name,no;te\n"


def test_history_as_intervals(spark):
    t = PartTable(spark, f"{ensure_checkpoint_dir(spark)}/hist-{uuid.uuid4().hex}", bucket_of(["k"], 32))
    s = "k string, v int, w string"
    captures = [("2024-01-01 06:00:00", [(f"k{i}", i, None) for i in range(100)]),
                ("2024-01-01 12:00:00", [(f"k{i}", i if i else 7, None) for i in range(99)]),         # k0 changed, k99 gone
                ("2024-01-02 06:00:00", [(f"k{i}", i if i else 7, None) for i in range(99)]),         # nothing changed
                ("2024-01-03 06:00:00", [(f"k{i}", i, "n" if i == 5 else None) for i in range(100)])]  # k0 back, k5 changed, k99 again
    sizes = []
    for at, data in captures:
        before = t.version()
        v = add_capture(t, spark.createDataFrame(data, s), ["k"], at)
        sizes.append(sum(v.parts[p] != before.parts.get(p) for p in v.parts) if before else len(v.parts))
    assert sizes[1] in (2, 3) and sizes[2] == 0 and sizes[3] <= 4  # only buckets with a change, and the ended rows
    for at, data in captures:
        assert rows(state_at(t, at)) == rows(spark.createDataFrame(data, s))
        assert rows(state_at(t, at.replace(":00:00", ":59:00"))) == rows(spark.createDataFrame(data, s))
    assert state_at(t, "2023-12-31 00:00:00").count() == 0
    assert t.read().count() == 100 + 2 + 1 + 1 and {p.split("-")[0] + "-" for p in t.version().parts} == {HOLDING, ENDED}
    with pytest.raises(ValueError):
        add_capture(t, spark.createDataFrame(captures[0][1], s), ["k"], "2024-01-02 00:00:00")
    with pytest.raises(ValueError):
        add_capture(t, spark.createDataFrame([("a", 1, None)] * 2, s), ["k"], "2024-01-09 00:00:00")


def test_one_result_alone_stores_nothing_and_checks_a_row_once(spark):
    columns = [Declared("K", "BIGINT", "k", required=True), Declared("N", "INT", "n"), Declared("D", "DATE", "d")]
    df = spark.createDataFrame([("1", "2", "2024-01-01"), ("x", "1.0", "2024-13-01"), (None, "99999999999", None), ("+3", "-4", "")], "k string, n string, d string")
    df = df.repartition(2)
    kept, alone = (split_rejects(df, columns, ["k"], store=s) for s in (True, False))
    for a, b in zip(kept, alone):
        assert rows(a) == rows(b)
    assert rows(alone[1], "column", "reason") == [("D", "not a date"), ("K", "missing"), ("K", "not a number"), ("N", "not a whole number"), ("N", "out of range")]
    assert rows(alone[0], "K", "N") == [(1, 2), (3, -4)]
    fresh = split_rejects(df, columns, ["k"], store=False)[1]
    plan = fresh._sc._jvm.PythonSQLUtils.explainString(fresh._jdf.queryExecution(), "simple")
    assert plan.count("filter(array(") == 1
