"""Table scans (SC6-SC12, SC18-SC20).

A scan is ``spark.read.parquet`` followed by the projection and predicate of
the caller; Catalyst pushes both into the reader (``ReadSchema`` holds only
the selected columns, ``PushedFilters`` the predicate), which replaces the
reference's per-period, per-page source queries with one distributed scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import between_days, period_filter

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """SC18: read one table of a dataset folder."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, base: str, name: str, columns: list[str] | None = None,
         where: Column | None = None) -> DataFrame:
    """SC6/SC8/SC10/SC12: projection + predicate on one table."""
    df = table(spark, base, name)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_period(spark: SparkSession, base: str, name: str, ts_col: str, day, period: str,
                columns: list[str] | None = None) -> DataFrame:
    """SC6/SC7/FL1: rows of one day / month / year, as a range predicate."""
    return scan(spark, base, name, columns, period_filter(F.col(ts_col), day, period))


def column_between(df: DataFrame, target_col: str, compare_col: str, start, end) -> DataFrame:
    """SC19: one column for an inclusive date range, kept distributed."""
    return df.where(between_days(F.col(compare_col), start, end)).select(target_col)


_OPS = {"=": "__eq__", "==": "__eq__", "<>": "__ne__", "!=": "__ne__", ">": "__gt__",
        ">=": "__ge__", "<": "__lt__", "<=": "__le__"}


def where_all(df: DataFrame, predicates: list[tuple]) -> DataFrame:
    """FL11: source-side ``(field, op, value)`` predicates folded with AND;
    a null comparison excludes the row, as in SQL."""
    cond = None
    for field, op, value in predicates:
        c = getattr(F.col(field), _OPS[op])(F.lit(value))
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def require_row(df: DataFrame, cond: Column, what: str = "row") -> DataFrame:
    """SC20: key lookup that must hit: raises ``ValueError`` when absent."""
    hit = df.where(cond)
    if hit.isEmpty():
        raise ValueError(f"{what} not found")
    return hit
