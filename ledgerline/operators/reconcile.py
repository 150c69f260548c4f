"""Cross-system reconciliation (JN1-JN5, AG6, AG16, AG17, DT8).

Anti joins are written as ``left_anti`` (Catalyst does not turn
``LEFT JOIN ... WHERE r.k IS NULL`` into one), with any right-side predicate
applied to the right input before the join, which is what an ``ON`` clause
predicate means.  Both sides shuffle on the key; the right side is reduced to
its distinct keys first so a key repeated on many right rows costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import whole_days


def missing_in(left: DataFrame, right: DataFrame, left_key, right_key,
               right_where: Column | None = None) -> DataFrame:
    """JN1/JN2/JN5: left rows with no right row whose key matches (and that
    passes ``right_where``).  ``left_key`` may be a computed Column."""
    r = right.where(right_where) if right_where is not None else right
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    rk = F.col(right_key) if isinstance(right_key, str) else right_key
    keys = r.select(rk.alias("_rk")).where(F.col("_rk").isNotNull()).distinct()
    return left.join(keys, lk == F.col("_rk"), "left_anti")


def quantity_mismatch(a: DataFrame, a_keys: list[str], a_key_join, a_qty: Column,
                      b: DataFrame, b_key, b_qty: Column,
                      a_name: str = "qty_a", b_name: str = "qty_b") -> DataFrame:
    """JN3/JN4/AG6: aggregate each side by its key first, then join and keep
    rows whose totals differ.  ``!=`` rejects nulls, so an unmatched key
    never appears (the left join is effectively inner).  ``a_key_join`` and
    ``b_key`` are the join expressions (e.g. a safe numeric cast of text)."""
    sa = a.groupBy(*a_keys).agg(F.sum(a_qty).alias(a_name))
    bk = F.col(b_key) if isinstance(b_key, str) else b_key
    sb = b.groupBy(bk.alias("_bk")).agg(F.sum(b_qty).alias(b_name))
    ak = F.col(a_key_join) if isinstance(a_key_join, str) else a_key_join
    return sa.join(sb, ak == F.col("_bk"), "inner").where(F.col(a_name) != F.col(b_name))


def alert(reports: dict, asof, max_days: int, min_rows: int) -> DataFrame:
    """AG17: one-row alert over several reports.

    ``reports`` maps a name to ``(DataFrame, timestamp column)``.  The alert
    is raised when any report has a row older than ``max_days`` whole days
    or at least ``min_rows`` rows.  The reports are stacked (name, time) and
    reduced by one global aggregate with per-report conditional counts, so
    there is no join at all and the work is one partial aggregate per task.
    """
    parts = [df.select(F.lit(name).alias("_report"), F.col(ts).alias("_ts")) for name, (df, ts) in reports.items()]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    older = whole_days(asof, F.col("_ts")) > F.lit(max_days)
    aggs = []
    for name in reports:
        mine = F.col("_report") == name
        aggs.append(F.count_if(mine).cast("bigint").alias(f"{name}_count"))
        aggs.append(F.coalesce(F.bool_or(mine & older), F.lit(False)).alias(f"{name}_older"))
    out = stacked.agg(*aggs)
    cond = None
    for name in reports:
        c = F.col(f"{name}_older") | (F.col(f"{name}_count") >= F.lit(min_rows))
        cond = c if cond is None else cond | c
    return out.withColumn("alert", cond)
