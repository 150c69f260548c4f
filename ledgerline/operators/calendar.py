"""Calendars and rate fan-out (DT10, DT11, DT12, CD4 / PL20).

Calendars are small generated frames (one row per period) built with
``sequence`` + ``explode`` from one row of bounds; they join to data by
equality, never by a range condition.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTH_END_RATE_TYPE, RATE_TYPES, _lit_date, is_month_end

_STEP = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}


def calendar_from(bounds: DataFrame, lo_col: str, hi_col: str, period: str, name: str = "period_start") -> DataFrame:
    """DT10: one row per day / month / year between two date columns of a
    bounds frame, both ends inclusive; month and year steps snap to the
    first day of the period."""
    unit = {"day": "day", "month": "month", "year": "year"}[period]
    lo = F.date_trunc(unit, F.col(lo_col)).cast("date")
    hi = F.date_trunc(unit, F.col(hi_col)).cast("date")
    return bounds.select(F.explode(F.sequence(lo, hi, F.expr(_STEP[period]))).alias(name))


def period_calendar(spark: SparkSession, start, end, period: str, name: str = "period_start") -> DataFrame:
    """DT10: calendar between two literal dates."""
    if _as_date(end) < _as_date(start):
        return spark.createDataFrame([], f"{name} date")
    b = spark.range(1).select(_lit_date(start).alias("lo"), _lit_date(end).alias("hi"))
    return calendar_from(b, "lo", "hi", period, name)


def day_pairs(spark: SparkSession, start, end) -> DataFrame:
    """DT11: ``[d, d + 1)`` day pairs covering the half-open range
    ``[start, end)``."""
    s, e = _as_date(start), _as_date(end)
    if e <= s:  # literal bounds are folded by the optimizer: decide emptiness here
        return spark.createDataFrame([], "day_start date, day_end date")
    b = spark.range(1).select(_lit_date(s).alias("lo"), F.date_sub(_lit_date(e), 1).alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day_start"))
    return days.withColumn("day_end", F.date_add("day_start", 1))


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)[:10])


def rate_types(date_col: Column, leap_aware: bool = False) -> Column:
    """CD4: the rate types one daily rate is written as: every base type,
    plus the closing type on month-end days (DT12)."""
    entries = [F.struct(F.lit(t).alias("rate_type"), F.lit(True).alias("keep")) for t in RATE_TYPES]
    entries.append(F.struct(F.lit(MONTH_END_RATE_TYPE).alias("rate_type"),
                            is_month_end(date_col, leap_aware).alias("keep")))
    return F.transform(F.filter(F.array(*entries), lambda x: x["keep"]), lambda x: x["rate_type"])


def rate_fanout(rates: DataFrame, date_col: str, leap_aware: bool = False) -> DataFrame:
    """CD4/PL20: one row per (rate, rate type)."""
    return rates.withColumn("rate_type", F.explode(rate_types(F.col(date_col), leap_aware)))
