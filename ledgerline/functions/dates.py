"""Date and time expressions (DT1-DT13, FL1-FL4, FL14).

Source timestamps are ``timestamp_ntz``; every helper here is independent of
the session time zone (``convert_timezone`` and ``timestampdiff`` work on NTZ
values directly).  ``asof`` is always an argument, never ``now()``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values that must equal the reference's behaviour.
LOCAL_ZONE = "America/Santiago"
# Month-end days by fixed list: 28 Feb always counts, 29 Feb never does.
MONTH_END_DAYS = ("01-31", "02-28", "03-31", "04-30", "05-31", "06-30",
                  "07-31", "08-31", "09-30", "10-31", "11-30", "12-31")
# Rate types written for every rate, and the extra one on month-end days.
RATE_TYPES = ("Predeterminado", "Tienda")
MONTH_END_RATE_TYPE = "Cierre"


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if isinstance(v, _dt.date):
        return F.lit(v.isoformat()).cast("timestamp_ntz")
    return F.lit(str(v)).cast("timestamp_ntz")


def _lit_date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v.strftime("%Y-%m-%d")).cast("date")
    return F.lit(str(v)[:10]).cast("date")


_FIELDS = [("yyyy", "%04d", F.year), ("SSSSSS", "%06d", None), ("MM", "%02d", F.month), ("dd", "%02d", F.dayofmonth),
           ("HH", "%02d", F.hour), ("mm", "%02d", F.minute), ("ss", "%02d", F.second)]


def ntz_format(c, pattern: str) -> Column:
    """Text of an NTZ timestamp (or date) from its own wall-clock fields.

    ``date_format`` renders through the session time zone, which moves a
    wall time that does not exist locally (a DST gap at midnight) by an
    hour; reading the fields of the NTZ value does not.  Supports the
    tokens ``yyyy MM dd HH mm ss SSSSSS`` and ``'quoted'`` literals.
    """
    c = as_col(c)
    fmt, args, i = "", [], 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            fmt += pattern[i + 1:j].replace("%", "%%")
            i = j + 1
            continue
        for tok, spec, fn in _FIELDS:
            if pattern.startswith(tok, i):
                fmt += spec
                args.append(F.pmod(ts_micros(c.cast("timestamp_ntz")), F.lit(1_000_000)) if fn is None else fn(c))
                i += len(tok)
                break
        else:
            fmt += pattern[i].replace("%", "%%")
            i += 1
    return F.when(c.isNotNull(), F.format_string(fmt, *args))


def ts_text(c) -> Column:
    """DT1: timestamp -> ``yyyy-MM-dd HH:mm:ss`` (exports only)."""
    return ntz_format(c, "yyyy-MM-dd HH:mm:ss")


def day_of(c) -> Column:
    """DT2: timestamp -> date."""
    return F.to_date(as_col(c))


def safe_timestamp(c, fmt: str | None = None) -> Column:
    """DT3: text -> wall-clock (NTZ) timestamp, unparsable -> null.

    Without a pattern this is a safe cast (ISO dates and date-times, a
    trailing ``Z`` kept as written); with a date-only pattern the text is
    parsed as a date; otherwise a valid text is parsed straight to NTZ.  None
    of the forms goes through the session time zone.
    """
    c = as_col(c).cast("string")
    if not fmt:
        return c.try_cast("timestamp_ntz")
    if not any(t in fmt for t in ("H", "h", "m", "s")):
        return F.try_to_date(c, fmt).cast("timestamp_ntz")
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def parse_day_first(c) -> Column:
    """DT4: ``dd/MM/yyyy`` or ISO text -> timestamp; anything else -> null
    (the caller routes those rows to a rejects frame)."""
    c = as_col(c).cast("string")
    return F.coalesce(F.try_to_date(c, "dd/MM/yyyy").cast("timestamp_ntz"), c.try_cast("timestamp_ntz"))


def date_from_prefix(c) -> Column:
    """DT5: first 10 characters -> date, null when not a date."""
    return F.left(as_col(c).cast("string"), F.lit(10)).try_cast("date")


def utc_to_local(c, zone: str = LOCAL_ZONE) -> Column:
    """DT6: UTC wall time -> local wall time (NTZ in, NTZ out)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(c))


def local_to_utc(c, zone: str = LOCAL_ZONE) -> Column:
    """DT6: local wall time -> UTC wall time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_col(c))


def iso_utc_text(c) -> Column:
    """DT6: UTC wall time as ISO text with offset ``+00:00``."""
    return F.concat(ntz_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def ts_micros(c) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (zone-free), for
    numeric ordering tricks such as "latest first" inside ``min_by``."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), as_col(c))


def whole_days(asof, c) -> Column:
    """DT8: age in whole 24-hour periods, ``(asof - c).days`` (floor), not a
    calendar-day difference."""
    secs = F.timestamp_diff("SECOND", as_col(c), _lit_ts(asof))
    return F.floor(secs / F.lit(86400)).cast("bigint")


def iso_week_label(c) -> Column:
    """DT9: ``W{iso week}``."""
    return F.concat(F.lit("W"), F.weekofyear(as_col(c)).cast("string"))


def period_bounds(day, period: str):
    """FL1 helper: half-open ``[start, end)`` of the day / month / year holding
    ``day``, as Python dates (so the predicate stays a plain range that Parquet
    statistics and partition pruning can use)."""
    d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day)[:10])
    if isinstance(d, _dt.datetime):
        d = d.date()
    if period == "day":
        return d, d + _dt.timedelta(days=1)
    if period == "month":
        start = d.replace(day=1)
        end = (start.replace(year=start.year + 1, month=1) if start.month == 12
               else start.replace(month=start.month + 1))
        return start, end
    if period == "year":
        return d.replace(month=1, day=1), _dt.date(d.year + 1, 1, 1)
    raise ValueError(f"unknown period {period!r}")


def period_filter(c, day, period: str) -> Column:
    """FL1: rows whose timestamp falls in the day / month / year of ``day``.

    Written as a half-open range on the raw column rather than
    ``year(c) = y``, so it is pushed to the scan.
    """
    start, end = period_bounds(day, period)
    c = as_col(c)
    return (c >= _lit_ts(start)) & (c < _lit_ts(end))


def lookback_filter(c, asof, days: int, midnight: bool = False) -> Column:
    """FL2: ``c >= asof - days``; ``midnight`` truncates the bound to the day."""
    bound = _lit_ts(asof) - F.make_dt_interval(F.lit(days))
    if midnight:
        bound = F.date_trunc("day", bound).cast("timestamp_ntz")
    return as_col(c) >= bound


def between_days(c, start, end) -> Column:
    """FL3: inclusive day range on the date part of ``c``."""
    return F.to_date(as_col(c)).between(_lit_date(start), _lit_date(end))


def is_month_end(c, leap_aware: bool = False) -> Column:
    """DT12: month-end day.  Default is the fixed list (28 Feb always, 29 Feb
    never); ``leap_aware`` uses the calendar instead."""
    d = as_col(c).cast("date")
    if leap_aware:
        return d == F.last_day(d)
    return ntz_format(d, "MM-dd").isin(*MONTH_END_DAYS)


def resolve_range(start=None, end=None, lookback_days: int = 1, today=None):
    """FL14: resolve optional start / end arguments to an inclusive date pair.

    both given -> as is; start only -> start..today; end only -> the
    ``lookback_days`` days ending at end; neither -> the ``lookback_days``
    days ending today.  Driver-side argument handling only.
    """
    today = today or _dt.date.today()
    as_d = lambda v: v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)[:10])
    if start and end:
        s, e = as_d(start), as_d(end)
    elif start:
        s, e = as_d(start), today
    elif end:
        e = as_d(end)
        s = e - _dt.timedelta(days=lookback_days)
    else:
        e = today
        s = e - _dt.timedelta(days=lookback_days)
    if s > e:
        raise ValueError("start date after end date")
    return s, e
