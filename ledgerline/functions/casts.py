"""Safe casts and null handling (CV1-CV8, NU1-NU5).

ANSI mode is on by default, so plain ``cast`` raises on dirty text; every
coercion the reference makes with "errors -> null" uses a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._util import as_col
from .text import GID_ROOT


def safe_double(c) -> Column:
    """CV1: text -> double; blanks and garbage -> null."""
    return as_col(c).try_cast("double")


def double_or_zero(c) -> Column:
    """CV2: safe numeric, missing or bad -> 0."""
    return F.coalesce(as_col(c).try_cast("double"), F.lit(0.0))


def int_or_zero(c) -> Column:
    """CV3: ``fillna(0).astype(int)``: null -> 0, fractions truncated to zero."""
    return F.coalesce(as_col(c).try_cast("double"), F.lit(0.0)).cast("int")


def flag_from_01(c) -> Column:
    """CV4: 0/1 -> boolean, null -> false."""
    return F.coalesce(as_col(c).try_cast("double"), F.lit(0.0)).cast("int") != 0


def flag_from_yes_no(c) -> Column:
    """CV5: ``Yes`` -> true; ``No``, other or missing -> false."""
    return F.coalesce(as_col(c).cast("string"), F.lit("No")) == "Yes"


def try_number(c, scale: int = 0) -> Column:
    """CV6: ``TRY_TO_NUMBER``: decimal(38, scale) or null."""
    return as_col(c).cast("string").try_cast(f"decimal(38,{scale})")


def numeric_id(c) -> Column:
    """CV7: numeric id or null.  A global id keeps its last segment; any other
    text must be an integer."""
    c = as_col(c).cast("string")
    last = F.element_at(F.split(c, "/"), -1)
    return F.when(c.startswith(GID_ROOT), last.try_cast("bigint")).otherwise(c.try_cast("bigint"))


def zero_if_null(c) -> Column:
    """NU4: ``row.get(q, 0) or 0``."""
    return F.coalesce(as_col(c), F.lit(0))


def leaf_or_blank(c) -> Column:
    """NU2: a nested path is null-safe in Spark; only the leaf gets ''."""
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def truthy(c) -> Column:
    """FL13: not null and not ''."""
    return F.nullif(as_col(c).cast("string"), F.lit("")).isNotNull()


def first_truthy(*cols) -> Column:
    """NU3: first non-null, non-empty value in priority order."""
    return F.coalesce(*[F.nullif(as_col(c).cast("string"), F.lit("")) for c in cols])


def first_truthy_source(named: list) -> Column:
    """NU3: label of the source that won in ``first_truthy``.

    ``named`` is a list of ``(label, column)`` pairs; null when none is truthy.
    """
    expr = None
    for label, c in named:
        cond = truthy(c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def equals_null_safe(c, value) -> Column:
    """NU5: ``state == 'X'`` that is false (never null) on a null state."""
    return as_col(c).eqNullSafe(F.lit(value))


def fill_blank_strings(df: DataFrame, columns=None) -> DataFrame:
    """NU1: string columns -> '' when null (only string columns, Q18)."""
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if columns is not None:
        str_cols = [c for c in str_cols if c in set(columns)]
    return df.fillna("", subset=str_cols) if str_cols else df
