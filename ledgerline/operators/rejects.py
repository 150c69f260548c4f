"""Declared schemas checked row by row: typed rows, and every bad value with its reason (UD5, Q14, FL12).

A source's columns are declared once; the declaration gives one projection
that types every column and lists what is wrong in the row.  Rows without
errors are valid; each error of the others becomes a row (key, column, raw
text, reason).  Nothing raises and nothing is dropped in silence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import safe_timestamp
from ..session import ensure_checkpoint_dir
from .conform import spark_type

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE = r"^[+-]?[0-9]+$"
YES, NO = ("yes", "true", "1"), ("no", "false", "0")
ERRORS = "_errors"

MISSING, NOT_NUMBER, NOT_WHOLE, OUT_OF_RANGE, NOT_DATE, NOT_FLAG, TOO_LONG = (
    "missing", "not a number", "not a whole number", "out of range", "not a date", "not a flag", "too long")


@dataclass(frozen=True)
class Declared:
    """One column of a source: its name, warehouse type, source column (its name by default), whether it must have a
    value, and for dates the patterns tried in order (ISO by default)."""

    name: str
    sql_type: str
    source: str | None = None
    required: bool = False
    formats: tuple[str, ...] = ()

    def checked(self) -> tuple[Column, Column]:
        """(typed value, reason or null) of the raw text; a blank text is no value."""
        kind = spark_type(self.sql_type)
        raw = F.col(f"`{self.source or self.name}`").cast("string")
        text = F.nullif(F.trim(raw), F.lit(""))
        if kind in ("date", "timestamp_ntz"):
            value = F.coalesce(*[safe_timestamp(text, f) for f in self.formats or (None,)]).cast(kind)
            bad = F.when(value.isNull(), F.lit(NOT_DATE))
        elif kind == "boolean":
            low = F.lower(text)
            value = F.when(low.isin(*YES), F.lit(True)).when(low.isin(*NO), F.lit(False))
            bad = F.when(value.isNull(), F.lit(NOT_FLAG))
        elif kind.startswith("string") or kind.startswith("varchar"):
            value = raw
            limit = self.sql_type.partition("(")[2].rstrip(") ")
            bad = F.when(F.length(raw) > int(limit), F.lit(TOO_LONG)) if limit else F.lit(None).cast("string")
            text = raw
        else:
            whole = kind in ("int", "bigint", "smallint", "tinyint") or kind.endswith(",0)")
            good, number = text.rlike(WHOLE if whole else NUMBER), text.try_cast(kind)  # a whole number is a number: one pattern for good texts
            value = F.when(good, number)
            bad = F.when(good, F.when(number.isNull(), F.lit(OUT_OF_RANGE)))
            if whole:
                bad = bad.when(text.rlike(NUMBER), F.lit(NOT_WHOLE))
            bad = bad.otherwise(F.lit(NOT_NUMBER))
        missing = F.lit(MISSING) if self.required else F.lit(None).cast("string")
        empty = text.isNull() if not self.required else F.nullif(F.trim(raw), F.lit("")).isNull()
        reason = F.when(empty, missing).otherwise(bad)
        return F.when(reason.isNull(), value).alias(self.name), reason


def checked(df: DataFrame, columns: list[Declared], keep: list[str] | None = None) -> DataFrame:
    """One projection: the declared columns typed (null where bad), ``keep`` as it is, and the errors of the row.

    A declared column that the source lacks is null: missing where required.
    """
    have = {c.upper(): c for c in df.columns}
    typed, errors, seen = [], [], df
    for d in columns:
        source = d.source or d.name
        if source.upper() not in have:
            seen = seen.withColumn(source, F.lit(None).cast("string"))
        value, reason = d.checked()
        typed.append(value)
        raw = F.col(f"`{source}`").cast("string")
        errors.append(F.when(reason.isNotNull(), F.struct(F.lit(d.name).alias("column"), raw.alias("raw"), reason.alias("reason"))))
    return seen.select(*(keep or []), *typed, F.filter(F.array(*errors), lambda e: e.isNotNull()).alias(ERRORS))


def split_rejects(df: DataFrame, columns: list[Declared], keys: list[str], store: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects): the typed rows without errors, and (keys, column, raw, reason) of every bad value.

    ``keys`` name source columns that identify the row; they are kept as they
    came, also where their own declared value is bad.  The source is read
    and checked once: the checked rows are written to the shared checkpoint
    folder, and both results read them there.  Where only one result is used,
    ``store=False`` saves that copy of the source: each result then reads the source itself.
    """
    key_cols = [F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)]
    rows = checked(df.select("*", *key_cols), columns, [f"_key_{i}" for i in range(len(keys))])
    if store:
        ensure_checkpoint_dir(df.sparkSession)
        rows = rows.checkpoint()
    valid = rows.where(F.size(ERRORS) == 0).select(*[d.name for d in columns])
    # the outer generator has nothing to filter on below it, so a row is checked once
    bad = rows.select(*[F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)], F.explode_outer(ERRORS).alias("_e")).where("_e IS NOT NULL")
    return valid, bad.select(*keys, "_e.column", "_e.raw", "_e.reason")
