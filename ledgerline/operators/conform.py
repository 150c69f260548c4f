"""Schema declaration and conformance (PR10-PR14, SK10).

Target schemas are declared as ``(name, sql_type)`` lists, as in the
reference's config modules; the same list gives the projection and the casts,
all in one ``select``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VARCHAR = re.compile(r"^(VARCHAR|STRING|TEXT)(\(\d+\))?$", re.I)
_NUMBER = re.compile(r"^NUMBER(\((\d+)(,\s*(\d+))?\))?$", re.I)


def spark_type(sql_type: str) -> str:
    """Warehouse column type -> Spark DDL type."""
    t = sql_type.strip().upper()
    if _VARCHAR.match(t):
        return "string"
    m = _NUMBER.match(t)
    if m:
        if m.group(2) is None:
            return "decimal(38,0)"
        return f"decimal({m.group(2)},{m.group(4) or 0})"
    return {
        "FLOAT": "double", "DOUBLE": "double", "INT": "int", "INTEGER": "int",
        "BIGINT": "bigint", "BOOLEAN": "boolean", "DATE": "date",
        "TIMESTAMP": "timestamp_ntz", "TIMESTAMP_NTZ": "timestamp_ntz",
    }.get(t, t.lower())


def upper_names(df: DataFrame) -> DataFrame:
    """PR12: upper-case every column name."""
    return df.toDF(*[c.upper() for c in df.columns])


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """PR10/PR19: rename by mapping; unmapped columns are kept."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def conform(df: DataFrame, columns: list[tuple[str, str]], fill=None,
            safe: bool = True) -> DataFrame:
    """PR13/PR14/SK10: exactly the declared columns, in order, typed.

    Unknown columns are dropped, missing ones added as ``fill`` (null by
    default), and each column is cast to its declared type; ``safe`` uses
    ``try_cast`` so dirty text becomes null instead of failing the job.
    Name matching is case-insensitive.
    """
    have = {c.upper(): c for c in df.columns}
    out = []
    for name, sql_type in columns:
        t = spark_type(sql_type)
        src = have.get(name.upper())
        if src is None:
            c = F.lit(fill).cast(t) if fill is not None else F.lit(None).cast(t)
        else:
            c = F.col(f"`{src}`")
            c = c.try_cast(t) if safe else c.cast(t)
        out.append(c.alias(name))
    return df.select(*out)
