"""Line -> header rollups and group summaries (AG1-AG9, AG11-AG15, AG18-AG20).

All of them are ``groupBy().agg()``: Spark plans a partial aggregate before
the shuffle and a final one after it, so a hot key is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listagg_by_value(c, sep: str = ", ") -> Column:
    """AG3: ``LISTAGG(NULLIF(c, ''), sep) WITHIN GROUP (ORDER BY c)``.

    The reference orders by the group key, which leaves the order undefined;
    ordering by the value makes the text deterministic.
    """
    v = F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.array_join(F.array_sort(F.collect_list(v)), sep)


def rollup_lines(lines: DataFrame, keys: list[str], max_cols=(), sum_cols=(),
                 left_max_cols: dict | None = None, list_cols=(), count_name: str | None = None,
                 sum_round: int | None = None) -> DataFrame:
    """AG1/AG2: one row per header key.

    ``max_cols``   carried attributes, ``MAX`` (same name)
    ``sum_cols``   measures, ``SUM`` (same name; rounded when ``sum_round``)
    ``left_max_cols`` ``{col: n}`` -> ``LEFT(MAX(col), n)`` (ST8)
    ``list_cols``  ``LISTAGG`` of non-blank values ordered by value (AG3)
    ``count_name`` adds ``COUNT(*)`` under that name
    """
    aggs = [F.max(c).alias(c) for c in max_cols]
    for c in sum_cols:
        s = F.sum(c)
        aggs.append((F.round(s, sum_round) if sum_round is not None else s).alias(c))
    for c, n in (left_max_cols or {}).items():
        aggs.append(F.left(F.max(c).cast("string"), F.lit(n)).alias(c))
    for c in list_cols:
        aggs.append(listagg_by_value(c).alias(c))
    if count_name:
        aggs.append(F.count(F.lit(1)).cast("bigint").alias(count_name))
    return lines.groupBy(*keys).agg(*aggs)


def mode_per_group(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """AG8: most frequent value of each column per key; nulls ignored; ties
    -> smallest value; all-null -> null.  Rows with a null key are dropped
    first (as a pandas ``groupby`` does).

    Two combinable steps: the rows of each (key, column, value) are counted,
    then the best count per key is picked; so no task holds all values of a
    key at once.  Values are compared within their own column, by struct
    fields of the columns' types."""
    nonnull = None
    for k in keys:
        cond = F.col(k).isNotNull()
        nonnull = cond if nonnull is None else nonnull & cond
    rows = df.where(nonnull).select(*keys, *cols)
    # one value column for each type that occurs, so columns of one type share it
    kinds = list(dict.fromkeys(df.schema[c].dataType for c in cols))
    slot = {c: kinds.index(df.schema[c].dataType) for c in cols}
    typed = [F.struct(F.lit(i).alias("_i"), *[(F.col(c) if slot[c] == j else F.lit(None).cast(kind)).alias(f"_v{j}")
                                              for j, kind in enumerate(kinds)]) for i, c in enumerate(cols)]
    counted = (rows.select(*keys, F.explode(F.array(*typed)).alias("_x")).select(*keys, "_x.*")
               .groupBy(*keys, "_i", *[f"_v{j}" for j in range(len(kinds))]).agg(F.count(F.lit(1)).alias("_n")))
    picks = []
    for i, c in enumerate(cols):
        value = F.col(f"_v{slot[c]}")
        here = (F.col("_i") == i) & value.isNotNull()
        picks.append(F.min_by(F.when(here, value), F.when(here, F.struct((-F.col("_n")).alias("n"), value.alias("v")))).alias(c))
    return counted.groupBy(*keys).agg(*picks)


def coverage(df: DataFrame, c: str) -> DataFrame:
    """AG20: min and max of a column."""
    return df.agg(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))
