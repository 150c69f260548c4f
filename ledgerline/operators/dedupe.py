"""Dedupe, latest-row and numbering operators (AG7, AG10, DS1-DS3, WN1-WN4, JN6).

Per-key "pick one row" operators are written as aggregates
(``min_by``/``max_by`` over a struct), not as ``row_number`` windows: an
aggregate is combined map-side, so a key holding a third of all rows costs
one partial buffer per task instead of one task sorting the whole group.
Every operator takes an explicit ordering; ties must be broken by the caller
with a unique column, since Spark has no arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import ensure_checkpoint_dir, shared_folder
from .merge import duplicate_keys

__all__ = ["duplicate_keys", "exclude_duplicated", "keep_first", "latest_by",
           "number_within", "not_in"]


def _order_struct(order_by) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*cols)


def keep_first(df: DataFrame, keys: list[str], order_by: list, columns: list[str] | None = None) -> DataFrame:
    """DS2/WN4: one row per key, the smallest ``order_by`` (nulls first, as
    struct ordering puts them).  Partial aggregation keeps it skew-safe."""
    columns = columns or df.columns
    payload = [c for c in columns if c not in keys]
    picked = F.min_by(F.struct(*payload), _order_struct(order_by)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def latest_by(df: DataFrame, keys: list[str], order_by: list, columns: list[str] | None = None) -> DataFrame:
    """WN1/AG10/SO4: one row per key, the largest ``order_by``.  Rows with a
    null order value lose to any non-null one (nulls sort last in ``DESC``)."""
    columns = columns or df.columns
    payload = [c for c in columns if c not in keys]
    picked = F.max_by(F.struct(*payload), _order_struct(order_by)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def not_in(left: DataFrame, left_col: str, values: DataFrame, value_col: str) -> DataFrame:
    """JN6: SQL ``left_col NOT IN (SELECT value_col FROM values)`` with its
    null semantics, as a plain (shuffled, scalable) anti join:

    * a null among ``values`` empties the result;
    * a null ``left_col`` is kept only when ``values`` is empty.

    Spark would plan the null-aware form as a broadcast of ``values``; here
    the distinct value set is computed once and materialised in the shared
    checkpoint folder, the two null facts come from it (one small action)
    and the anti join against it stays a shuffle join, so ``values`` may be
    any size and is never computed twice.
    """
    ensure_checkpoint_dir(values.sparkSession)
    v = values.select(F.col(value_col).alias("_nin_v")).distinct().checkpoint(eager=True)
    facts = v.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_nin_v").isNull()).alias("n_null")).first()
    if facts["n_null"] > 0:
        return left.limit(0)
    v = v.where(F.col("_nin_v").isNotNull())
    out = left.join(v, F.col(left_col) == F.col("_nin_v"), "left_anti")
    if facts["n"] > 0:
        out = out.where(F.col(left_col).isNotNull())
    return out


def exclude_duplicated(df: DataFrame, group_cols: list[str], entity_col: str) -> DataFrame:
    """AG7 + JN6: drop every row whose ``entity_col`` owns a duplicated
    ``group_cols`` group (``entity NOT IN (SELECT entity ... GROUP BY ...
    HAVING COUNT(*) > 1)``)."""
    dups = duplicate_keys(df, group_cols).select(entity_col)
    return not_in(df, entity_col, dups, entity_col)


def number_within(df: DataFrame, partition_cols: list[str], order_cols: list[str],
                  name: str = "line_number", counters: dict | None = None) -> DataFrame:
    """WN2/WN3: ``row_number() OVER (PARTITION BY p ORDER BY o)``.

    ``counters`` maps extra output columns to predicates: each gets the
    running count of rows satisfying its predicate up to this row (null
    where the predicate is false), i.e. the renumbering 1..n of the rows that
    pass a filter (WN3) in the same pass.

    A plain window numbers a whole group inside one task.  Here the rows are
    sorted once by ``(p, o)`` over all tasks, so the sampler spreads a hot group
    over many of them, and written to the shared folder: every later reader,
    and any retried task, sees the same places.  A row's number
    is its index in its partition, less that of the first row its group has
    there, plus the group's rows in the partitions before.  These two come
    from a count table with one row per partition and group, added up by group
    and joined back; Spark broadcasts it where it is small, and where it is
    not, AQE splits a large partition's rows.  The rows themselves are neither
    shuffled again for a window nor sorted again.  A counter's rows are
    numbered the same way among themselves.  ``order_cols`` must be a total
    order within ``p`` for a deterministic result, as for the window.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flags = {c: f"_f_{c}" for c in (counters or {})}
    base = df.withColumns({flags[c]: F.coalesce(pred, F.lit(False)) for c, pred in (counters or {}).items()}) if counters else df
    ordered = base.repartitionByRange(n, *partition_cols, *order_cols).sortWithinPartitions(*partition_cols, *order_cols) \
        .withColumn("_at", F.monotonically_increasing_id())
    if flags:  # the rows that count are numbered in this order, partition by partition
        ensure_checkpoint_dir(spark)
        ordered = ordered.checkpoint()
    else:  # a place says all; a table is written in one pass, a checkpoint in two
        path = shared_folder(spark, "numbered")
        ordered.write.parquet(path)
        ordered = spark.read.schema(ordered.schema).parquet(path)
    out = _numbered(ordered, partition_cols, name, "_at")
    for c, flag in flags.items():
        counted = _numbered(ordered.where(flag).withColumn("_i", F.monotonically_increasing_id()), partition_cols, c, "_i")
        if len(flags) == 1:  # rows that count and rows that do not, each numbered where they are
            rest = _numbered(ordered.where(~F.col(flag)), partition_cols, name, "_at", ordered).withColumn(c, F.lit(None).cast("int"))
            out = _numbered(counted.drop("_i"), partition_cols, name, "_at", ordered).unionByName(rest)
        else:
            out = out.join(counted.select("_at", c), "_at", "left")
    return out.select(*df.columns, name, *flags)


def _numbered(rows: DataFrame, partition_cols: list[str], name: str, at: str, among: DataFrame | None = None) -> DataFrame:
    """rows with ``name``, their number within their group; ``at`` holds partition and index in it,
    counted over ``among`` (the rows themselves by default)."""
    part, index = F.shiftright(at, 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    counts = (rows if among is None else among).groupBy(part.alias("_k_part"), *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(partition_cols)]) \
        .agg(F.min(index).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_k_{i}" for i in range(len(partition_cols))]).orderBy("_k_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_k_part", *[f"_k_{i}" for i in range(len(partition_cols))], (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = part == F.col("_k_part")
    for i, c in enumerate(partition_cols):  # null-safe: a null store is a group too
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{i}"))
    return rows.join(shifts, same).withColumn(name, (index + F.col("_shift") + 1).cast("int")) \
        .drop("_shift", "_k_part", *[f"_k_{i}" for i in range(len(partition_cols))])
