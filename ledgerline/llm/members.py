"""Rows by membership of their id in a table of ids, without shuffling the other rows.

Rows that miss the bit map of the ids (:mod:`ledgerline.operators.membership`)
are certainly no members; only the few that hit it are joined.  When the map
fills up (very many ids) more rows are joined, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.operators.membership import fresh_name, maybe_member


def maybe_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose column may be among ids: all that are, few others while the map is sparse."""
    hit = fresh_name(df, "_hit")
    return maybe_member(df, column, ids, hit).where(f"`{hit}`").drop(hit)


def split(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose column is not among ids, rows whose column is); null is a value like others.

    All columns come back as they were, whatever their names.  df and ids are
    read more than once: give tables or checkpointed frames.
    """
    hit, id_ = fresh_name(df, "_hit"), fresh_name(df, "_id")
    marked = maybe_member(df, column, ids, hit)
    near = marked.where(f"`{hit}`").drop(hit)
    given = ids.toDF(id_).distinct()
    same = near[f"`{column}`"].eqNullSafe(given[id_])
    return marked.where(f"NOT `{hit}`").drop(hit).union(near.join(given, same, "left_anti")), near.join(given, same, "left_semi")
