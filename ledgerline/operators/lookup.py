"""Lookups against reference tables (JN15-JN18, MP1, ST18).

The cascading lookup resolves each *distinct* input value once and joins
the answer back by equality, so the per-row cost is one hash join.  Its match
steps are

1. exact name;
2. case-insensitive name;
3. containment either way, through a q-gram index: a text that holds another
   holds all its q-grams, so the other's rarest q-gram finds the few texts
   that may hold it, and only those are compared.  A text of n characters
   has n postings, however many lengths or names there are.

Nothing is a nested-loop join.  The table is first reduced to one row per name
(the first in table order).  Whether a side is broadcast is left to Spark,
which decides by its size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


#: Length of the index's q-grams; shorter texts are looked up whole.
Q = 3


def _grams(c: Column, q: int) -> Column:
    """The substrings of length q, in order."""
    last = F.length(c) - q + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(c, i, F.lit(q)))) \
        .otherwise(F.array().cast("array<string>"))


def contained(needles: DataFrame, needle: str, texts: DataFrame, text: str) -> DataFrame:
    """ST18: (needle, text) of every needle that is a substring of a text.

    Both frames have one row a value (null and empty needles are in nothing).
    The texts' q-grams, and their shorter substrings for needles below Q
    characters, are the postings.  Every q-gram of a needle is counted over
    them: one that occurs nowhere rules the needle out, else the rarest one's
    postings are its candidates, which are then compared as a whole.
    """
    n, t = F.col(needle), F.col(text)
    postings = texts.select(t, F.explode(F.array_distinct(F.concat(*[_grams(t, q) for q in range(1, Q + 1)]))).alias("_g"))
    wanted = needles.where(F.length(n) > 0).select(n, F.array_distinct(F.when(F.length(n) < Q, F.array(n)).otherwise(_grams(n, Q))).alias("_all"))
    counts = postings.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (wanted.select(n, F.size("_all").alias("_size"), F.explode("_all").alias("_g")).join(counts, "_g")
              .groupBy(needle).agg(F.min_by("_g", F.struct("_n", "_g")).alias("_g"), F.count(F.lit(1)).alias("_found"), F.max("_size").alias("_size"))
              .where(F.col("_found") == F.col("_size")).select(needle, "_g"))
    return rarest.join(postings, "_g").where(F.contains(t, n)).select(needle, text)


def cascading_lookup(df: DataFrame, value_col: str, table: DataFrame, name_col: str,
                     payload: list[str], order_col: str, default: dict,
                     out_prefix: str = "match_") -> DataFrame:
    """JN16: add ``payload`` columns (prefixed) found for ``value_col``.

    Order of preference: exact (after trim) -> case-insensitive -> containment
    either way; among several hits the lowest ``order_col`` (table order)
    wins.  No hit -> ``default`` values.  A null or blank value is treated as
    missing and gets the default (see README, quirk Q16).  Adds
    ``{out_prefix}rank`` (1, 2, 3, or null for default).
    """
    tbl = table.select(F.col(name_col).alias("_name"), F.col(order_col).alias("_ord"),
                       *[F.col(p).alias(f"_p_{p}") for p in payload])
    tbl = tbl.withColumn("_lname", F.lower("_name"))
    pcols = [f"_p_{p}" for p in payload]

    def first_of(rows: DataFrame, key: str) -> DataFrame:
        """The first row in table order of each key (combined map-side)."""
        picked = F.min_by(F.struct("_ord", *pcols), F.col("_ord")).alias("_row")
        return rows.groupBy(F.col(key).alias("_k")).agg(picked).select("_k", "_row.*")

    def hits(values: DataFrame, on: str, rows: DataFrame, rank: int) -> DataFrame:
        return values.join(rows, F.col(on) == F.col("_k")).select("_v", F.lit(rank).alias("_rank"), "_ord", *pcols)

    # the distinct values feed every step: computed once and materialised (a small
    # set) in the shared checkpoint folder
    ensure_checkpoint_dir(df.sparkSession)
    vals = (df.select(F.trim(F.col(value_col)).alias("_v")).where(F.col("_v") != "")
            .distinct().withColumn("_lv", F.lower("_v")).checkpoint(eager=True))
    by_lname = first_of(tbl, "_lname")
    exact = hits(vals, "_v", first_of(tbl, "_name"), 1)
    fold = hits(vals, "_lv", by_lname, 2)
    names, folded = by_lname.select("_k"), vals.select("_lv").distinct()
    either = contained(names, "_k", folded, "_lv").unionByName(contained(folded, "_lv", names, "_k"))
    inside = first_of(either.join(by_lname, "_k"), "_lv")
    held = hits(vals, "_lv", inside, 3)

    cands = exact.unionByName(fold).unionByName(held)
    best = (cands.groupBy("_v")
            .agg(F.min_by(F.struct(F.col("_rank"), *[F.col(p) for p in pcols]),
                          F.struct("_rank", "_ord")).alias("_b"))
            .select(F.col("_v").alias("_mv"), "_b.*"))
    out = df.join(best, F.trim(F.col(value_col)) == F.col("_mv"), "left")
    cols = [F.col(c) for c in df.columns]
    for p in payload:
        d = default.get(p)
        cols.append(F.coalesce(F.col(f"_p_{p}"), F.lit(d)).alias(f"{out_prefix}{p}"))
    cols.append(F.col("_rank").alias(f"{out_prefix}rank"))
    return out.select(*cols)


def exact_lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str,
                 payload: list[str], default: dict | None = None) -> DataFrame:
    """JN15/JN18/MP1: left lookup by an (expression) key, with defaults.

    Every row of ``df`` comes back once: of several table rows with one key the
    smallest payload counts (one aggregate over the table)."""
    default = default or {}
    t = (table.select(F.col(table_key).alias("_lk"), *[F.col(p).alias(f"_lp_{p}") for p in payload]).where(F.col("_lk").isNotNull())
         .groupBy("_lk").agg(F.min(F.struct(*[f"_lp_{p}" for p in payload])).alias("_row")).select("_lk", "_row.*"))
    j = df.join(t, key == F.col("_lk"), "left")
    cols = [F.col(c) for c in df.columns]
    for p in payload:
        cols.append(F.coalesce(F.col(f"_lp_{p}"), F.lit(default.get(p))).alias(p)
                    if p in default else F.col(f"_lp_{p}").alias(p))
    return j.select(*cols)
