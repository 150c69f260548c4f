"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that occurs in a link; root is the smallest node of its component.

    Each step re-hangs a node's neighbours under its smallest neighbour; a
    component of diameter d becomes a star in about log d rounds.  A hub's
    smallest neighbour is a map-side combined minimum and the links themselves
    are joined on the hub (a join that adaptive execution splits), so no node's
    neighbours are gathered.  Every round is checkpointed.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    seen = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # larger neighbours move under the smallest neighbour (or the node itself)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = large.checkpoint()
        # smaller neighbours and the node itself move under the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = moved.union(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
