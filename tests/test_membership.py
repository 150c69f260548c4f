"""Bit-map membership filter, and documents in pages of a bounded size."""

from pyspark.sql import functions as F

from ledgerline.operators.membership import maybe_member
from ledgerline.sources.documents import in_pages

from .conftest import rows


def test_members_are_always_hit_and_columns_stay(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("_bucket"), F.lit("x").alias("_BITS")).union(spark.createDataFrame([(None, 2, "y")], "k long, b int, c string"))
    keys = spark.range(0, 2000, 7).toDF("_bucket").union(spark.createDataFrame([(None,)], "k long"))
    got = maybe_member(df, "k", keys, "hit")
    assert got.columns == ["k", "_bucket", "_BITS", "hit"]
    hit = {r["k"] for r in got.where("hit").collect()}
    assert {None, *range(0, 2000, 7)} <= hit and len(hit) < 320
    assert rows(got.drop("hit")) == rows(df)
    assert maybe_member(df, "k", keys.limit(0), "hit").where("hit").count() == 0


def test_pages_are_bounded_and_in_order(spark):
    df = spark.createDataFrame([("hot", i) for i in range(23)] + [("cold", 1), (None, 2)], "g string, o int")
    got = in_pages(df, ["g"], F.struct("o"), ["o"], 5)
    pages = {(r["g"], r["page"]): [x["o"] for x in r["value"]] for r in got.collect()}
    assert pages == {("hot", p): list(range(5 * p, min(23, 5 * p + 5))) for p in range(5)} | {("cold", 0): [1], (None, 0): [2]}
