"""Filters by membership in a table of keys without shuffling the rows that are filtered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 4 MB at most, whatever the number of keys; a wrong hit only costs time.
MAP_BITS = 1 << 25


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _bit(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(MAP_BITS)) + 1


def maybe_member(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """df with ``flag`` (a name it lacks): may the row's column be among keys (a frame of one column)?

    True for every row whose value is among them, and for few others while
    the map is sparse; null is a value like others.  A bit map over the
    hashed keys, of MAP_BITS / 8 bytes at most, is broadcast.
    """
    bucket, bits = fresh_name(df, "_bucket"), fresh_name(df, "_bits")
    map_ = (keys.select(_bit(F.col(f"`{keys.columns[0]}`")).alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias(bucket))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias(bits)))
    at = F.bitmap_bit_position(_bit(F.col(f"`{column}`")))
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at % 8 + 1).cast("int"))) != 0
    joined = df.withColumn(bucket, F.bitmap_bucket_number(_bit(F.col(f"`{column}`")))).join(F.broadcast(map_), bucket, "left")
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(bucket, bits)
