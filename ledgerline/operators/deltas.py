"""Rollups kept up to date by signed differences (SM4, AG1, AG2).

A changed line adds its new values to its header and takes its old ones away.
COUNT and SUM follow from the differences alone.  A MAX needs the header's lines
again only where the line that held it was withdrawn and no new one reaches it.
Sums must be of whole numbers or decimals: differences of doubles would drift.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


@dataclass(frozen=True)
class Rollup:
    """What a header carries of its lines: COUNT(*), SUMs (null over nulls alone) and MAXes."""

    header: str
    sums: tuple[str, ...] = ()
    maxes: tuple[str, ...] = ()
    count: str = "n_lines"

    def known(self, column: str) -> str:
        """The hidden count of non-null values that a SUM is over."""
        return f"_known_{column}"

    def whole(self, lines: DataFrame) -> DataFrame:
        """The rollup of all lines, as the first load makes it."""
        return (lines.groupBy(self.header)
                .agg(F.count(F.lit(1)).alias(self.count), *[F.sum(c).alias(c) for c in self.sums],
                     *[F.count(c).alias(self.known(c)) for c in self.sums], *[F.max(c).alias(c) for c in self.maxes]))


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Lines that went (-1) and lines that came (1); an unchanged line is both and adds up to nothing."""
    return before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)), allowMissingColumns=True)


def header_deltas(lines: DataFrame, r: Rollup) -> DataFrame:
    """One row a header: differences of count and sums, the greatest value that went and the greatest that came.

    One aggregate, combined before the shuffle, so a header with a third of
    all changes is one partial row a task.
    """
    sign = F.col(SIGN)
    aggs = [F.sum(sign).alias("d_count")]
    for c in r.sums:
        aggs += [F.sum(F.coalesce(F.col(c), F.lit(0)) * sign).alias(f"d_{c}"), F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"d{r.known(c)}")]
    for c in r.maxes:
        aggs += [F.max(F.when(sign < 0, F.col(c))).alias(f"gone_{c}"), F.max(F.when(sign > 0, F.col(c))).alias(f"came_{c}")]
    return lines.groupBy(r.header).agg(*aggs)


def apply_deltas(stored: DataFrame, deltas: DataFrame, r: Rollup, maxes_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored headers with the differences applied; headers without lines left go.

    ``maxes_of`` (headers) returns those headers' MAXes from their lines; it is
    called once, with the headers whose maximum was withdrawn, if there are any.
    ``stored`` and ``deltas`` have one row a header (its key not null).
    """
    types = {f.name: f.dataType for f in stored.schema.fields}
    s = stored.select(*[F.col(c).alias(f"s_{c}") for c in stored.columns])
    j = s.join(deltas, F.col(f"s_{r.header}") == F.col(r.header), "full_outer")
    changed = F.col("d_count").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = [F.coalesce(f"s_{r.header}", r.header).alias(r.header), (zero(f"s_{r.count}") + zero("d_count")).alias(r.count)]
    for c in r.sums:
        known = zero(f"s_{r.known(c)}") + zero(f"d{r.known(c)}")
        out += [F.when(known > 0, zero(f"s_{c}") + zero(f"d_{c}")).cast(types[c]).alias(c), known.alias(r.known(c))]
    again = F.lit(False)
    for c in r.maxes:
        held, gone, came = F.col(f"s_{c}"), F.col(f"gone_{c}"), F.col(f"came_{c}")
        again = again | F.coalesce((gone == held) & (came.isNull() | (came < held)), F.lit(False))
        out.append(F.greatest(held, came).alias(c))
    merged = j.select(*out, (changed & again).alias("_again")).where(F.col(r.count) > 0).checkpoint()
    withdrawn = merged.where("_again").select(r.header)
    merged = merged.drop("_again")
    if r.maxes and not withdrawn.isEmpty():
        found = maxes_of(withdrawn).select(F.col(r.header).alias("_h"), *[F.col(c).alias(f"again_{c}") for c in r.maxes])
        at = F.col("_h").isNotNull()
        merged = merged.join(found, F.col(r.header) == F.col("_h"), "left") \
            .withColumns({c: F.when(at, F.col(f"again_{c}")).otherwise(F.col(c)) for c in r.maxes})
    return merged.select(*stored.columns)
