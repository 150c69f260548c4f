"""A history of captures kept as intervals of validity (SK7, SM5).

A capture is the whole state of a source at one time.  Instead of a full copy
per capture, the history holds one row per key and unchanged stretch of time:
``valid_from`` is the first capture that showed the row so, ``valid_to`` the
first one that no longer did (null: it still holds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import _lit_ts, ntz_format
from ..session import ensure_checkpoint_dir
from ..sources.parts import PART, Change, PartTable, Version

FROM, TO = "valid_from", "valid_to"
#: Parts with intervals that still hold, by key bucket, and ended ones, by the day they ended.
HOLDING, ENDED = "open-", "ended-"


def add_capture(table: PartTable, capture: DataFrame, keys: list[str], at, writer: str = "", epoch: int | None = None) -> Version:
    """Record the whole state ``capture`` of time ``at`` (later than any before; ``ValueError`` otherwise).

    A key that is new or comes back opens an interval; one whose other columns
    differ (nulls are equal to each other) closes the old and opens a new one;
    one that is missing is closed; an unchanged one is not written.  The
    table's parts must follow from ``keys``.  The holding intervals are joined
    with the capture once; only buckets with a change are written again, and
    ended rows are added under the day of ``at``.  Repeated keys are refused;
    rows with a null key part never match, so they end and begin at each capture.
    """
    ensure_checkpoint_dir(table.spark)
    now, columns = _lit_ts(at), capture.columns
    capture = capture.checkpoint()
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    if not capture.where(complete).groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the capture repeats keys {keys}")
    time = capture.sparkSession.range(1).select(ntz_format(now, "yyyy-MM-dd").alias("day"), ntz_format(now, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")).first()

    def change(version: Version | None) -> Change | None:
        if version and version.facts["last"] >= time["at"]:
            raise ValueError(f"there is a capture of {version.facts['last']} already")
        empty = capture.select(*columns, now.alias(FROM), F.lit(None).cast("timestamp_ntz").alias(TO)).limit(0)
        holding = table.read(version, [p for p in version.parts if p.startswith(HOLDING)]) if version else empty
        old = holding.select(F.struct(*holding.columns).alias("o"), *[F.col(k).alias(f"ok{i}") for i, k in enumerate(keys)])
        new = capture.select(F.struct(*columns).alias("n"), *[F.col(k).alias(f"nk{i}") for i, k in enumerate(keys)])
        same_key = F.lit(True)
        for i in range(len(keys)):
            same_key = same_key & (F.col(f"ok{i}") == F.col(f"nk{i}"))
        alike = F.lit(True)
        for c in columns:
            alike = alike & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        both = F.col("o").isNotNull() & F.col("n").isNotNull()
        j = old.join(new, same_key, "full_outer").select("o", "n", (both & alike).alias("kept"))
        part = F.concat(F.lit(HOLDING), table.part)
        begun = [F.when(F.col("kept"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in columns]
        held = j.where("n IS NOT NULL").select(*begun, F.when(F.col("kept"), F.col(f"o.{FROM}")).otherwise(now).alias(FROM),
                                               F.lit(None).cast("timestamp_ntz").alias(TO), "kept").withColumn(PART, part)
        over = j.where("o IS NOT NULL AND NOT kept").select(*[F.col(f"o.{c}").alias(c) for c in columns], F.col(f"o.{FROM}").alias(FROM), now.alias(TO)) \
            .withColumn(PART, part).checkpoint()
        held = held.checkpoint()
        changed = {r[0] for r in over.select(PART).union(held.where("NOT kept").select(PART)).distinct().collect()}  # at most one a bucket
        parts: dict[str, list[str]] = {p: [] for p in changed}
        parts |= table.write(held.where(F.col(PART).isin(sorted(changed))).drop("kept")) if changed else {}
        if not over.isEmpty():
            ended = ENDED + time["day"]
            added = table.write(over.withColumn(PART, F.lit(ended)))
            parts[ended] = [*(version.parts.get(ended, []) if version else []), *added[ended]]
        return Change(parts, empty.schema, facts={"last": time["at"]})

    return table.commit(change, writer, epoch)


def state_at(table: PartTable, at, version: Version | None = None) -> DataFrame | None:
    """The source's state at a time: that of the last capture up to then (no rows before the first one).

    Read are the holding intervals and those that ended on that day or later.
    """
    version = version or table.version()
    if version is None:
        return None
    now = _lit_ts(at)
    day = table.spark.range(1).select(ntz_format(now, "yyyy-MM-dd")).first()[0]
    rows = table.read(version, [p for p in version.parts if p.startswith(HOLDING) or (p.startswith(ENDED) and p[len(ENDED):] >= day)])
    return rows.where((F.col(FROM) <= now) & (F.col(TO).isNull() | (F.col(TO) > now))).drop(FROM, TO)
