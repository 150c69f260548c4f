"""Keyed upsert and related sinks (SK1-SK13, JN20, AG21).

Parquet has no ``MERGE``, so the upsert computes the *next state* of the
target as a DataFrame: one full outer join of target and batch on the key
(one shuffle of each side, skew split by AQE), then a per-column choice.  The
caller validates it (duplicate guard) and publishes it to a new directory
(:func:`write_version`), never overwriting a path that is being read.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.files import Files
from ..sources.parts import PART, UNMATCHED, Change, PartTable, Version
from ..sources.versions import VersionedTable

CREATED_AT = "created_at"
UPDATED_AT = "updated_at"


def _asof_col(asof) -> Column:
    if isinstance(asof, Column):
        return asof.cast("timestamp_ntz")
    if isinstance(asof, _dt.datetime):
        return F.lit(asof.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(str(asof)).cast("timestamp_ntz")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """SK2/SK3/AG7: key groups occurring more than once, with their count.

    ``GROUP BY`` puts nulls in one group, as the reference's check does.
    Partial aggregation runs map-side, so a hot key costs one counter.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


@dataclass
class UpsertResult:
    """Outcome of :func:`upsert`.

    ``table``   next state of the target (all DataFrames are lazy)
    ``rejected`` duplicate source keys; non-empty means the batch was refused
    ``accepted`` False when the batch was refused (target returned unchanged)
    """

    table: DataFrame
    rejected: DataFrame
    accepted: bool

    def stats(self, asof) -> DataFrame:
        return upsert_stats(self.table, asof)


def merge_next_state(target: DataFrame, source: DataFrame, keys: list[str],
                     columns: list[str] | None = None, asof=None) -> DataFrame:
    """SK1 core: the MERGE as one full outer join.

    matched      -> every listed column from the batch, ``created_at`` kept,
                    ``updated_at`` = asof; target columns that the batch does
                    not list keep their values (null on inserted rows)
    not matched  -> inserted with both audit columns = asof
    target only  -> unchanged
    Keys compare with plain equality, so a key with a null part never matches
    and is inserted again (JN20), as in SQL ``MERGE``.
    """
    columns = list(columns or [c for c in source.columns if c not in (CREATED_AT, UPDATED_AT)])
    now = _asof_col(asof)
    # Rows with a null key part can never match (and would all meet in one
    # hash partition of the join): stored ones pass through, incoming ones
    # are inserted, and only complete keys go through the join.
    complete = None
    for k in keys:
        c = F.col(k).isNotNull()
        complete = c if complete is None else complete & c
    t_cols = set(target.columns)
    extra = [c for c in target.columns if c not in columns and c not in (CREATED_AT, UPDATED_AT)]
    typed = {c: source.schema[c].dataType for c in columns} | {c: target.schema[c].dataType for c in extra}
    t_null = target.where(~complete).select(
        *[(F.col(c) if c in t_cols else F.lit(None).cast(typed[c])).alias(c) for c in columns + extra],
        (F.col(CREATED_AT) if CREATED_AT in t_cols else F.lit(None).cast("timestamp_ntz")).alias(CREATED_AT),
        (F.col(UPDATED_AT) if UPDATED_AT in t_cols else F.lit(None).cast("timestamp_ntz")).alias(UPDATED_AT))
    s_null = source.where(~complete).select(*columns, *[F.lit(None).cast(typed[c]).alias(c) for c in extra], now.alias(CREATED_AT), now.alias(UPDATED_AT))
    target = target.where(complete)
    source = source.where(complete)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns],
                      F.lit(True).alias("hit__t"))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in columns], F.lit(True).alias("hit__s"))
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    hit = F.col("hit__s").isNotNull()
    out = []
    for c in columns:
        tc = F.col(f"t__{c}") if c in target.columns else F.lit(None)
        out.append(F.when(hit, F.col(f"s__{c}")).otherwise(tc).alias(c))
    out += [F.col(f"t__{c}").alias(c) for c in extra]
    t_created = F.col(f"t__{CREATED_AT}") if CREATED_AT in target.columns else F.lit(None).cast("timestamp_ntz")
    t_updated = F.col(f"t__{UPDATED_AT}") if UPDATED_AT in target.columns else F.lit(None).cast("timestamp_ntz")
    matched = hit & F.col("hit__t").isNotNull()
    out.append(F.when(matched, F.coalesce(t_created, now)).when(hit, now)
               .otherwise(t_created).alias(CREATED_AT))
    out.append(F.when(hit, now).otherwise(t_updated).alias(UPDATED_AT))
    return j.select(*out).unionByName(t_null).unionByName(s_null)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], asof,
           columns: list[str] | None = None, on_duplicate: str = "reject") -> UpsertResult:
    """SK1 + SK2 + SK5: keyed upsert with the batch duplicate guard.

    ``on_duplicate='reject'`` refuses the whole batch when the batch repeats
    a key (the target comes back unchanged and ``rejected`` lists the keys);
    ``'raise'`` raises ``ValueError`` instead.  An empty batch is a no-op.
    The guard is one small action (does any duplicate group exist).
    """
    rejected = duplicate_keys(source, keys)
    if source.isEmpty():
        return UpsertResult(target, rejected.limit(0), True)
    if not rejected.isEmpty():
        if on_duplicate == "raise":
            raise ValueError(f"duplicate keys {keys} in the incoming batch")
        return UpsertResult(target, rejected, False)
    return UpsertResult(merge_next_state(target, source, keys, columns, asof), rejected, True)


def upsert_stats(table: DataFrame, asof) -> DataFrame:
    """SK4/AG21: rows created on the asof day; rows updated that day but
    created earlier.  One global aggregate."""
    day = _asof_col(asof).cast("date")
    created = F.to_date(F.col(CREATED_AT)) == day
    updated = (F.to_date(F.col(UPDATED_AT)) == day) & (F.to_date(F.col(CREATED_AT)) != day)
    return table.agg(F.count_if(created).cast("bigint").alias("inserted_rows"),
                     F.count_if(updated).cast("bigint").alias("updated_rows"))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """SK3: raise ``ValueError`` when the candidate state repeats a key;
    returns ``df`` unchanged otherwise (checked before publishing)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate keys {keys} in the result")
    return df


def structure_of(df: DataFrame) -> DataFrame:
    """SK9: empty frame with the same schema (``SELECT * WHERE 1=0``)."""
    return df.limit(0)


def update_from(target: DataFrame, changes: DataFrame, keys: list[str],
                set_cols: list[str]) -> DataFrame:
    """SK11/SK13: ``UPDATE target SET c = changes.c FROM changes WHERE keys
    match``.  One left join; rows without a match keep their values.  A change
    set that repeats a complete key would multiply rows and raises
    ``ValueError`` (one small aggregate over the changes).
    """
    check_unique_nonnull(changes, keys)
    ch = changes.select(*keys, *[F.col(c).alias(f"u__{c}") for c in set_cols],
                        F.lit(True).alias("u__hit"))
    j = target.join(ch, keys, "left")
    hit = F.col("u__hit").isNotNull()
    return j.select(*[F.when(hit, F.col(f"u__{c}")).otherwise(F.col(c)).alias(c)
                      if c in set_cols else F.col(c) for c in target.columns])


def update_where(target: DataFrame, cond: Column, assignments: dict) -> DataFrame:
    """SK12: point update ``SET c = v WHERE cond``."""
    return target.select(*[F.when(cond, F.lit(assignments[c]) if not isinstance(assignments[c], Column)
                                  else assignments[c]).otherwise(F.col(c)).alias(c)
                           if c in assignments else F.col(c) for c in target.columns])


def snapshot_and_history(snapshot: DataFrame, history: DataFrame, capture: DataFrame, keys: list[str],
                         ts_col: str, asof) -> tuple[DataFrame, UpsertResult]:
    """SK7/SM5: append one capture to the history (upsert on key + capture
    time) and rebuild the snapshot from the capture alone (truncate + load).

    Returns ``(snapshot, result)``: ``result.table`` is the next history.  A
    capture that repeats a key is refused: ``result.accepted`` is False,
    ``result.rejected`` lists the keys, and snapshot and history come back as
    they were.  Cache ``capture`` when both are written.
    """
    result = upsert(history, capture, keys + [ts_col], asof, on_duplicate="reject")
    return (capture if result.accepted else snapshot), result


def write_version(df: DataFrame, base_path: str, version: int,
                  partition_by: list[str] | None = None) -> str:
    """SK6/SK8: publish a table state as version ``version`` of
    :class:`VersionedTable` ``base_path`` (staged full refresh).  A version
    path is private until it is complete, so a retried job overwrites what a
    failed attempt left behind."""
    return VersionedTable(df.sparkSession, base_path).publish(df, version, partition_by)


def export_csv(df: DataFrame, path: str, order_by: list | None = None, sep: str = ";") -> None:
    """SK14: ``;``-separated CSV with a header, rows sorted first."""
    if order_by:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def export_csv_file(df: DataFrame, path: str, order_by: list, sep: str = ";", bom: bool = True) -> str:
    """SK14: one ``sep``-separated file, rows in order, a byte order mark and one header.

    The rows are sorted over all tasks and written as parts without a header
    beside the file; the parts' bytes are then joined in order
    (:meth:`Files.join`), so no row passes through the driver and no task
    writes more than its part.  Text with separators, quotes or line breaks is
    quoted, quotes are doubled; null and empty text are empty.
    """
    files, folder = Files(df.sparkSession), f"{path}._parts-{uuid.uuid4().hex}"
    exact = {"sep": sep, "header": False, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.orderBy(*order_by).write.options(**exact).csv(folder)
    quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in (sep, '"', "\n", "\r")) else c for c in df.columns]
    parts = [f"{folder}/{n}" for n in files.names(folder) if n.startswith("part-")]  # named in the order of the sort
    files.join(parts, path, (b"\xef\xbb\xbf" if bom else b"") + (sep.join(quoted) + "\n").encode())
    files.delete(folder)
    return path


def empty_target(batch: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The state before the first load: no rows, the batch's columns and the audit columns."""
    cols = columns or [c for c in batch.columns if c not in (CREATED_AT, UPDATED_AT)]
    stamps = [F.lit(None).cast("timestamp_ntz").alias(c) for c in (CREATED_AT, UPDATED_AT)]
    return batch.select(*cols, *stamps).limit(0)


def upsert_table(spark, base_path: str, batch: DataFrame, keys: list[str], asof,
                 columns: list[str] | None = None, on_duplicate: str = "reject",
                 partition_by: list[str] | None = None):
    """SK1-SK5 end to end, the counterpart of the reference's single writer
    every load calls: read the newest complete version of the table under
    ``base_path`` (none yet -> empty), refuse a batch that repeats a key,
    merge, check the result is key-unique (SK3, ``ValueError`` otherwise),
    publish it as the next version and return ``(version, stats)`` where
    ``stats`` is the one-row inserted / updated count (SK4).  An empty batch
    publishes nothing and returns ``(None, None)`` (SK5); a refused batch
    returns ``(None, rejected_keys)``.  ``partition_by`` lays the version
    out in directories (e.g. by day) so readers prune them.

    Each load rewrites the whole table; :func:`upsert_parts` rewrites only the
    parts its batch touches.  Of two loads at a time the second merges again
    into what the first published (:meth:`VersionedTable.commit`).  The batch is
    computed once, the merge once, and the result is checked before it is
    published, where it is read by the check and by the write.
    """
    ensure_checkpoint_dir(spark)
    batch = batch.checkpoint()
    rejected = _refused(batch, keys, on_duplicate)
    if rejected is None or not rejected.isEmpty():
        return None, rejected
    table = VersionedTable(spark, base_path)

    def next_state(current: DataFrame | None) -> DataFrame:
        target = empty_target(batch, columns) if current is None else current
        return check_unique_nonnull(merge_next_state(target, batch, keys, columns, asof).checkpoint(), keys)

    version = table.commit(next_state, partition_by, first=1)
    return version, upsert_stats(table.read(version), asof)


def _refused(batch: DataFrame, keys: list[str], on_duplicate: str) -> DataFrame | None:
    """None for an empty batch, else its repeated keys (none: the batch is good); raises if asked to."""
    if batch.isEmpty():
        return None
    rejected = duplicate_keys(batch, keys)
    if on_duplicate == "raise" and not rejected.isEmpty():
        raise ValueError(f"duplicate keys {keys} in the incoming batch")
    return rejected


def upsert_parts(table: PartTable, batch: DataFrame, keys: list[str], asof, columns: list[str] | None = None,
                 on_duplicate: str = "reject", writer: str = "", epoch: int | None = None):
    """SK1-SK5 on a table of parts: only the parts that hold a key of the batch are read and written.

    Same rules and results as :func:`upsert_table`, but for columns that are
    stored already the batch takes the stored types, and the counts are of the
    rows this load inserted and updated, in the parts it wrote.  ``writer`` and
    ``epoch``: see :meth:`PartTable.commit`.
    """
    ensure_checkpoint_dir(table.spark)
    batch = batch.checkpoint()
    rejected = _refused(batch, keys, on_duplicate)
    if rejected is None or not rejected.isEmpty():
        return None, rejected
    version = merge_into_parts(table, batch, keys, lambda current, rows: merge_next_state(current, rows, keys, columns, asof),
                               empty_target(batch, columns), writer, epoch)
    return version.number, load_stats(table.read(version, table.changed_parts(version)), asof)


def load_stats(rows: DataFrame, asof) -> DataFrame:
    """SK4: how many of the rows the load of exactly this time inserted, and how many it updated."""
    now = _asof_col(asof)
    created = F.col(CREATED_AT) == now
    return rows.agg(F.count_if(created).cast("bigint").alias("inserted_rows"),
                    F.count_if((F.col(UPDATED_AT) == now) & ~F.coalesce(created, F.lit(False))).cast("bigint").alias("updated_rows"))


def merge_into_parts(table: PartTable, batch: DataFrame, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
                     empty: DataFrame, writer: str = "", epoch: int | None = None) -> Version:
    """Publish ``merge(stored rows, batch)`` for the parts the batch touches; the others are carried over unread.

    The table's parts must follow from ``keys``, so that a stored row and its
    update meet in one part.  Rows with a null key part match nothing and are
    added to a part of their own.  ``empty`` is the state before the first load;
    ``batch`` is read several times (a table or checkpointed).  One aggregate
    names the touched parts (at most as many as the table has).  The merged rows
    are written where no reader looks, and their keys are checked there (SK3)
    before the version is published.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()

    def change(version: Version | None) -> Change:
        none = table.read(version, []) if version else empty
        typed = batch.withColumns({c: F.col(c).cast(none.schema[c].dataType) for c in batch.columns if c in none.columns})
        rows, loose = typed.where(complete), typed.where(~complete)
        touched = {r[0] for r in table.with_part(rows).select(PART).distinct().collect()}
        merged = merge(table.read(version, touched) if version else empty, rows)
        written = table.write(table.with_part(merged))
        if written:
            check_unique(table.rows_of(written, merged.schema).select(*keys), keys)
        if not loose.isEmpty():
            added = table.write(merge(none.limit(0), loose).withColumn(PART, F.lit(UNMATCHED)))
            written[UNMATCHED] = [*(version.parts.get(UNMATCHED, []) if version else []), *added[UNMATCHED]]
        return Change(written, merged.schema, reads=touched)

    return table.commit(change, writer, epoch)


def check_unique_nonnull(df: DataFrame, keys: list[str]) -> DataFrame:
    """SK3 on the keys that can match: rows with a null key part never
    match in a merge (JN20) and are allowed to repeat (SURVEY 2.14, decision
    on null keys; :func:`check_unique` also counts nulls as a group)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    if not duplicate_keys(df.where(cond), keys).isEmpty():
        raise ValueError(f"duplicate keys {keys} in the result")
    return df
