"""Incremental loads as Structured Streaming queries (SM1-SM5).

The reference polls the last *d* days on a schedule and merges by key, so
late and repeated records are absorbed by the upsert.  Here that is a file
stream with ``trigger(availableNow=True)``:

* SM2  no row is too late: the merge itself absorbs repeats, so no watermark
       drops anything; where a result has to become final (a day's closing
       rows), a watermark decides when, and rows behind it go to an output
       of their own (``stream_closings``).  ``dedupe_within_lateness`` remains
       for append-only streams, where the loss of later rows is the caller's
       choice;
* SM1/SM3 each micro-batch is merged into the table by key, a row replacing
       the stored one only when its event time is newer (so an old batch can
       never overwrite a newer state, quirk Q6); equal times are ordered by
       the other columns, so any split into batches ends in the same state;
* SM4  a batch's changed keys re-aggregate *all* their lines, or headers
       are kept up to date by signed differences (``stream_delta_rollup``);
* SM5  captures are appended with their capture time (history) and the
       closing row per key and day is a ``max_by``.

Each batch publishes the next table state as a new version directory under
a shared base path (never overwriting what is being read); Spark's commit
protocol makes a version visible only when all its tasks succeeded.  A version
carries the stream's checkpoint and epoch: a replayed batch rewrites its own
version, and a stream with another checkpoint goes on from the newest state.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import ntz_format, ts_micros
from ..operators.dedupe import latest_by
from ..operators.deltas import Rollup, apply_deltas, header_deltas, signed
from ..operators.membership import maybe_member
from ..operators.merge import check_unique, merge_into_parts
from ..operators.rollup import rollup_lines
from ..session import ensure_checkpoint_dir, shared_folder
from ..sources.parts import CAME, CHANGED, GONE, PART, Change, PartTable, Version, bucket_of
from ..sources.versions import VersionedTable


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """SM1: a stream over landed files (a folder or glob) with a fixed schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def dedupe_within_lateness(stream: DataFrame, keys: list[str], ts_col: str, lateness: str) -> DataFrame:
    """SM2: drop exact repeats of ``(keys, ts)`` that arrive within
    ``lateness``; the watermark needs a ``TIMESTAMP`` column, so an NTZ event
    time gets a zone-free copy first."""
    s = stream.withColumn("_wm", F.timestamp_micros(ts_micros(F.col(ts_col))))
    return s.withWatermark("_wm", lateness).dropDuplicatesWithinWatermark(keys + [ts_col]).drop("_wm")


def guarded_merge(target: DataFrame | None, batch: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """SM3: next state: per key the batch's latest row replaces the stored
    row only when newer; stored rows without a batch row stay.  Rows of equal
    time are ordered by their other columns (in name order), so the winner does
    not depend on how rows were split into batches.  One full outer join on
    the complete keys; rows with a null key part bypass it (kept / appended).
    Columns that only one side has stay: a new one is null in stored rows, and
    one the batch lacks keeps its stored value."""
    complete = None
    for k in keys:
        c = F.col(k).isNotNull()
        complete = c if complete is None else complete & c
    rest = sorted(c for c in batch.columns if c not in keys and c != ts_col)
    # a key with a null part never matches: such rows are appended as they
    # come (as a MERGE inserts them) and stay out of the join
    loose = batch.where(~complete)
    newest = latest_by(batch.where(complete), keys, [ts_col, *rest])
    if target is None:
        return newest.unionByName(loose)
    stored, brought = set(target.columns), set(batch.columns)
    cols = [*target.columns, *(c for c in batch.columns if c not in stored)]
    kept_loose = target.where(~complete)
    target = target.where(complete)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns])
    s = newest.select(*[F.col(c).alias(f"s__{c}") for c in newest.columns])
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    order = [ts_col, *(c for c in rest if c in stored)]
    newer = F.struct(*[F.col(f"s__{c}").alias(c) for c in order]) > F.struct(*[F.col(f"t__{c}").alias(c) for c in order])
    take_s = F.col(f"s__{keys[0]}").isNotNull() & (F.col(f"t__{keys[0]}").isNull() | newer)
    old = {c: F.col(f"t__{c}") if c in stored else F.lit(None) for c in cols}
    merged = j.select(*[(F.when(take_s, F.col(f"s__{c}")).otherwise(old[c]) if c in brought else old[c]).alias(c) for c in cols])
    return merged.unionByName(kept_loose, allowMissingColumns=True).unionByName(loose, allowMissingColumns=True)


def batch_tag(checkpoint: str, epoch: int) -> str:
    """Names one micro-batch of the stream that owns ``checkpoint``."""
    return f"{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}-{epoch}"


def stream_upsert(stream: DataFrame, table_path: str, keys: list[str], ts_col: str,
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """SM1-SM3: merge every micro-batch into the versioned table.

    ``checkpoint`` is the stream's own folder and has no default: with it a
    restarted load goes on where it stopped.  Each batch writes the version
    after the newest one, tagged with checkpoint and epoch; a replayed batch
    finds its version and writes nothing, and streams with other checkpoints
    that load at the same time add to each other's states."""
    spark = stream.sparkSession
    table = VersionedTable(spark, table_path)
    cols = stream.columns

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        table.commit(lambda current: guarded_merge(current, batch.select(*cols), keys, ts_col), tag=batch_tag(checkpoint, epoch))

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def changed_keys_rollup(lines: DataFrame, batch: DataFrame, key: str, **rollup_args) -> DataFrame:
    """SM4: re-aggregate every line of the keys present in ``batch`` (not
    just the batch's lines, quirk Q2)."""
    changed = batch.select(key).distinct()
    return rollup_lines(lines.join(changed, key, "left_semi"), [key], **rollup_args)


def daily_closing(history: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """SM5: closing row per key and day of a capture history."""
    h = history.withColumn("day", F.to_date(ts_col))
    return latest_by(h, keys + ["day"], [ts_col])


def stream_rollup(stream: DataFrame, lines: DataFrame, key: str, table_path: str, asof_col: str,
                  checkpoint: str, **rollup_args) -> StreamingQuery:
    """SM4: for every micro-batch of changed lines, re-aggregate *all* lines
    of the changed keys (``lines`` is the full line table, read fresh each
    batch) and replace those keys' rows in the versioned header table.
    ``asof_col`` names the batch column whose maximum stamps ``updated_at``."""
    spark = stream.sparkSession
    table = VersionedTable(spark, table_path)

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        heads = changed_keys_rollup(lines, batch, key, **rollup_args) \
            .join(batch.groupBy(key).agg(F.max(asof_col).alias("updated_at")), key)
        def replaced(current: DataFrame | None) -> DataFrame:
            return heads if current is None else current.join(heads.select(key), key, "left_anti").unionByName(heads)

        table.commit(replaced, tag=batch_tag(checkpoint, epoch))

    return (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_upsert_parts(stream: DataFrame, table: PartTable, keys: list[str], ts_col: str, checkpoint: str) -> StreamingQuery:
    """SM1-SM3 on a table of parts: as :func:`stream_upsert`, but every micro-batch
    reads and writes only the parts that hold its keys; each is applied once,
    also where it is replayed or other loads write the same table."""
    writer = batch_tag(checkpoint, 0)

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        rows = batch.checkpoint()
        merge_into_parts(table, rows, keys, lambda current, new: guarded_merge(current, new, keys, ts_col), rows.limit(0), writer, epoch)

    ensure_checkpoint_dir(stream.sparkSession)
    return (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


#: A part's rows are merged in this many slices of their keys, so that a part, or a hot header in it, spans many tasks.
SLICES = 64


def merge_newest(table: PartTable, rows: DataFrame, keys: list[str], ts_col: str, near: str, writer: str = "", epoch: int | None = None) -> Version:
    """:func:`guarded_merge` into a table of parts, which also records the rows it replaced and brought.

    ``rows`` have complete keys and are read several times.  Stored rows whose ``near`` (one of
    ``keys``) is surely not among the rows' are written on where they are; the others
    and the batch are dealt out once, by part and slice of their keys, and the
    greatest (time, other columns) of a key stays.  The fact CHANGED of the version lists
    the directories of stored rows that a newer one replaced and of the rows that
    came in a stored state; a first version has none, all its rows came.  Where batch and table
    differ in columns, the rows are merged by the join and nothing is recorded.
    """
    order = [ts_col, *sorted(c for c in rows.columns if c not in keys and c != ts_col)]

    def change(version: Version | None) -> Change | None:
        none = table.read(version, []) if version else rows.limit(0)
        came = rows.select(*[F.col(c).cast(none.schema[c].dataType).alias(c) for c in rows.columns])
        touched = {x[0] for x in table.with_part(rows).select(PART).distinct().collect()}
        stored, rest = F.lit(False).alias("_stored"), None
        both = came.select("*", stored)
        if version:
            flagged = maybe_member(table.read(version, touched).select(*rows.columns), near, came.select(near), "_near")
            rest = flagged.where("NOT _near").drop("_near")
            both = both.unionByName(flagged.where("_near").drop("_near").withColumn("_stored", F.lit(True)))
        row = F.struct(*order)
        dealt = table.with_part(both).withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(SLICES)).cast("int")).repartition(PART, "_slice")
        best = dealt.groupBy(PART, "_slice", *keys).agg(F.max(row).alias("_new"), F.max(F.when(F.col("_stored"), row)).alias("_old"))
        if version:
            kind = lambda part, what: F.struct(part.alias("_p"), F.col(what).alias("_r"))
            newer = F.coalesce(F.col("_new") > F.col("_old"), F.lit(True))
            out = F.array(kind(F.col(PART), "_new"), F.when(newer, kind(F.lit(CAME), "_new")),
                          F.when(newer & F.col("_old").isNotNull(), kind(F.lit(GONE), "_old")))
            best = best.select(*keys, F.explode(F.filter(out, lambda x: x.isNotNull())).alias("_x")).select(*keys, "_x._r.*", F.col("_x._p").alias(PART))
        else:
            best = best.select(*keys, "_new.*", PART)
        merged = best.select(*none.columns, PART)
        written = table.write(merged if rest is None else merged.unionByName(table.with_part(rest).select(*none.columns, PART)), dealt=True)
        changed = {what: written.pop(what, []) for what in (GONE, CAME)} if version else None
        check_unique(table.rows_of(written, none.schema).select(*keys), keys)
        return Change(written, none.schema, reads=touched, facts={CHANGED: changed})

    version = table.version()
    if version and set(table.read(version, []).columns) != set(rows.columns):
        return merge_into_parts(table, rows, keys, lambda current, new: guarded_merge(current, new, keys, ts_col), rows.limit(0), writer, epoch)
    return table.commit(change, writer, epoch)


def stream_delta_rollup(stream: DataFrame, lines: PartTable, headers: PartTable, line_keys: list[str], ts_col: str,
                        rollup: Rollup, checkpoint: str) -> StreamingQuery:
    """SM4 by signed differences: every micro-batch of changed lines is merged
    into ``lines`` (newer rows win) and its differences into ``headers``.

    Both tables' parts follow from the header key, which is one of
    ``line_keys``.  Read are the parts of the batch's headers and, for headers
    whose maximum was withdrawn, the parts of their lines; no other line is
    scanned.  The differences are those that the version of ``lines`` the batch made
    records (:func:`merge_newest`), or else lie between the two versions around it, and each table applies an epoch once: a batch replayed
    after a crash between the two finds its lines merged and still makes the
    same differences.  Lines without a header key have no header; other lines
    with a null key part cannot be told apart and are refused."""
    spark, writer, r = stream.sparkSession, batch_tag(checkpoint, 0), rollup

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        path = shared_folder(spark, "batch")  # read several times, computed once
        batch.where(F.col(r.header).isNotNull()).write.parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        if not rows.isEmpty():
            roll_up(rows, epoch)
        lines.files.delete(path)

    def roll_up(rows: DataFrame, epoch: int) -> None:
        if not rows.where(" OR ".join(f"`{k}` IS NULL" for k in line_keys)).isEmpty():
            raise ValueError(f"a changed line lacks one of {line_keys}")
        merge_newest(lines, rows, line_keys, ts_col, r.header, writer, epoch)
        earlier = lines.before(writer, epoch)
        later = lines.version((earlier.number if earlier else 0) + 1)
        schema = lines.read(later, []).schema
        recorded = later.facts.get(CHANGED)
        if earlier is None:
            after = lines.read(later)
            before = after.limit(0)
        elif recorded and later.facts.get(CHANGED) != earlier.facts.get(CHANGED):
            before, after = (lines.rows_of({what: recorded[what]}, schema) for what in (GONE, CAME))
        else:
            touched = {x[0] for x in lines.with_part(rows).select(PART).distinct().collect()}
            changed = rows.select(*line_keys).distinct()
            after = lines.read(later, touched).join(changed, line_keys, "left_semi")
            before = lines.read(earlier, touched).join(changed, line_keys, "left_semi")
        lines_changed = signed(before, after)
        deltas = header_deltas(lines_changed, r)  # dealt out by header, as the join with the stored headers needs them
        named = lines_changed.select(r.header).distinct()

        def maxes_of(some: DataFrame) -> DataFrame:
            parts = {x[0] for x in lines.with_part(some).select(PART).distinct().collect()}
            near = maybe_member(lines.read(later, parts).select(r.header, *r.maxes), r.header, some, "_near").where("_near").drop("_near")
            return near.join(some, r.header, "left_semi").groupBy(r.header).agg(*[F.max(c).alias(c) for c in r.maxes])

        def change(version: Version | None) -> Change:
            parts = {x[0] for x in headers.with_part(lines_changed.select(r.header)).select(PART).distinct().collect()}
            if version:  # headers that surely have no difference are written on where they are
                flagged = maybe_member(headers.read(version, parts), r.header, named, "_near")
                merged = apply_deltas(flagged.where("_near").drop("_near"), deltas, r, maxes_of)
                merged = merged.unionByName(flagged.where("NOT _near").drop("_near"))
            else:
                merged = apply_deltas(r.whole(after.limit(0)), deltas, r, maxes_of)
            written = headers.write(headers.with_part(merged))
            return Change({p: written.get(p, []) for p in parts}, merged.schema, reads=parts)

        headers.commit(change, writer, epoch)

    ensure_checkpoint_dir(stream.sparkSession)
    return (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


OPEN, CLOSED, LATE = "open-", "closed-", "late"


def close_days(table: PartTable, batch: DataFrame, keys: list[str], ts_col: str, lateness: dt.timedelta,
               writer: str = "", epoch: int | None = None) -> Version:
    """SM2/SM5: one micro-batch of captures; a day's closing rows are final once the watermark passes its end.

    The watermark is the greatest event time of all earlier batches less
    ``lateness``, as in Structured Streaming.  Rows of a day that ended at or
    before it, and rows without a time, go to the late rows as they are; all
    others compete for the closing row of their key and day (the latest time
    wins, equal times by the other columns).  After the batch the watermark
    moves on, and every open day it has passed is closed: its directories are
    listed as closed from then on, nothing is written again.  Days, late rows and
    watermark change in one version, so a replayed epoch changes nothing.
    """
    cols = batch.columns
    rest = sorted(c for c in cols if c not in keys and c != ts_col)
    day = ntz_format(F.col(ts_col), "yyyy-MM-dd")
    rows = batch.withColumn("day", day).checkpoint()
    micros = lambda d: (dt.date.fromisoformat(d) - dt.date(1970, 1, 1)).days * 86_400_000_000
    facts = rows.groupBy("day").agg(F.max(ts_micros(F.col(ts_col))).alias("last")).collect()  # one row a day

    def change(version: Version | None) -> Change:
        mark = version.facts["watermark"] if version else None
        ended = lambda d, at: at is not None and micros(d) + 86_400_000_000 <= at
        late = [f["day"] for f in facts if f["day"] is not None and ended(f["day"], mark)]
        current = sorted(f["day"] for f in facts if f["day"] is not None and f["day"] not in late)
        parts: dict[str, list[str]] = {}
        if current:
            came = rows.where(F.col("day").isin(current))
            stored = table.read(version, [OPEN + d for d in current]) if version else rows.limit(0)
            best = latest_by(stored.unionByName(came), [*keys, "day"], [ts_col, *rest]).select(*rows.columns)
            parts |= table.write(best.withColumn(PART, F.concat(F.lit(OPEN), F.col("day"))))
        behind = rows.where(F.col("day").isNull() | F.col("day").isin(late)) if late or any(f["day"] is None for f in facts) else None
        if behind is not None:
            added = table.write(behind.withColumn(PART, F.lit(LATE)))
            parts[LATE] = [*(version.parts.get(LATE, []) if version else []), *added[LATE]]
        last = max((f["last"] for f in facts if f["last"] is not None), default=None)
        if last is not None:
            mark = max(last - int(lateness / dt.timedelta(microseconds=1)), mark if mark is not None else -1 << 63)
        open_parts = ({p: d for p, d in version.parts.items()} if version else {}) | parts
        for p, directories in open_parts.items():
            if p.startswith(OPEN) and directories and ended(p[len(OPEN):], mark):
                parts |= {p: [], CLOSED + p[len(OPEN):]: directories}
        return Change(parts, rows.schema, facts={"watermark": mark})

    return table.commit(change, writer, epoch)


def rows_by_kind(table: PartTable, kind: str) -> DataFrame:
    """The rows of OPEN, CLOSED or LATE parts in the newest version."""
    version = table.version()
    return table.read(version, [p for p in version.parts if p.startswith(kind)])


def stream_closings(stream: DataFrame, table: PartTable, keys: list[str], ts_col: str, lateness: dt.timedelta,
                    checkpoint: str) -> StreamingQuery:
    """SM2/SM5: :func:`close_days` for every micro-batch of a stream of captures."""
    writer = batch_tag(checkpoint, 0)

    def close_batch(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            close_days(table, batch, keys, ts_col, lateness, writer, epoch)

    ensure_checkpoint_dir(stream.sparkSession)
    return (stream.writeStream.foreachBatch(close_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_snapshots(stream: DataFrame, history_path: str, snapshot_path: str, keys: list[str],
                     capture_col: str, checkpoint: str) -> StreamingQuery:
    """SM5/SK7: each micro-batch is one stock capture: added to the history
    (a folder per micro-batch, partitioned by capture day; a replayed batch
    overwrites its own) and published as the new snapshot version (truncate +
    load).  ``daily_closing`` over the history gives the closing row per key
    and day."""
    spark = stream.sparkSession
    snap = VersionedTable(spark, snapshot_path)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        b = batch.dropDuplicates()
        tag = batch_tag(checkpoint, epoch)
        (b.withColumn("capture_day", F.to_date(capture_col)).write.mode("overwrite")
         .partitionBy("capture_day").parquet(f"{history_path.rstrip('/')}/batch={tag}"))
        snap.commit(lambda _: b, tag=tag)

    return (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# ---------------------------------------------------------------- queries
def _event_stream(spark, sf, *cols):
    """The ``events`` file as a stream, and a fresh shared folder for one load."""
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema
    base = shared_folder(spark, "stream")
    return file_stream(spark, f"{sf.rstrip('/')}/events*.parquet", schema).select(*cols), base


def stream_dedupe_upsert(spark, sf):
    """SM1-SM3: the ``events`` file as a stream (availableNow), each
    micro-batch merged into a versioned table keyed by user with the
    newer-event guard; the final version is read back as a batch: the latest
    event per user."""
    stream, base = _event_stream(spark, sf, "user_id", "event_id", "ts", "event_type", "value")
    stream_upsert(stream, f"{base}/table", ["user_id"], "ts", f"{base}/_checkpoint").awaitTermination()
    out = VersionedTable(spark, f"{base}/table").latest()
    return out.select("user_id", "event_id", "ts", "event_type", "value")


def stream_changed_rollup(spark, sf):
    """SM4: the large ``events`` as the stream of changes: all events of the
    users they name are rolled up again into a versioned header table."""
    stream, base = _event_stream(spark, sf, "user_id", "ts", "value")
    lines = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select("user_id", F.col("event_id"))
    stream_rollup(stream.where("value > 100"), lines, "user_id", f"{base}/table", "ts", f"{base}/_checkpoint",
                  sum_cols=["event_id"], count_name="n_events").awaitTermination()
    out = VersionedTable(spark, f"{base}/table").latest()
    return out.select("user_id", F.col("event_id").cast("bigint").alias("sum_id"), F.col("n_events").cast("bigint").alias("n_events"), "updated_at")


def stream_daily_closing(spark, sf):
    """SM5/SK7: ``events`` as a stream of captures: the history written per
    micro-batch, and its closing row per user and day."""
    stream, base = _event_stream(spark, sf, "user_id", "event_id", "ts", "value")
    stream_snapshots(stream, f"{base}/history", f"{base}/snapshot", ["user_id"], "ts", f"{base}/_checkpoint").awaitTermination()
    history = spark.read.parquet(f"{base}/history").select("user_id", "event_id", "ts", "value")
    return daily_closing(history, ["user_id"], "ts").select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id", "ts", "value")


def _load_in_turn(spark, base: str, rows: DataFrame, arrival, batches: int, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Lands the rows of each arrival number after the loads of those before; every load is the stream started anew."""
    schema = rows.schema
    for b in range(batches):
        rows.where(arrival == b).write.parquet(f"{base}/in/f{b:03d}")
        start(file_stream(spark, f"{base}/in/*", schema)).awaitTermination()


def stream_upsert_files(spark, sf):
    """SM1-SM3: ``events`` in files of ten days, the newest first, and a last
    file of old ones again, each merged into a stored state of parts."""
    base = shared_folder(spark, "stream")
    t = PartTable(spark, f"{base}/table", bucket_of(["user_id"], 16))
    e = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select("user_id", "event_id", "ts", "event_type", "value")
    again = e.where(F.col("event_id") % 3 == 0).withColumn("_at", F.lit(3))
    landed = e.withColumn("_at", 2 - _slice_of_ten_days("ts")).unionByName(again)
    _load_in_turn(spark, base, landed, F.col("_at"), 4,
                  lambda s: stream_upsert_parts(s.drop("_at"), t, ["user_id"], "ts", f"{base}/_checkpoint"))
    return t.read().select("user_id", "event_id", "ts", "event_type", "value")


def _slice_of_ten_days(ts_col: str):
    days = F.datediff(F.col(ts_col).cast("date"), F.lit("2024-01-01").cast("date"))
    return F.least(F.greatest(F.floor(days / 10), F.lit(0)), F.lit(2))


def stream_closings_by_watermark(spark, sf):
    """SM2/SM5: ``events`` as captures that arrive up to two files late: closing
    rows of the days the watermark has passed, still open ones, and late rows."""
    base = shared_folder(spark, "stream")
    t = PartTable(spark, f"{base}/table")
    e = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select("user_id", "event_id", "ts", "value")
    behind = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0) + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)
    _load_in_turn(spark, base, e, _slice_of_ten_days("ts") + behind, 5,
                  lambda s: stream_closings(s, t, ["user_id"], "ts", dt.timedelta(days=1), f"{base}/_checkpoint"))
    kinds = [rows_by_kind(t, k).select(F.lit(name).alias("kind"), "user_id", "day", "event_id", "ts", "value")
             for k, name in ((CLOSED, "closing"), (OPEN, "open"), (LATE, "late"))]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def _line_changes(spark, sf):
    """``lineitem`` as lines that change: all of them, then withdrawn, raised, stale and new ones, by arrival."""
    li = spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet").select(
        "l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"), F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    at = lambda df, b, ts: df.withColumns({"ts": F.lit(ts).cast("timestamp_ntz"), "_at": F.lit(b)})
    key, money = F.col("l_orderkey"), "decimal(12,2)"
    return (at(li, 0, "2024-01-01 00:00:00")
            .unionByName(at(li.where(key % 7 == 1).withColumns({"qty": F.lit(1).cast(money), "price": (F.col("price") + 10).cast(money)}), 1, "2024-01-03 00:00:00"))
            .unionByName(at(li.where(key % 7 == 2).withColumns({"qty": (F.col("qty") + 100).cast(money), "price": F.when(F.col("line") % 2 == 0, F.col("price"))}), 2, "2024-01-02 00:00:00"))
            .unionByName(at(li.where(key % 7 <= 2).withColumn("qty", F.lit(2).cast(money)), 3, "2024-01-02 12:00:00"))
            .unionByName(at(li.where(key % 11 == 3).withColumn("line", F.col("line") + 100), 3, "2024-01-04 00:00:00")))


def stream_rollup_by_deltas(spark, sf):
    """SM4: changes of ``lineitem`` in four loads; order headers kept up to date by signed differences."""
    base = shared_folder(spark, "stream")
    lines, headers = (PartTable(spark, f"{base}/{n}", bucket_of(["l_orderkey"], 16)) for n in ("lines", "headers"))
    r = Rollup("l_orderkey", sums=("price",), maxes=("qty", "part"))
    _load_in_turn(spark, base, _line_changes(spark, sf), F.col("_at"), 4,
                  lambda s: stream_delta_rollup(s.drop("_at"), lines, headers, ["l_orderkey", "line"], "ts", r, f"{base}/_checkpoint"))
    return headers.read().select("l_orderkey", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("price").cast("double").alias("sum_price"),
                                 F.col("qty").cast("double").alias("max_qty"), F.col("part").alias("max_part"))


ORACLE = {
    "q_stream_upsert_files": """
        SELECT user_id, event_id, ts, event_type, value FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "q_stream_closings": """
        WITH e AS (SELECT user_id, event_id, ts, value, CAST(ts AS DATE) AS d,
                          LEAST(GREATEST(DATE_DIFF('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10, 0), 2)
                          + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END AS batch FROM events),
             m AS (SELECT batch, MAX(ts) - INTERVAL 1 DAY AS top FROM e GROUP BY batch),
             w AS (SELECT batch, MAX(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM m),
             f AS (SELECT e.*, COALESCE(CAST(d + INTERVAL 1 DAY AS TIMESTAMP) <= mark, FALSE) AS late FROM e JOIN w ON e.batch = w.batch),
             best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) AS rn FROM f WHERE NOT late)
        SELECT CASE WHEN CAST(d + INTERVAL 1 DAY AS TIMESTAMP) <= (SELECT MAX(top) FROM m) THEN 'closing' ELSE 'open' END AS kind,
               user_id, STRFTIME(d, '%Y-%m-%d') AS day, event_id, ts, value FROM best WHERE rn = 1
        UNION ALL SELECT 'late', user_id, STRFTIME(d, '%Y-%m-%d'), event_id, ts, value FROM f WHERE late""",
    "q_stream_delta_rollup": """
        WITH li AS (SELECT l_orderkey, l_linenumber AS line, l_partkey AS part, CAST(l_quantity AS DECIMAL(12,2)) AS qty,
                           CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem),
             c AS (SELECT l_orderkey, line, part, qty, price, TIMESTAMP '2024-01-01 00:00:00' AS ts FROM li
                   UNION ALL SELECT l_orderkey, line, part, 1, price + 10, TIMESTAMP '2024-01-03 00:00:00' FROM li WHERE l_orderkey % 7 = 1
                   UNION ALL SELECT l_orderkey, line, part, qty + 100, CASE WHEN line % 2 = 0 THEN price END, TIMESTAMP '2024-01-02 00:00:00'
                             FROM li WHERE l_orderkey % 7 = 2
                   UNION ALL SELECT l_orderkey, line, part, 2, price, TIMESTAMP '2024-01-02 12:00:00' FROM li WHERE l_orderkey % 7 <= 2
                   UNION ALL SELECT l_orderkey, line + 100, part, qty, price, TIMESTAMP '2024-01-04 00:00:00' FROM li WHERE l_orderkey % 11 = 3),
             now AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, line
                                                  ORDER BY ts DESC, part DESC NULLS LAST, price DESC NULLS LAST, qty DESC NULLS LAST) AS rn FROM c)
        SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(SUM(price) AS DOUBLE) AS sum_price,
               CAST(MAX(qty) AS DOUBLE) AS max_qty, MAX(part) AS max_part FROM now WHERE rn = 1 GROUP BY l_orderkey""",
    "q_stream_dedupe_upsert": """
        SELECT user_id, event_id, ts, event_type, value FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "q_stream_changed_rollup": """
        SELECT e.user_id, CAST(SUM(e.event_id) AS BIGINT) AS sum_id, COUNT(*) AS n_events, MAX(c.last) AS updated_at
        FROM events e JOIN (SELECT user_id, MAX(ts) AS last FROM events WHERE value > 100 GROUP BY user_id) c
          ON e.user_id = c.user_id
        GROUP BY e.user_id""",
    "q_stream_daily_closing": """
        SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, ts, value FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""",
}

QUERIES = {"q_stream_dedupe_upsert": stream_dedupe_upsert, "q_stream_changed_rollup": stream_changed_rollup,
           "q_stream_daily_closing": stream_daily_closing, "q_stream_upsert_files": stream_upsert_files,
           "q_stream_closings": stream_closings_by_watermark, "q_stream_delta_rollup": stream_rollup_by_deltas}
