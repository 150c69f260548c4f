"""Streaming upsert (SM1-SM3): stream result equals batch result; the
newer-event guard keeps an older batch from overwriting a newer state."""

import datetime as dt
import uuid

from ledgerline.session import ensure_checkpoint_dir
from ledgerline.streaming.incremental import VersionedTable, guarded_merge, stream_dedupe_upsert

from .conftest import SF_SMALL, rows


def test_stream_equals_batch(spark):
    got = stream_dedupe_upsert(spark, SF_SMALL)
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from ledgerline.operators.dedupe import latest_by
    want = latest_by(e.select("user_id", "event_id", "ts", "event_type", "value"), ["user_id"], ["ts", "event_id"])
    assert rows(got) == rows(want.select(*got.columns))


def test_guard_keeps_newer_state(spark):
    s = "k string, ts timestamp_ntz, v int"
    t = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), 5)], s)
    old = spark.createDataFrame([("a", dt.datetime(2024, 1, 3), 3), ("b", dt.datetime(2024, 1, 1), 1)], s)
    assert rows(guarded_merge(t, old, ["k"], "ts"), "k", "v") == [("a", 5), ("b", 1)]
    new = spark.createDataFrame([("a", dt.datetime(2024, 1, 6), 6)], s)
    assert rows(guarded_merge(t, new, ["k"], "ts"), "k", "v") == [("a", 6)]
    assert rows(guarded_merge(t, t, ["k"], "ts"), "k", "v") == [("a", 5)]   # replay is a no-op


def test_versioned_table(spark):
    base = f"{ensure_checkpoint_dir(spark)}/vt-{uuid.uuid4().hex}"
    vt = VersionedTable(spark, base)
    assert vt.latest() is None
    vt.publish(spark.range(2), 1)
    vt.publish(spark.range(5), 3)
    assert vt.versions() == [1, 3] and vt.latest().count() == 5


def test_stream_rollup_changed_keys(spark, tmp_path):
    from pyspark.sql import functions as F
    from ledgerline.streaming.incremental import file_stream, stream_rollup
    lines = spark.createDataFrame([("o1", 1.0), ("o1", 2.0), ("o2", 5.0)], "k string, q double")
    src = tmp_path / "changes"
    spark.createDataFrame([("o1", dt.datetime(2024, 1, 2))], "k string, ts timestamp_ntz").write.parquet(str(src / "b1"))
    stream = file_stream(spark, str(src / "*"), "k string, ts timestamp_ntz")
    base = f"{ensure_checkpoint_dir(spark)}/roll-{uuid.uuid4().hex}"
    stream_rollup(stream, lines, "k", base, "ts", f"{base}-ckpt", sum_cols=["q"], count_name="n").awaitTermination()
    got = VersionedTable(spark, base).latest()
    assert rows(got, "k", "q", "n") == [("o1", 3.0, 2)]     # all lines of the changed key, not just the batch


def test_stream_snapshots(spark, tmp_path):
    from ledgerline.streaming.incremental import daily_closing, file_stream, stream_snapshots
    src = tmp_path / "caps"
    cap = [("A", 1, dt.datetime(2024, 1, 1, 9)), ("A", 1, dt.datetime(2024, 1, 1, 9)), ("B", 2, dt.datetime(2024, 1, 1, 9))]
    spark.createDataFrame(cap, "sku string, qty int, ts timestamp_ntz").write.parquet(str(src / "c1"))
    stream = file_stream(spark, str(src / "*"), "sku string, qty int, ts timestamp_ntz")
    hist, snap = str(tmp_path / "hist"), f"{ensure_checkpoint_dir(spark)}/snap-{uuid.uuid4().hex}"
    stream_snapshots(stream, hist, snap, ["sku"], "ts", f"{snap}-ckpt").awaitTermination()
    assert VersionedTable(spark, snap).latest().count() == 2
    h = spark.read.parquet(hist)
    assert h.count() == 2 and daily_closing(h, ["sku"], "ts").count() == 2


def test_stream_late_older_batch_does_not_overwrite(spark, tmp_path):
    """Q6: a later micro-batch carrying older events leaves the newer state."""
    import time
    from ledgerline.streaming.incremental import file_stream, stream_upsert
    s = "user_id bigint, ts timestamp_ntz, v int"
    src = tmp_path / "in"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 5), 5), (2, dt.datetime(2024, 1, 5), 7)], s) \
        .coalesce(1).write.parquet(str(src / "a_newer"))
    time.sleep(1.1)  # file modification order defines arrival order
    spark.createDataFrame([(1, dt.datetime(2024, 1, 4), 4), (3, dt.datetime(2024, 1, 4), 9)], s) \
        .coalesce(1).write.parquet(str(src / "b_older"))
    stream = file_stream(spark, str(src / "*"), s, max_files_per_trigger=1)
    base = f"{ensure_checkpoint_dir(spark)}/late-{uuid.uuid4().hex}"
    stream_upsert(stream, base, ["user_id"], "ts", f"{base}-ckpt").awaitTermination()
    vt = VersionedTable(spark, base)
    assert len(vt.versions()) == 2                      # one version per micro-batch
    assert rows(vt.latest(), "user_id", "v") == [(1, 5), (2, 7), (3, 9)]


def test_guarded_merge_null_keys(spark):
    s = "k string, ts timestamp_ntz, v int"
    t = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), 5), (None, dt.datetime(2024, 1, 1), 0)], s)
    b = spark.createDataFrame([("a", dt.datetime(2024, 1, 6), 6), (None, dt.datetime(2024, 1, 7), 7)], s)
    assert rows(guarded_merge(t, b, ["k"], "ts"), "k", "v") == [(None, 0), (None, 7), ("a", 6)]
    assert rows(guarded_merge(None, b, ["k"], "ts"), "k", "v") == [(None, 7), ("a", 6)]


S = "user_id bigint, ts timestamp_ntz, v int"


def load(spark, files, base, checkpoint, per_trigger=1):
    """Lands the files in order and runs one load over them."""
    import time

    from ledgerline.streaming.incremental import file_stream, stream_upsert
    src = f"{base}-in-{uuid.uuid4().hex}"
    for i, f in enumerate(files):
        spark.createDataFrame(f, S).coalesce(1).write.parquet(f"{src}/f{i}")
        time.sleep(1.05)  # file modification order defines arrival order
    stream_upsert(file_stream(spark, f"{src}/*", S, max_files_per_trigger=per_trigger), base, ["user_id"], "ts", checkpoint).awaitTermination()
    return VersionedTable(spark, base)


def test_rows_far_behind_are_merged_too(spark):
    base = f"{ensure_checkpoint_dir(spark)}/far-{uuid.uuid4().hex}"
    day = lambda d: dt.datetime(2024, 1, d)
    t = load(spark, [[(1, day(20), 1)], [(2, day(21), 2)], [(4, day(12), 4)], [(1, day(2), 9)]], base, f"{base}-ckpt")
    assert rows(t.latest(), "user_id", "v") == [(1, 1), (2, 2), (4, 4)]


def test_second_load_with_another_checkpoint_keeps_the_table(spark):
    base = f"{ensure_checkpoint_dir(spark)}/two-{uuid.uuid4().hex}"
    load(spark, [[(1, dt.datetime(2024, 1, 1), 1)]], base, f"{base}-a")
    t = load(spark, [[(2, dt.datetime(2024, 1, 1), 2)]], base, f"{base}-b")
    assert rows(t.latest(), "user_id", "v") == [(1, 1), (2, 2)]


def test_equal_times_end_in_one_state_for_any_split(spark):
    ts = dt.datetime(2024, 1, 1)
    states = []
    for files in ([[(1, ts, 5)], [(1, ts, 7)]], [[(1, ts, 7)], [(1, ts, 5)]], [[(1, ts, 5), (1, ts, 7)]]):
        base = f"{ensure_checkpoint_dir(spark)}/tie-{uuid.uuid4().hex}"
        states.append(rows(load(spark, files, base, f"{base}-c").latest(), "user_id", "v"))
    assert states == [[(1, 7)]] * 3


def test_replayed_batches_write_their_own_version_again(spark):
    from ledgerline.streaming.incremental import batch_tag
    base = f"{ensure_checkpoint_dir(spark)}/rep-{uuid.uuid4().hex}"
    t = load(spark, [[(1, dt.datetime(2024, 1, 1), 1)], [(1, dt.datetime(2024, 1, 2), 2)]], base, f"{base}-c")
    assert t.versions() == [0, 1]
    assert t.version_for(batch_tag(f"{base}-c", 1)) == (1, 0) and t.version_for(batch_tag(f"{base}-c", 2)) == (2, 1)


def test_guarded_merge_when_columns_come_and_go(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    t = spark.createDataFrame([("a", day(1), 1, "x"), ("b", day(1), 2, "y"), (None, day(1), 0, "z")], "k string, ts timestamp_ntz, v int, w string")
    more = spark.createDataFrame([("a", day(2), 5, "n", True), ("c", day(2), 6, "m", False)], "k string, ts timestamp_ntz, v int, w string, present boolean")
    got = guarded_merge(t, more, ["k"], "ts")
    assert rows(got, "k", "v", "w", "present") == [(None, 0, "z", None), ("a", 5, "n", True), ("b", 2, "y", None), ("c", 6, "m", False)]
    fewer = spark.createDataFrame([("a", day(3), 9), ("b", day(0 + 1), 9), ("d", day(1), 7), (None, day(1), 8)], "k string, ts timestamp_ntz, v int")
    got = guarded_merge(t, fewer, ["k"], "ts")
    assert rows(got, "k", "v", "w") == [(None, 0, "z"), (None, 8, None), ("a", 9, "x"), ("b", 9, "y"), ("d", 7, None)]
