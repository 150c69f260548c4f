"""Rollups by signed differences (SM4) and closing rows by event time (SM2, SM5)."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.deltas import Rollup, apply_deltas, header_deltas, signed
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.files import Files
from ledgerline.sources.parts import PartTable, bucket_of
from ledgerline.streaming.incremental import (CLOSED, LATE, OPEN, batch_tag, close_days, file_stream, rows_by_kind, stream_closings,
                                              stream_delta_rollup, stream_upsert_parts)

from .conftest import rows

R = Rollup("h", sums=("v",), maxes=("m",))
LINE = "h long, line long, v long, m long"


def fresh(spark):
    return f"{ensure_checkpoint_dir(spark)}/delta-{uuid.uuid4().hex}"


def test_differences_equal_the_whole_rollup(spark):
    rng = random.Random(4)
    value = lambda: rng.choice([None, 0, 1, 2, 3, 9])
    now = {(h, l): (value(), value()) for h in range(40) for l in range(rng.randint(1, 4))}
    frame = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], LINE)
    headers, asked = R.whole(frame(now)), []
    for _ in range(3):
        later = {k: (value(), value()) if rng.random() < 0.3 else v for k, v in now.items() if rng.random() < 0.9}
        later |= {(rng.randint(30, 60), 10 + i): (value(), value()) for i in range(5)}
        gone = {k: v for k, v in now.items() if later.get(k) != v}
        came = {k: v for k, v in later.items() if now.get(k) != v}

        def again(withdrawn, later=later):
            asked.append([r[0] for r in withdrawn.collect()])
            return frame(later).join(withdrawn, "h", "left_semi").groupBy("h").agg(F.max("m").alias("m"))

        headers = apply_deltas(headers, header_deltas(signed(frame(gone), frame(came)), R), R, again)
        assert rows(headers) == rows(R.whole(frame(later)).select(*headers.columns))
        for h in asked[-1]:  # only headers whose maximum went were looked up again
            assert max((v[1] for k, v in now.items() if k[0] == h and v[1] is not None)) > max((v[1] for k, v in came.items() if k[0] == h and v[1] is not None), default=-1)
        now = later
    assert len(asked) == 3 and all(0 < len(a) < 25 for a in asked)


S = "h long, line long, v long, m long, ts timestamp_ntz"


def day(d, hour=0):
    return dt.datetime(2024, 1, d, hour)


def run(spark, base, batches, start):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, S).coalesce(1).write.parquet(f"{base}/in/f{i}")
        start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()


def test_stream_of_changes_scans_only_changed_headers(spark):
    base = fresh(spark)
    lines, headers = (PartTable(spark, f"{base}/{n}", bucket_of(["h"], 32)) for n in ("lines", "headers"))
    start = lambda s: stream_delta_rollup(s, lines, headers, ["h", "line"], "ts", R, f"{base}/ckpt")
    run(spark, base, [[(h, l, 10 * h + l, l, day(1)) for h in range(60) for l in range(3)]], start)
    first = headers.version()
    # header 5 loses its maximum; every directory of another header's lines is unreadable from now on
    part = {r["h"]: r["__part"] for r in lines.with_part(spark.range(60).toDF("h")).collect()}
    for p, directories in lines.version().parts.items():
        if p not in (part[5], part[70 % 60]):
            for d in directories:
                Files(spark).delete(f"{base}/lines/data/{d}")
    spark.createDataFrame([(5, 2, 7, 0, day(2)), (10, 9, 100, 50, day(2)), (5, 0, 999, 99, dt.datetime(2023, 12, 31)), (None, 1, 1, 1, day(2))], S) \
        .coalesce(1).write.parquet(f"{base}/in/later")
    start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()
    got = {r["h"]: (r["n_lines"], r["v"], r["m"]) for r in headers.read().collect()}
    want = {h: (3, 30 * h + 3, 2) for h in range(60)} | {5: (3, 50 + 51 + 7, 1), 10: (4, 303 + 100, 50)}
    assert got == want
    after = headers.version()
    assert {p for p in after.parts if after.parts[p] != first.parts[p]} == {part[5], part[10]}


def test_a_replay_between_the_two_tables_makes_the_same_differences(spark):
    base = fresh(spark)
    lines, headers = (PartTable(spark, f"{base}/{n}", bucket_of(["h"], 4)) for n in ("lines", "headers"))

    class Crash(PartTable):
        def commit(self, change, writer="", epoch=None):
            if epoch == 1 and not crashed:
                crashed.append(1)
                raise RuntimeError("lost before the headers were published")
            return super().commit(change, writer, epoch)

    crashed: list = []
    start = lambda s: stream_delta_rollup(s, lines, Crash(spark, headers.base, headers.part), ["h", "line"], "ts", R, f"{base}/ckpt")
    run(spark, base, [[(1, 0, 5, 5, day(1)), (1, 1, 6, 6, day(1))]], start)
    with pytest.raises(Exception, match="lost before"):
        run(spark, f"{base}/x", [], start)
        spark.createDataFrame([(1, 1, 1, 1, day(2)), (2, 0, 3, 3, day(2))], S).coalesce(1).write.parquet(f"{base}/in/second")
        start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()
    assert lines.version().applied[batch_tag(f"{base}/ckpt", 0)] == 1 and headers.version().number == 1
    start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()
    assert rows(headers.read(), "h", "n_lines", "v", "m") == [(1, 2, 6, 5), (2, 1, 3, 3)]


def test_stream_upsert_into_parts(spark):
    base = fresh(spark)
    t = PartTable(spark, f"{base}/t", bucket_of(["h"], 8))
    start = lambda s: stream_upsert_parts(s, t, ["h"], "ts", f"{base}/ckpt")
    run(spark, base, [[(h, 0, h, 0, day(5)) for h in range(20)], [(1, 0, 100, 0, day(4)), (2, 0, 200, 0, day(6)), (None, 0, 1, 1, day(1))]], start)
    assert rows(t.read(), "h", "v") == [(None, 1), (0, 0), (1, 1), (2, 200), *((h, h) for h in range(3, 20))]
    assert t.numbers() == [1, 2] and t.version(2).applied == {batch_tag(f"{base}/ckpt", 0): 1}


def test_days_close_once_and_late_rows_go_aside(spark):
    base = fresh(spark)
    t = PartTable(spark, f"{base}/t")
    start = lambda s: stream_closings(s, t, ["h"], "ts", dt.timedelta(hours=12), f"{base}/ckpt")
    run(spark, base, [[(1, 0, 1, 0, day(1, 8)), (1, 0, 2, 0, day(1, 9)), (2, 0, 3, 0, day(2, 6))]], start)
    assert rows_by_kind(t, CLOSED).count() == 0       # the watermark is at 18:00 of day 1
    run(spark, f"{base}", [], start)
    for i, b in enumerate([[(1, 0, 4, 0, day(1, 7)), (1, 0, 5, 0, day(1, 10)), (2, 0, 6, 0, day(2, 13))],   # closes day 1
                           [(1, 0, 7, 0, day(1, 23)), (3, 0, 8, 0, day(2, 1)), (3, 0, 9, 0, None)],         # day 1 is over: late
                           [(2, 0, 10, 0, day(9, 0))]]):                                                    # closes day 2
        closed = rows_by_kind(t, CLOSED).inputFiles()
        spark.createDataFrame(b, S).coalesce(1).write.parquet(f"{base}/in/more{i}")
        start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()
        assert set(closed) <= set(rows_by_kind(t, CLOSED).inputFiles())    # what is closed is never written again
    assert rows(rows_by_kind(t, CLOSED), "h", "day", "v") == [(1, "2024-01-01", 5), (2, "2024-01-02", 6), (3, "2024-01-02", 8)]
    assert rows(rows_by_kind(t, LATE), "h", "v") == [(1, 7), (3, 9)]
    assert rows(rows_by_kind(t, OPEN), "h", "day") == [(2, "2024-01-09")]
    assert t.version().facts == {"watermark": int((day(8, 12) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000}


def test_a_replayed_batch_closes_nothing_twice(spark):
    t = PartTable(spark, fresh(spark))
    b = spark.createDataFrame([(1, 0, 1, 0, day(1)), (1, 0, 2, 0, day(5))], S)
    for epoch in (0, 0, 1, 1):
        close_days(t, b, ["h"], "ts", dt.timedelta(0), "s", epoch)
    assert t.numbers() == [1, 2]
    assert rows(rows_by_kind(t, LATE), "v") == [(1,)] and rows(rows_by_kind(t, CLOSED), "v") == [(1,)] and rows(rows_by_kind(t, OPEN), "v") == [(2,)]


def test_differences_come_from_what_the_merge_recorded(spark):
    base = fresh(spark)
    lines, headers = (PartTable(spark, f"{base}/{n}", bucket_of(["h"], 2)) for n in ("lines", "headers"))
    start = lambda s: stream_delta_rollup(s, lines, headers, ["h", "line"], "ts", R, f"{base}/ckpt")
    run(spark, base, [[(h, l, h, l, day(2)) for h in range(20) for l in range(2)]], start)
    spark.createDataFrame([(3, 0, 7, 7, day(3)), (4, 0, 9, 9, day(1)), (5, 0, 5, 0, day(2)), (30, 0, None, None, day(1)), (30, 0, 2, 2, day(1))], S) \
        .coalesce(1).write.parquet(f"{base}/in/later")
    start(file_stream(spark, f"{base}/in/*", S)).awaitTermination()
    # of the changed lines: one newer, one older, one the same, one new that comes twice; no stored line is scanned for the differences
    found, schema = lines.version().facts["changed"], lines.read().schema
    assert rows(lines.rows_of({"": found["gone"]}, schema), "h", "line", "v") == [(3, 0, 3)]
    assert rows(lines.rows_of({"": found["came"]}, schema), "h", "line", "v") == [(3, 0, 7), (30, 0, 2)]
    want = {h: (2, 2 * h, 1) for h in range(20)} | {3: (2, 10, 7), 30: (1, 2, 2)}
    assert {x["h"]: (x["n_lines"], x["v"], x["m"]) for x in headers.read().collect()} == want
    assert rows(lines.read().where("h IN (3, 4, 30)"), "h", "line", "v") == [(3, 0, 7), (3, 1, 3), (4, 0, 4), (4, 1, 4), (30, 0, 2)]
    assert not [n for n in Files(spark).names(f"{base}/lines/data") if n in ("gone", "came")]
    kept = lines.version().directories()
    assert set(found["gone"] + found["came"]) <= set(kept)
