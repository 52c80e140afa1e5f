import json
import time

import pandas as pd
import pytest

from auricle.streaming import jobs as job_streams
from auricle.streaming import progress, sinks, timers, windows
from auricle.sources import jobs
from auricle import clock
from tests.conftest import values


def put(spark, folder, schema, data):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def test_routing_over_micro_batches(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    good = {"batch_id": "b", "opus_path": "/x", "original_filename": "n", "parquet_metadata": {"k": [1]}}
    messages = [
        json.dumps(good), "{broken", "", "[1]", "5", json.dumps({"batch_id": "b"}),
        json.dumps({"batch_id": None, "opus_path": "/x"}), json.dumps({**good, "extra": 1}),
    ]
    for m in messages:
        put(spark, source, "value STRING", [(m,)])
    stream = jobs.message_stream(spark, source, max_files=2)
    sinks.run_to_end(stream, job_streams.route_transcribe(out), f"{tmp_path}/c")
    got = sinks.read_epochs(spark, f"{out}/jobs", "opus_path STRING, parquet_metadata STRING")
    assert values(got, "opus_path", "parquet_metadata") == [("/x", '{"k":[1]}')] * 2
    rejected = sinks.read_epochs(spark, f"{out}/rejected", "value STRING, reason STRING")
    assert values(rejected, "reason") == [("invalid JSON",)] * 4 + [("missing field",)] * 2
    assert got.select("epoch").distinct().count() + rejected.select("epoch").distinct().count() > 2


def test_dead_letter_keeps_all_keys(rows):
    from pyspark.sql import functions as F

    df = rows("v STRING", [('{"a":"q\\"}","n":[1,{"b":2}]} ',), ("{}",), ("{ }",)])
    at = F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00.5'")
    got = [json.loads(r[0]) for r in df.select(jobs.dead_letter("v", F.lit('bad "x"'), at)).collect()]
    extra = {"error": 'bad "x"', "failed_at": "2025-01-01T00:00:00.500000Z"}
    assert got == [{"a": 'q"}', "n": [1, {"b": 2}], **extra}, extra, extra]


def test_progress_counts_and_completion_in_a_later_batch(spark, tmp_path):
    attempts, totals = f"{tmp_path}/a", f"{tmp_path}/t"
    put(spark, totals, "batch_id STRING, total BIGINT", [("done", 3), ("over", 1), ("short", 9)])
    put(spark, attempts, "batch_id STRING", [("done",), ("over",), ("over",), ("lost",)])
    put(spark, attempts, "batch_id STRING", [("done",), ("done",), ("over",), ("short",)])

    def stream(path, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    events = progress.batch_events(
        progress.signals(stream(attempts, "batch_id STRING"), stream(totals, "batch_id STRING, total BIGINT")),
        timers=False,
    )
    out = f"{tmp_path}/events"
    sinks.run_to_end(events, lambda b, e: sinks.write_epoch(b, out, e), f"{tmp_path}/c")
    got = sinks.read_epochs(spark, out, "batch_id STRING, event STRING, total BIGINT, processed BIGINT")
    assert values(got, "batch_id", "event") == [("done", "complete"), ("over", "complete")]


class State:
    """A stand-in for the engine's group state."""

    def __init__(self):
        self.value, self.timeout, self.now, self.hasTimedOut = None, None, 1_000_000, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value, self.timeout = value, None

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def step(state, *signals):
    frames = [pd.DataFrame(signals, columns=["batch_id", "total", "processed"])] if signals else []
    return [tuple(f.iloc[0]) for f in progress._step(("b",), iter(frames), state, True)]


def test_state_is_kept_a_minute_after_completion():
    state = State()
    assert step(state, ("b", 2, 0), ("b", None, 1)) == []
    assert state.timeout == progress.STUCK_MS
    assert step(state, ("b", None, 1)) == [("b", "complete", 2, 2)]
    assert state.timeout == 60_000
    assert step(state, ("b", None, 1)) == []  # a late item does not complete the batch again
    state.hasTimedOut = True
    assert step(state) == [] and not state.exists


def test_an_incomplete_batch_is_reported_once_as_stuck():
    state = State()
    step(state, ("b", 5, 1))
    state.hasTimedOut, state.now = True, state.now + progress.STUCK_MS
    assert step(state) == [("b", "stuck", 5, 1)]
    assert state.timeout is None
    state.hasTimedOut = False
    assert step(state, ("b", None, 4)) == [("b", "complete", 5, 5)]


def test_a_query_with_timers_runs_until_stopped(spark, tmp_path):
    attempts, totals, out = f"{tmp_path}/a", f"{tmp_path}/t", f"{tmp_path}/events"
    put(spark, totals, "batch_id STRING, total BIGINT", [("x", 1)])
    put(spark, attempts, "batch_id STRING", [("x",)])
    signals = progress.signals(
        spark.readStream.schema("batch_id STRING").parquet(attempts),
        spark.readStream.schema("batch_id STRING, total BIGINT").parquet(totals),
    )
    query = sinks.run(
        progress.batch_events(signals),
        lambda b, e: sinks.write_epoch(b, out, e),
        f"{tmp_path}/c",
        every="500 milliseconds",
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (query.lastProgress and query.lastProgress["batchId"] > 1):
            time.sleep(0.5)
            assert query.exception() is None
    finally:
        query.stop()
    assert values(spark.read.parquet(out), "batch_id", "event") == [("x", "complete")]


def test_lease_stream_is_exact_over_micro_batches(spark, tmp_path):
    from datetime import datetime, timedelta

    from tests.test_leases import accepted

    start = datetime(2025, 1, 1)
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
    attempts = [
        (name, seq, start + timedelta(minutes=minute), seq == 4)
        for seq, minute in enumerate((0, 30, 59, 60, 121, 122, 150, 181, 182, 400, 410))
        for name in ("x", "y")
    ]
    for i in range(0, len(attempts), 4):
        put(spark, source, schema, attempts[i : i + 4])
        time.sleep(1.1)  # files are taken up in order of their time
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    sinks.run_to_end(
        windows.accepted_attempts(stream), lambda b, e: sinks.write_epoch(b, out, e), f"{tmp_path}/c"
    )
    got = values(spark.read.parquet(out), "filename", "seq")
    assert got == accepted(attempts)


def test_poll_emits_each_file_once_when_old_enough(spark, tmp_path):
    import os
    from datetime import datetime, timezone

    folder, out = tmp_path / "d", f"{tmp_path}/out"
    folder.mkdir()
    for name, age in (("old.tar", 3600), ("young.tar", 30), ("old.tar.lock", 3600)):
        (folder / name).write_bytes(b"x")
        at = time.time() - age
        os.utime(folder / name, (at, at))
    now = [datetime.now(timezone.utc)]
    each = timers.poll_tick(spark, f"file:{folder}", out, lambda: clock.at(now[0]))
    each(None, 0)
    from datetime import timedelta

    now[0] += timedelta(hours=1)
    each(None, 1)
    each(None, 1)  # a retried tick
    assert values(spark.read.parquet(out), "key", "epoch") == [("old.tar", 0), ("young.tar", 1)]
    os.utime(folder / "old.tar", (time.time() + 600, time.time() + 600))
    late = folder / "late.tar"
    late.write_bytes(b"")
    os.utime(late, (1_000_000_000, 1_000_000_000))  # came in with an old time
    for epoch in (2, 3):
        each(None, epoch)
    now[0] += timedelta(hours=1)
    each(None, 4)
    found = values(spark.read.parquet(out).where("epoch > 1"), "key", "epoch")
    assert found == [("late.tar", 2), ("old.tar", 2)]
    assert sorted(os.listdir(f"{out}-known")) == ["epoch=3", "epoch=4"]


def test_late_rows_correct_their_hour(spark, rows, tmp_path):
    from datetime import datetime, timedelta

    each = windows.hourly_tick(f"{tmp_path}/out", timedelta(hours=1))
    day = datetime(2025, 1, 1)
    batches = [[0, 5], [1, 5, 4, None], [0], [9, 4]]
    for epoch, hours in enumerate(batches):
        data = [(None if h is None else day + timedelta(hours=h, minutes=30),) for h in hours]
        batch = rows("created_at TIMESTAMP_NTZ", data)
        each(batch, epoch)
        each(batch, epoch)  # a retried epoch
    found = windows.hourly_totals(spark.read.parquet(f"{tmp_path}/out"))
    got = {r.hour and r.hour.hour: (r.settled, r.late, r.processed) for r in found.collect()}
    # 5:30 has been seen, so hours up to 3 are late
    assert got == {0: (1, 1, 2), 5: (2, 0, 2), 1: (0, 1, 1), 4: (2, 0, 2), None: (1, 0, 1), 9: (1, 0, 1)}


@pytest.mark.parametrize("limit", [1, 5])
def test_sync_ticks_work_off_the_backlog(spark, rows, tmp_path, limit):
    from tests.test_sync import CREATORS, NOW, REVIEW, make

    items = [(i, f"m{i // 2}", f"u{i}", "US", "t", 0.9, False) for i in range(1, 6)]
    files, texts, flags = make(rows, items)

    def tables():
        return files, texts, flags, rows(REVIEW, [("m0",)]), rows(CREATORS, [(1, "u2", NOW)])

    each = timers.sync_tick(spark, tables, lambda: clock.at(NOW), str(tmp_path), 0.7, limit)
    for epoch in range(6):
        each(None, epoch)
    assert values(spark.read.parquet(f"{tmp_path}/transcripts"), "meta_id") == [("m1",), ("m2",)]
    ids = [i for (i,) in values(spark.read.parquet(f"{tmp_path}/creators"), "creator_id")]
    assert len(ids) == len(set(ids)) and min(ids) > 1
    total = spark.read.parquet(f"{tmp_path}/sync_runs").groupBy().sum("synced_count", "skipped_existing").first()
    assert tuple(total) == (2, 3)


def test_messages_written_as_text_come_back_as_jobs(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    jobs_in = rows("batch_id STRING, n STRING, at TIMESTAMP_NTZ", [("b", 'a "x"\n.tar', None)])
    at = F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'")
    message = jobs.unpack_message("batch_id", F.lit("archives/b.tar"), "n", at)
    jobs.write_messages(jobs_in.select(message.alias("value")), f"{tmp_path}/q")
    stream = jobs.message_stream(spark, f"{tmp_path}/q", "text")
    sinks.run_to_end(stream, job_streams.route_unpack(f"{tmp_path}/o"), f"{tmp_path}/c")
    got = spark.read.parquet(f"{tmp_path}/o/jobs").first()
    assert got.original_filename == 'a "x"\n.tar'
    assert got.transferred_at == "2025-01-01T00:00:00.000000Z"
