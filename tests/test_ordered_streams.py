import random
import time
from datetime import datetime, timedelta

import numpy as np
import pytest

from auricle.operators import leases
from auricle.streaming import ordered, sinks
from tests.conftest import values
from tests.test_leases import accepted

SCHEMA = "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
START = datetime(2025, 1, 1)


def stream_of(spark, folder, batches):
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken up in order of their time
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def run(stream, tmp_path):
    out = f"{tmp_path}/out"
    query = sinks.run(stream, lambda b, e: sinks.write_epoch(b, out, e), f"{tmp_path}/c")
    query.awaitTermination()
    return stream.sparkSession.read.parquet(out), query


def held(spark, tmp_path, name):
    return spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/c").count()


def test_shuffled_attempts_equal_the_batch_form(spark, tmp_path):
    draw = random.Random(5)
    attempts = [
        (f"f{draw.randrange(4)}", i, START + timedelta(seconds=draw.randrange(20 * 3600)), draw.random() < 0.3)
        for i in range(500)
    ]
    attempts += [("f0", 500 + i, START + timedelta(hours=2), i == 1) for i in range(3)]  # one moment
    attempts.append(("f1", 503, START + timedelta(hours=3), None))
    # in the order of their times, each moved by less than the delay
    moved = sorted(attempts, key=lambda a: a[2] + timedelta(seconds=draw.randrange(3 * 3600)))
    cuts = [moved[i : i + 126] for i in range(0, len(moved), 126)]
    clock = [(None, None, START + timedelta(hours=40), None), ("f9", 1, None, False)]
    stream = stream_of(spark, f"{tmp_path}/in", [*cuts, clock])
    got, _ = run(ordered.accepted_attempts(stream, timedelta(hours=3)), tmp_path)
    whole = leases.accepted_attempts(spark.createDataFrame(attempts, SCHEMA))
    assert values(got, "filename", "seq", "at") == values(whole, "filename", "seq", "at")
    assert values(got, "filename", "seq") == accepted([(*a[:3], bool(a[3])) for a in attempts])
    assert held(spark, tmp_path, "held") == 0 and held(spark, tmp_path, "free_at") == 0


def test_rows_later_than_the_delay_are_refused_and_counted(spark, tmp_path):
    def at(seq, minutes):
        return ("x", seq, START + timedelta(minutes=minutes), False)

    clock = (None, 9, START + timedelta(minutes=610), None)
    # rows are held against the watermark of the micro-batch before
    batches = [[at(0, 0)], [at(1, 600)], [clock], [at(2, 100), at(3, 650)], [at(4, 2000)]]
    stream = stream_of(spark, f"{tmp_path}/in", batches)
    got, query = run(ordered.accepted_attempts(stream, timedelta(hours=1)), tmp_path)
    # the last attempt waits for the clock, 650 lies within the lease of 600
    assert values(got, "seq") == [(0,), (1,)]
    dropped = sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"]
    )
    assert dropped == 1
    assert held(spark, tmp_path, "held") == 1


@pytest.mark.parametrize("seed", range(20))
def test_judging_goes_on_over_slots(seed):
    draw = random.Random(seed)
    rows = sorted((draw.randrange(30) * leases.LEASE_MICROS // 4, i) for i in range(draw.randrange(1, 60)))
    released = [draw.random() < 0.4 for _ in rows]
    free, plain = None, []
    for i, (at, _) in enumerate(rows):
        if free is None or at >= free:
            plain.append(i)
            free = None if released[i] else at + leases.LEASE_MICROS
    found, until, begin = [], None, 0
    while begin < len(rows):
        end = begin + draw.randrange(1, 9)
        part = np.array([at for at, _ in rows[begin:end]])
        keep, until = ordered.judge(part, np.array(released[begin:end]), until)
        found += (keep + begin).tolist()
        begin = end
    assert found == plain


@pytest.mark.parametrize("seed", range(10))
def test_many_files_are_judged_as_each_alone(seed):
    draw = random.Random(seed)
    rows = sorted(
        (draw.randrange(5), draw.randrange(-20, 20) * leases.LEASE_MICROS // 4, i)
        for i in range(draw.randrange(1, 200))
    )
    files, at, released = np.array([(f, a, draw.random() < 0.4) for f, a, _ in rows]).T
    released = released.astype(bool)
    free = [draw.choice([None, draw.randrange(-5, 5) * leases.LEASE_MICROS]) for _ in range(6)]
    none = np.iinfo(np.int64).min
    keep, after = ordered.judge_files(files, at, released, np.array([none if f is None else f for f in free]))
    found = []
    for file in range(6):
        own = np.flatnonzero(files == file)
        mine, until = ordered.judge(at[own], released[own], free[file])
        found += own[mine].tolist()
        if len(own[mine]):
            assert after[file] == (none if until is None else until)
        else:
            assert after[file] == (none if free[file] is None else free[file])
    assert keep.tolist() == found


def test_files_share_the_state_of_their_group(spark, tmp_path, monkeypatch):
    """Steps over the state follow the groups and slots, not the files."""
    monkeypatch.setattr(ordered, "GROUPS", 3, raising=False)
    draw = random.Random(6)
    attempts = [
        (f"f{draw.randrange(200)}", i, START + timedelta(seconds=draw.randrange(4 * 3600)), draw.random() < 0.3)
        for i in range(1000)
    ]
    attempts += [("f1", 1000, START, None), ("é\x00,", 1001, START, False), ("", 1002, START, False)]
    batches = [attempts[i::2] for i in range(2)]
    delay, slot = timedelta(hours=5), timedelta(days=1)
    got, _ = run(ordered.accepted_attempts(stream_of(spark, f"{tmp_path}/in", batches), delay, slot), tmp_path)
    assert got.count() == 0 and held(spark, tmp_path, "held") <= 2 * 3
    stream = stream_of(spark, f"{tmp_path}/in", [[(None, None, START + timedelta(days=3), None)]])
    got, _ = run(ordered.accepted_attempts(stream, delay, slot), tmp_path)
    assert values(got, "filename", "seq") == accepted([(*a[:3], bool(a[3])) for a in attempts])
    assert held(spark, tmp_path, "held") == 0 and held(spark, tmp_path, "free_at") == 0
