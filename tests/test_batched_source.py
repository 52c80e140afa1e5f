import json
import os
import threading
import time

import pytest

from auricle.sources import jobs
from auricle.streaming import batched, sinks
from auricle.streaming import jobs as job_streams


def job(k):
    return json.dumps({"batch_id": "b", "opus_path": f"/{k}"})


def put(folder, name, lines, end="\n"):
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/.{name}"
    with open(hidden, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + (end if lines else ""))
    os.rename(hidden, f"{folder}/{name}")


def options(folder, **more):
    return {"path": str(folder), "first_wait": "0.2", "next_wait": "0.1", "settle": "0", **more}


def stream(spark, folder, **more):
    settings = {"batch_size": 4, "first_wait": 0.3, "next_wait": 0.1, "settle": 0} | more
    return batched.job_batches(spark, str(folder), **settings)


def drain(frame, each, checkpoint):
    query = sinks.run(frame, each, str(checkpoint), every="0 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_batches_hold_at_most_the_jobs_asked_for(spark, tmp_path):
    lines = [job(k) for k in range(10)]
    put(tmp_path / "in", "a", [lines[0], "{broken", "", *lines[1:6]])
    put(tmp_path / "in", "b", [])
    put(tmp_path / "in", "c", [*lines[6:], "[1]", "é x"], end="")
    out = str(tmp_path / "out")
    drain(stream(spark, tmp_path / "in"), job_streams.route_transcribe(out), tmp_path / "c")
    good = sinks.read_epochs(spark, f"{out}/jobs", "opus_path STRING").collect()
    sizes = [sum(r["epoch"] == e for r in good) for e in sorted({r["epoch"] for r in good})]
    assert sizes == [4, 4, 2]
    assert sorted(r["opus_path"] for r in good) == [f"/{k}" for k in range(10)]
    rejected = sinks.read_epochs(spark, f"{out}/rejected", "value STRING").collect()
    assert sorted(r["value"] for r in rejected) == sorted(["{broken", "", "[1]", "é x"])


def test_a_failed_batch_comes_again_as_it_was(spark, tmp_path):
    put(tmp_path / "in", "a", [job(k) for k in range(6)])
    seen = []

    def each(batch, epoch):
        seen.append((epoch, sorted(r["value"] for r in batch.collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain(stream(spark, tmp_path / "in"), each, tmp_path / "c")
    put(tmp_path / "in", "b", [job(k) for k in range(6, 9)])
    put(tmp_path / "in", "0", [job(k) for k in range(9, 10)])
    os.utime(tmp_path / "in/0", ns=(0, 1))  # a file that claims to be older than all others
    drain(stream(spark, tmp_path / "in"), each, tmp_path / "c")
    assert seen[1] == seen[2] == (1, [job(4), job(5)])
    assert [v for _, values in seen[3:] for v in values] == [job(k) for k in range(6, 9)]


def test_a_restart_after_a_finished_batch_goes_on_behind_it(spark, tmp_path):
    put(tmp_path / "in", "a", [job(k) for k in range(5)])
    seen = []

    def each(batch, epoch):
        seen.append((epoch, sorted(r["value"] for r in batch.collect())))

    for k in range(3):
        drain(stream(spark, tmp_path / "in"), each, tmp_path / "c")
        put(tmp_path / "in", f"b{k}", [job(10 + k)])
    got = [value for _, values in seen for value in values]
    assert got == [job(k) for k in (0, 1, 2, 3, 4, 10, 11)]
    assert [epoch for epoch, _ in seen] == list(range(len(seen)))


def test_the_next_message_is_waited_for_once_there_is_a_job(tmp_path):
    put(tmp_path, "a", [job(0)])
    reader = batched.JobReader(options(tmp_path, next_wait="5", batch_size="3"))
    later = threading.Timer(0.3, put, (tmp_path, "b", [job(1), job(2), job(3)]))
    later.start()
    end = reader.latestOffset()
    later.join()
    parts = reader.partitions(reader.initialOffset(), end)
    assert [v for p in parts for (v,) in reader.read(p)] == [job(0), job(1), job(2)]
    follower = reader.latestOffset()
    assert [v for p in reader.partitions(end, follower) for (v,) in reader.read(p)] == [job(3)]


def test_nothing_in_time_gives_the_same_offset(tmp_path):
    reader = batched.JobReader(options(tmp_path / "none"))
    begin = time.monotonic()
    assert reader.latestOffset() == reader.initialOffset()
    assert 0.2 <= time.monotonic() - begin < 5


def test_files_are_left_alone_until_they_have_settled(tmp_path):
    put(tmp_path, "a", [job(0)])
    assert batched.JobReader(options(tmp_path, settle="60")).latestOffset()["number"] == 0
    assert batched.JobReader(options(tmp_path)).latestOffset()["number"] == 1


def test_invalid_lines_are_bounded_too(tmp_path, monkeypatch):
    monkeypatch.setattr(batched, "MOST_LINES", 3)
    put(tmp_path, "a", ["x"] * 7)
    reader = batched.JobReader(options(tmp_path))
    ends = [reader.latestOffset()["at"] for _ in range(4)]
    assert ends == [6, 12, 14, 14]


def test_offsets_that_do_not_follow_are_refused(tmp_path):
    put(tmp_path, "a", [job(k) for k in range(4)])
    reader = batched.JobReader(options(tmp_path, batch_size="1"))
    reader.latestOffset()
    with pytest.raises(ValueError, match="does not follow"):
        reader.partitions(reader.initialOffset(), reader.latestOffset())


@pytest.mark.parametrize("line, valid", [
    ('{"batch_id":"b","opus_path":"/x"}', True), ('{"batch_id":"b"}', False),
    ('{"batch_id":null,"opus_path":"/x"}', False), ("[]", False), ("", False), ("\ud83d", False),
])
def test_the_source_counts_what_the_router_accepts(spark, line, valid):
    assert batched.is_job(line.encode("utf-8", "surrogatepass")) is valid
    if "\ud83d" not in line:
        good, _ = jobs.transcribe_jobs(spark.createDataFrame([(line,)], "value STRING"))
        assert (good.count() == 1) is valid


def test_full_batches_that_wait_come_together(spark, tmp_path):
    put(tmp_path / "in", "a", [job(0), "{broken", *[job(k) for k in range(1, 6)]])
    put(tmp_path / "in", "b", [job(k) for k in range(6, 21)])
    out, seen = str(tmp_path / "out"), []
    route = job_streams.route_transcribe_batches(out)

    def each(batch, epoch):
        seen.append(epoch)
        route(batch, epoch)
        route(batch, epoch)  # as after a failure

    drain(stream(spark, tmp_path / "in", together=3), each, tmp_path / "c")
    good = sinks.read_epochs(spark, f"{out}/jobs", "opus_path STRING").collect()
    assert sorted((r["epoch"], r["opus_path"]) for r in good) == sorted(
        (k // 4, f"/{k}") for k in range(21)
    )
    rejected = sinks.read_epochs(spark, f"{out}/rejected", "value STRING").collect()
    assert [(r["epoch"], r["value"]) for r in rejected] == [(0, "{broken")]
    assert seen == [0, 1, 2]


def test_a_batch_that_is_not_full_is_left_for_the_next_micro_batch(tmp_path):
    put(tmp_path, "a", [job(k) for k in range(5)])
    put(tmp_path, "b", [job(5)])
    put(tmp_path, "c", [job(6)])
    reader = batched.JobReader(options(tmp_path, batch_size="4", together="3"))
    begin, first, second = reader.initialOffset(), reader.latestOffset(), reader.latestOffset()

    def rows(start, end):
        return [row for p in reader.partitions(start, end) for row in reader.read(p)]

    assert rows(begin, first) == [(job(k), 0) for k in range(4)]
    assert rows(first, second) == [(job(k), 1) for k in (4, 5, 6)]
