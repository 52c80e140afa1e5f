import time
from datetime import timedelta

from auricle.streaming import progress, sinks
from tests.conftest import values

SIGNAL = "batch_id STRING, total BIGINT, processed BIGINT"


def put(spark, folder, data):
    spark.createDataFrame(data, SIGNAL).coalesce(1).write.mode("append").parquet(folder)


def batches_held(spark, checkpoint, name):
    rows = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    return sorted(r.key.batch_id for r in rows.select("key").collect())


def wait(until, query, seconds=60):
    deadline = time.time() + seconds
    while time.time() < deadline and not until():
        assert query.exception() is None
        time.sleep(0.5)
    assert until()


def test_complete_batches_leave_no_state(spark, tmp_path):
    source, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"
    schema = "batch_id STRING, total BIGINT, processed BIGINT, complete BOOLEAN"
    put(spark, source, [("done", 2, 0), ("done", None, 1), ("open", 5, 3), (None, 1, 1)])
    query = sinks.run(
        progress.running_progress(
            spark.readStream.schema(SIGNAL).parquet(source), keep_done=timedelta(seconds=4)
        ),
        lambda batch, epoch: sinks.write_epoch(batch, out, epoch),
        checkpoint,
        every="500 milliseconds",
    )
    try:
        wait(lambda: query.lastProgress and query.lastProgress["batchId"] > 0, query)
        assert batches_held(spark, checkpoint, "open") == ["done", "open"]
        put(spark, source, [("done", None, 1)])
        wait(lambda: batches_held(spark, checkpoint, "open") == ["open"], query)
        wait(lambda: batches_held(spark, checkpoint, "done") == [], query)
    finally:
        query.stop()
    found = progress.newest_progress(sinks.read_epochs(spark, out, schema))
    assert values(found, "batch_id", "total", "processed", "complete") == [
        ("done", 2, 2, True), ("open", 5, 3, False)
    ]
    assert values(spark.read.parquet(out), "batch_id", "processed") == [("done", 1), ("done", 2), ("open", 3)]


def test_late_signals_and_missing_totals(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    parts = [[("a", None, 2), ("b", None, 1)], [("a", 2, 0)], [("a", None, 1), ("b", None, 1)]]
    for part in parts:
        put(spark, source, part)
        time.sleep(1.1)  # files are taken up in order of their time
    stream = spark.readStream.schema(SIGNAL).option("maxFilesPerTrigger", 1).parquet(source)
    sinks.run_to_end(
        progress.running_progress(stream, timers=False),
        lambda batch, epoch: sinks.write_epoch(batch, out, epoch),
        f"{tmp_path}/c",
    )
    rows = spark.read.parquet(out)
    assert values(rows.where("batch_id = 'a'"), "total", "processed", "complete") == [
        (2, 2, True), (2, 3, True), (None, 2, False)
    ]
    assert values(progress.newest_progress(rows), "batch_id", "processed") == [("a", 3), ("b", 2)]
