"""Streams, run to the end of their input and compared with the batch form in SQL."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from auricle import clock
from auricle.operators import leases
from auricle.plans import reports
from auricle.session import run_dir
from auricle.sources import jobs
from auricle.streaming import jobs as job_streams
from auricle.streaming import batched, ordered, progress, sinks, timers, windows
from auricle_checks import plan_checks, source_checks
from auricle_checks.registry import check
from auricle_checks.sync_checks import SYNC_SUMMARY


def _message_files(t):
    """The messages of the source checks, written as two files."""
    path = run_dir(t.spark, "messages")
    source_checks.messages(t).repartition(2).write.parquet(path)
    return path


def _routed(t, route):
    out = run_dir(t.spark, "routed")
    stream = jobs.message_stream(t.spark, _message_files(t), max_files=1)
    sinks.run_to_end(stream, route(out), f"{out}/checkpoint")
    return out


@check(
    "ST1_scored_micro_batches",
    """SELECT source AS batch_id, count(*) AS scored FROM joined
WHERE event_type NOT IN ('error', 'signup') GROUP BY source""",
)
def _(t):
    out = run_dir(t.spark, "scored-stream")
    stream = jobs.message_stream(t.spark, _message_files(t), max_files=1)

    def load():
        return lambda rows: rows[["opus_path"]].rename(columns={"opus_path": "heard"})

    def score(good):
        return plan_checks.scoring.score_rows(good, load, "heard STRING", "echo")

    each = job_streams.score_micro_batches(score, f"{out}/rows")
    sinks.run_to_end(stream, each, f"{out}/checkpoint")
    rows = sinks.read_epochs(t.spark, f"{out}/rows", "batch_id STRING, opus_path STRING, heard STRING")
    return (
        rows.filter(F.col("heard") == F.col("opus_path"))
        .groupBy("batch_id")
        .agg(F.count("*").alias("scored"))
    )


@check(
    "ST1_counted_batches",
    source_checks.MESSAGES
    + """, jobs AS (
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place FROM messages
    WHERE event_type NOT IN ('error', 'signup')
)
SELECT place // 100 AS epoch, count(*) AS jobs FROM jobs GROUP BY epoch""",
)
def _(t):
    queue, out = run_dir(t.spark, "queue"), run_dir(t.spark, "counted-stream")
    one_line = F.translate("value", "\r\n", "  ").alias("value")
    jobs.write_messages(source_checks.messages(t).select(one_line), queue)
    stream = batched.job_batches(
        t.spark, queue, batch_size=100, first_wait=1, next_wait=0.2, settle=0, together=200
    )
    each = job_streams.route_transcribe_batches(out)
    query = sinks.run(stream, each, f"{out}/checkpoint", every="0 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = sinks.read_epochs(t.spark, f"{out}/jobs", "batch_id STRING")
    return rows.groupBy("epoch").agg(F.count("*").alias("jobs"))


@check(
    "ST2_routed_jobs",
    source_checks.MESSAGES
    + """SELECT source AS batch_id, '/scratch/' || stem || '.opus' AS opus_path FROM messages
WHERE event_type NOT IN ('error', 'signup')""",
)
def _(t):
    out = _routed(t, job_streams.route_transcribe)
    return sinks.read_epochs(t.spark, f"{out}/jobs", "batch_id STRING, opus_path STRING").select(
        "batch_id", "opus_path"
    )


@check(
    "ST2_dead_letters",
    source_checks.MESSAGES
    + "SELECT sha256(value) AS digest FROM messages WHERE event_type = 'error'",
)
def _(t):
    out = _routed(t, job_streams.route_unpack)
    dead = sinks.read_epochs(t.spark, f"{out}/dead", "value STRING")
    return dead.select(F.sha2(F.col("value").cast("binary"), 256).alias("digest"))


# Attempts are the files; a batch's total is its files, one more for batches of a certain size.
PROGRESS = """, attempts AS (
    SELECT archive_source AS batch_id, count(*) AS processed, min(created_at) AS first_seen
    FROM audio_files GROUP BY 1
), totals AS (
    SELECT batch_id, CASE WHEN batch_id < 'src2' THEN processed ELSE processed + 1 END AS total
    FROM attempts WHERE batch_id <> 'src9'
)
"""


def _attempts(t):
    return t.audio_files.select(F.col("archive_source").alias("batch_id"), "created_at")


def _totals(t):
    counts = _attempts(t).groupBy("batch_id").agg(F.count("*").alias("n"))
    whole = F.when(F.col("batch_id") < "src2", F.col("n")).otherwise(F.col("n") + 1)
    return counts.filter(F.col("batch_id") != "src9").select("batch_id", whole.alias("total"))


def _attempt_stream(t):
    path = run_dir(t.spark, "attempts")
    _attempts(t).repartition(2).write.parquet(path)
    return (
        t.spark.readStream.schema("batch_id STRING, created_at TIMESTAMP_NTZ")
        .option("maxFilesPerTrigger", 1)
        .parquet(path)
    )


def _signal_stream(t, out):
    """The attempts and the totals, which are written below `out`, as one stream of signals."""
    _totals(t).coalesce(1).write.parquet(f"{out}/totals")
    totals = t.spark.readStream.schema("batch_id STRING, total BIGINT").parquet(f"{out}/totals")
    return progress.signals(_attempt_stream(t), totals)


def _ticks(t):
    """A stream of two micro-batches that only sets the pace."""
    path = run_dir(t.spark, "ticks")
    t.raw("nation").select("n_nationkey").repartition(2).write.parquet(path)
    return (
        t.spark.readStream.schema("n_nationkey INT").option("maxFilesPerTrigger", 1).parquet(path)
    )


@check(
    "ST3_batch_progress",
    PROGRESS
    + """SELECT batch_id, processed, total, coalesce(processed >= total, false) AS complete
FROM attempts LEFT JOIN totals USING (batch_id)""",
)
def _(t):
    out = run_dir(t.spark, "progress")
    counts = progress.running_progress(_signal_stream(t, out), timers=False)
    sinks.run_to_end(
        counts,
        lambda batch, epoch: sinks.write_epoch(batch, f"{out}/rows", epoch),
        f"{out}/checkpoint",
        rocksdb=True,
    )
    schema = "batch_id STRING, total BIGINT, processed BIGINT, complete BOOLEAN"
    return progress.newest_progress(sinks.read_epochs(t.spark, f"{out}/rows", schema))


@check(
    "ST4_completion_events",
    PROGRESS
    + """SELECT batch_id, 'complete' AS event, total FROM attempts JOIN totals USING (batch_id)
WHERE processed >= total""",
)
def _(t):
    out = run_dir(t.spark, "completion")
    events = progress.batch_events(_signal_stream(t, out), timers=False)
    sinks.run_to_end(
        events,
        lambda batch, epoch: sinks.write_epoch(batch, f"{out}/events", epoch),
        f"{out}/checkpoint",
    )
    schema = "batch_id STRING, event STRING, total BIGINT, processed BIGINT"
    return sinks.read_epochs(t.spark, f"{out}/events", schema).select("batch_id", "event", "total")


# Attempts on a user's file at each of the user's events; an error releases the lease.
LEASES = """WITH RECURSIVE ordered AS (
    SELECT user_id, event_id, ts, event_type = 'error' AS released,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
    FROM events
), walk AS (
    SELECT user_id, step, event_id, true AS accepted,
           CASE WHEN NOT released THEN ts + INTERVAL 60 MINUTES END AS free_at
    FROM ordered WHERE step = 1
    UNION ALL
    SELECT o.user_id, o.step, o.event_id, w.free_at IS NULL OR o.ts >= w.free_at,
           CASE WHEN w.free_at IS NOT NULL AND o.ts < w.free_at THEN w.free_at
                WHEN NOT o.released THEN o.ts + INTERVAL 60 MINUTES END
    FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.step = w.step + 1
)
SELECT 'u' || user_id AS filename, event_id AS seq FROM walk WHERE accepted"""


def _lease_attempts(t):
    return t.raw("events").select(
        F.concat(F.lit("u"), "user_id").alias("filename"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        (F.col("event_type") == "error").alias("released"),
    )


@check("ST5_accepted_attempts", LEASES, whole=True)
def _(t):
    return leases.accepted_attempts(_lease_attempts(t)).select("filename", "seq")


def _lease_stream(t):
    """The attempts in five micro-batches by time, through the stateful stream."""
    out = run_dir(t.spark, "lease-stream")
    attempts = _lease_attempts(t)
    first, last = attempts.agg(F.min("at"), F.max("at")).first()
    bounds = [first + (last - first) * k / 5 for k in range(5)] + [last + timedelta(seconds=1)]
    for begin, end in zip(bounds, bounds[1:]):
        # the stream goes on from its checkpoint, with all files of one part as a micro-batch
        part = attempts.where((F.col("at") >= F.lit(begin)) & (F.col("at") < F.lit(end)))
        part.write.mode("append").parquet(f"{out}/attempts")
        stream = t.spark.readStream.schema(
            "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
        ).parquet(f"{out}/attempts")
        sinks.run_to_end(
            windows.accepted_attempts(stream),
            lambda batch, epoch: sinks.write_epoch(batch, f"{out}/rows", epoch),
            f"{out}/checkpoint",
        )
    return sinks.read_epochs(t.spark, f"{out}/rows", "filename STRING, seq BIGINT, at TIMESTAMP_NTZ")


@check("ST5_lease_stream", LEASES, whole=True)
def _(t):
    return _lease_stream(t).select("filename", "seq")


@check("ST5_shuffled_lease_stream", LEASES, whole=True)
def _(t):
    """The attempts in three micro-batches by a hash, so each one brings times that others have
    passed, and a last one that moves the clock on."""
    out = run_dir(t.spark, "shuffled-leases")
    attempts = _lease_attempts(t)
    first, last = attempts.agg(F.min("at"), F.max("at")).first()
    after = attempts.limit(1).select(
        F.lit(None).cast("string").alias("filename"),
        "seq",
        F.lit(last + 2 * (last - first) + timedelta(hours=3)).cast("timestamp_ntz").alias("at"),
        "released",
    )
    part = F.pmod(F.xxhash64("seq"), F.lit(3))
    files = t.spark.sparkContext.defaultParallelism  # of a part, which is a micro-batch
    for rows in [*(attempts.where(part == k) for k in range(3)), after]:
        rows.repartition(files).write.mode("append").parquet(f"{out}/attempts")
        time.sleep(1.1)  # files are taken up in order of their time
    stream = (
        t.spark.readStream.schema(
            "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
        )
        .option("maxFilesPerTrigger", files)
        .parquet(f"{out}/attempts")
    )
    sinks.run_to_end(
        ordered.accepted_attempts(stream, last - first + timedelta(hours=1), timedelta(days=7)),
        lambda batch, epoch: sinks.write_epoch(batch, f"{out}/rows", epoch),
        f"{out}/checkpoint",
        rocksdb=True,
    )
    return sinks.read_epochs(t.spark, f"{out}/rows", "filename STRING, seq BIGINT").select(
        "filename", "seq"
    )


@check(
    "ST5_first_attempt_stream",
    """SELECT 'u' || user_id AS filename, min(ts) AS at, arg_min(event_id, (ts, event_id)) AS seq
FROM events GROUP BY user_id""",
)
def _(t):
    rows = _lease_stream(t)
    first = rows.groupBy("filename").agg(F.min(F.struct("at", "seq")).alias("a"))
    return first.select("filename", "a.at", "a.seq")


@check(
    "ST5_one_file_released",
    "SELECT 'all' AS filename, count(*) AS accepted, min(event_id) AS least FROM events",
)
def _(t):
    attempts = t.raw("events").select(
        F.lit("all").alias("filename"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        F.lit(True).alias("released"),
    )
    taken = leases.accepted_attempts(attempts)
    return taken.groupBy("filename").agg(
        F.count("*").alias("accepted"), F.min("seq").alias("least")
    )


@check("ST6_incremental_sync", SYNC_SUMMARY.replace("<= 100", "<= 500"))
def _(t):
    out = run_dir(t.spark, "sync")

    def tables():
        return t.audio_files, t.transcripts, t.classifications, t.review_rows, t.creators

    each = timers.sync_tick(t.spark, tables, lambda: t.as_of, out)
    sinks.run_to_end(_ticks(t), each, f"{out}-checkpoint")
    runs = t.spark.read.parquet(f"{out}/sync_runs")
    return runs.agg(*[F.sum(c).alias(c) for c in ("synced_count", "skipped_existing", "errors")])


@check(
    "ST7_stuck_batches",
    PROGRESS
    + """SELECT batch_id, processed, total FROM attempts JOIN totals USING (batch_id)
WHERE processed < total AND first_seen < (SELECT t FROM now_) - INTERVAL 120 MINUTES""",
)
def _(t):
    seen = _attempts(t).groupBy("batch_id").agg(
        F.count("*").alias("processed"), F.min("created_at").alias("first_seen")
    )
    state = seen.join(_totals(t), "batch_id", "left")
    return reports.stuck_batches(state, t.as_of).select("batch_id", "processed", "total")


@check(
    "ST8_polled_directory",
    source_checks.PLACES
    + """SELECT key, length, CASE WHEN length = 0 THEN 2 ELSE 1 END AS epoch FROM placed""",
)
def _(t):
    """Four ticks: nothing is old enough, the first objects are, the others have come since (with
    lock files), and nothing new."""
    out = run_dir(t.spark, "polled")
    root = source_checks.placed_objects(t, F.length("text") > 0)
    start = datetime.now(timezone.utc)
    moments = [start, start + timedelta(hours=1), start + timedelta(hours=2), start + timedelta(hours=3)]
    for epoch, moment in enumerate(moments):
        if epoch == 2:
            source_checks.placed_objects(t, F.length("text") == 0, root)
            source_checks.placed_objects(t, F.length("text") == 0, root, ".tar.lock")
        each = timers.poll_tick(t.spark, root, f"{out}/files", lambda: clock.at(moment))
        each(None, epoch)
        each(None, epoch)  # as after a failure
    return sinks.read_epochs(t.spark, f"{out}/files", "key STRING, length BIGINT")


# Events in three micro-batches by user, so each one brings times that the others have passed.
@check(
    "ST9_late_rows",
    """, batches AS (
    SELECT *, user_id % 3 AS batch, date_trunc('hour', ts) AS hour FROM events
), seen AS (
    SELECT b.batch, max(e.ts) AS seen FROM (SELECT DISTINCT batch FROM batches) b
    LEFT JOIN batches e ON e.batch < b.batch GROUP BY 1
), judged AS (
    SELECT hour, coalesce(hour + INTERVAL 1 HOUR <= seen - INTERVAL 2 HOUR, false) AS late
    FROM batches JOIN seen USING (batch)
)
SELECT hour::TIMESTAMP AS hour, count(*) FILTER (NOT late) AS settled, count(*) FILTER (late) AS late,
       count(*) AS processed FROM judged GROUP BY 1""",
)
def _(t):
    out = run_dir(t.spark, "late")
    events = t.raw("events").select(F.col("ts").alias("created_at"), (F.col("user_id") % 3).alias("part"))
    for part in range(3):
        rows = events.where(F.col("part") == part).select("created_at").coalesce(1)
        rows.write.mode("append").parquet(f"{out}/files")
        time.sleep(1.1)  # files are taken up in order of their time
    stream = (
        t.spark.readStream.schema("created_at TIMESTAMP_NTZ")
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{out}/files")
    )
    each = windows.hourly_tick(f"{out}/rows", timedelta(hours=2))
    sinks.run_to_end(stream, each, f"{out}/checkpoint")
    rows = sinks.read_epochs(
        t.spark, f"{out}/rows", "hour TIMESTAMP_NTZ, late BOOLEAN, processed BIGINT"
    )
    return windows.hourly_totals(rows)


@check(
    "ST9_hourly_stream",
    "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS processed FROM events GROUP BY 1",
)
def _(t):
    out = run_dir(t.spark, "hourly")
    t.raw("events").select(F.col("ts").alias("created_at")).write.parquet(f"{out}/files")
    stream = t.spark.readStream.schema("created_at TIMESTAMP_NTZ").parquet(f"{out}/files")
    sinks.run_to_end(
        windows.hourly_counts(stream, "1 hour"),
        lambda batch, epoch: sinks.write_epoch(batch, f"{out}/rows", epoch),
        f"{out}/checkpoint",
        "update",
    )
    rows = sinks.read_epochs(t.spark, f"{out}/rows", "hour TIMESTAMP_NTZ, processed BIGINT")
    return sinks.newest_per_key(rows, ["hour"], "processed")
