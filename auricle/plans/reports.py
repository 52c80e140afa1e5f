"""Verification and health reports, each section a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.operators import aggregates, filters, joins
from auricle.plans import queues

# Alert limits of the health report.
UNPACK_DEPTH = 100
TRANSCRIBE_DEPTH = 1000
FLAGGED_TARGET = 200
TARGET_HOURS = (10, 12)


def verify_batch(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame, pattern: str
) -> dict[str, DataFrame]:
    """Sections for the batches that match a pattern: status counts, coverage, details, issues."""
    matching = filters.in_batches(files, pattern)
    statuses = aggregates.batch_status_counts(matching)
    texts = aggregates.transcript_coverage(matching, transcripts)
    flags = aggregates.classification_coverage(matching, classifications)
    return {
        "audio_files": statuses.select(
            S.composite_key("archive_source", "status").alias("key"), "count"
        ),
        "transcripts": texts,
        "classifications": flags,
        "details": queues.file_details(files, transcripts, classifications, pattern),
        "issues": _issues(matching, texts, flags),
    }


def _issues(matching: DataFrame, texts: DataFrame, flags: DataFrame) -> DataFrame:
    """One row of text per problem."""
    batch = F.col("archive_source")
    empty = (
        matching.agg(F.count("*").alias("n"))
        .filter("n = 0")
        .select(F.lit("No audio files found").alias("issue"))
    )
    no_text = texts.filter("missing_transcript > 0").select(
        F.concat(F.lit("Missing transcripts in "), batch).alias("issue")
    )
    no_flag = flags.filter("missing_classification > 0").select(
        F.concat(F.lit("Missing classifications in "), batch).alias("issue")
    )
    return empty.unionByName(no_text).unionByName(no_flag)


def verify_recent(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    as_of: Column,
    hours: int = 24,
) -> dict[str, DataFrame]:
    window = f"{hours} HOURS"
    return {
        "stats": aggregates.counts_by(clock.recent(files, as_of, window), "status"),
        "completeness": aggregates.completeness(
            files, transcripts, classifications, as_of, window
        ),
        "batches": aggregates.recent_batches(files, as_of, window),
    }


def overall_stats(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame, as_of: Column
) -> dict[str, DataFrame]:
    hourly = aggregates.hourly_rate(files, as_of, limit=24)
    return {
        "totals": aggregates.table_totals(files, transcripts, classifications),
        "hourly": hourly.select(
            F.date_format("hour", "yyyy-MM-dd HH:00").alias("hour"),
            F.col("processed").alias("count"),
        ),
        "status_counts": aggregates.status_counts(files),
    }


def stuck_batches(progress: DataFrame, as_of: Column, idle: str = "120 MINUTES") -> DataFrame:
    """Batches still incomplete that were first seen longer ago than `idle`.

    `progress` has (batch_id, processed, total, first_seen).
    """
    return progress.filter(
        F.col("total").isNotNull()
        & (F.col("processed") < F.col("total"))
        & (F.col("first_seen") < clock.before(as_of, idle))
    )


def health_metrics(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    depths: DataFrame,
    scratch: DataFrame,
    as_of: Column,
) -> DataFrame:
    """(metric, value) rows: queue depths, 24-hour counts, review queue, scratch use.

    `depths` has (queue, depth); `scratch` is a listing.
    """
    day = clock.recent(files, as_of).agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    flagged = aggregates.flagged_span(files, classifications, as_of).select(
        F.col("flagged_count").alias("flagged")
    )
    queue = queues.flagged_queue(
        files, transcripts, classifications, as_of, ordered=False
    ).agg(F.count("*").alias("review_queue"))
    used = aggregates.scratch_usage(scratch, as_of)
    waiting = depths.select(
        F.concat(F.lit("queue:"), "queue").alias("metric"),
        F.col("depth").cast("long").alias("value"),
    )
    for single in (day, flagged, queue, used):
        waiting = waiting.unionByName(single.unpivot([], single.columns, "metric", "value"))
    return waiting


def health_alerts(metrics: DataFrame, as_of: Column) -> DataFrame:
    """Metrics beyond their limit, with the message for the operator."""
    value = F.col("value")
    metric = F.col("metric")
    first, last = TARGET_HOURS
    in_hours = (F.hour(as_of) >= first) & (F.hour(as_of) < last)
    message = (
        F.when(
            (metric == "queue:unpack") & (value > UNPACK_DEPTH),
            f"Unpack queue backed up (>{UNPACK_DEPTH})",
        )
        .when(
            (metric == "queue:transcribe") & (value > TRANSCRIBE_DEPTH),
            f"Transcribe queue backed up (>{TRANSCRIBE_DEPTH})",
        )
        .when(
            (metric == "old_directories") & (value > 0),
            "Old scratch directories detected - may indicate stuck batches",
        )
        .when(
            (metric == "flagged") & (value < FLAGGED_TARGET) & in_hours,
            F.concat(
                F.lit("Only "),
                value.cast("string"),
                F.lit(f" flagged items. Target is {FLAGGED_TARGET} by noon"),
            ),
        )
    )
    return metrics.withColumn("alert", message).filter(F.col("alert").isNotNull())


def verify_unpack(
    batches: DataFrame, listing: DataFrame, totals: DataFrame, jobs: DataFrame, scratch: DataFrame
) -> DataFrame:
    """Per batch (batch_id, s3_key): archive present, total set, jobs queued, opus files."""
    stored = listing.filter(F.col("length") > 0).select(
        F.col("key").alias("s3_key"), F.lit(True).alias("archive_present")
    )
    queued = jobs.groupBy("batch_id").agg(F.count("*").alias("queued_jobs"))
    opus = (
        scratch.filter(F.col("key").endswith(".opus"))
        .groupBy(F.element_at(F.split("key", "/"), 1).alias("batch_id"))
        .agg(F.count("*").alias("opus_files"))
    )
    joined = (
        batches.select("batch_id", "s3_key")
        .join(stored, "s3_key", "left")
        .join(totals.select("batch_id", F.col("total").alias("batch_total")), "batch_id", "left")
        .join(queued, "batch_id", "left")
        .join(opus, "batch_id", "left")
    )
    present = F.coalesce("archive_present", F.lit(False))
    return joined.select(
        "batch_id",
        present.alias("archive_present"),
        F.col("batch_total").isNotNull().alias("total_set"),
        "batch_total",
        F.coalesce("queued_jobs", F.lit(0)).alias("queued_jobs"),
        F.coalesce("opus_files", F.lit(0)).alias("opus_files"),
        (present & F.col("batch_total").isNotNull()).alias("success"),
    )


def verify_results(
    expected: DataFrame,
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    listing: DataFrame,
) -> DataFrame:
    """Per batch (batch_id, expected): rows in each table, objects, and whether all agree.

    Only files of the expected batches take part: child rows are bounded by their ids and counted
    per file before the join, so the text never takes part.
    """
    batches = expected.select(F.col("batch_id").alias("archive_source")).distinct()
    files = files.join(batches, "archive_source", "left_semi")
    own = files.select("id", F.col("archive_source").alias("batch_id"), "original_filename")
    texts = (
        filters.within_ids(transcripts, files)
        .groupBy(F.col("audio_file_id").alias("id"))
        .agg(F.count("*").alias("t"))
    )
    flags = (
        filters.within_ids(classifications, files)
        .groupBy(F.col("audio_file_id").alias("id"))
        .agg(F.count("*").alias("c"))
    )
    objects = (
        joins.keys_of_files(listing, files)
        .groupBy(F.col("audio_file_id").alias("id"))
        .agg(F.count("*").alias("o"))
    )
    counts = (
        own.join(texts, "id", "left")
        .join(flags, "id", "left")
        .join(objects, "id", "left")
        .groupBy("batch_id")
        .agg(
            F.count("*").alias("audio_files"),
            F.coalesce(F.sum("t"), F.lit(0)).alias("transcripts"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("classifications"),
            F.coalesce(F.sum("o"), F.lit(0)).alias("s3_files"),
        )
    )
    names = ["audio_files", "transcripts", "classifications", "s3_files"]
    agree = F.lit(True)
    for name in names[:3]:
        agree = agree & (F.col(name) == F.col("expected"))
    return (
        expected.join(counts, "batch_id", "left")
        .fillna(0, names)
        .withColumn("success", agree)
    )
