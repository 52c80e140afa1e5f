"""Counts, rates and coverage over the content tables.

Every aggregate combines on the map side, so a hot status, batch or language costs one partial
row per task. Joins bring only the columns the aggregate reads; the transcript text is touched
by its length alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.operators import filters

# The statuses of the daily report, in report order.
DAILY_STATUSES = ("pending", "transcribed", "classified", "synced", "failed")


def _classified(files: DataFrame, classifications: DataFrame) -> DataFrame:
    """Files with their classifications, reduced to what the counts read."""
    return files.select("id", "created_at").join(
        filters.within_ids(classifications, files).select("audio_file_id", "flagged", "flag_score", "flag_category"),
        F.col("id") == F.col("audio_file_id"),
    )


def rolling_totals(files: DataFrame, as_of: Column) -> DataFrame:
    """One row: processed, flagged, synced, flagged but unsynced, over 24 hours."""
    flagged = F.col("status") == "flagged"
    return clock.recent(files, as_of).agg(
        F.count("*").alias("total_processed"),
        F.count_if(flagged).alias("flagged_count"),
        F.count_if("synced_to_ra").alias("synced_count"),
        F.count_if(flagged & ~F.col("synced_to_ra")).alias("pending_sync"),
    )


def daily_status_counts(files: DataFrame, as_of: Column) -> DataFrame:
    return (
        clock.recent(files, as_of, "7 DAYS")
        .groupBy(S.day("created_at").alias("date"), "status")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc_nulls_first("date"), F.asc_nulls_last("status"))
    )


def daily_pivot(files: DataFrame, as_of: Column) -> DataFrame:
    """One row per day with a column per status."""
    return (
        clock.recent(files, as_of, "7 DAYS")
        .groupBy(S.day("created_at").alias("date"))
        .agg(
            F.count("*").alias("total_files"),
            *[F.count_if(F.col("status") == s).alias(s) for s in DAILY_STATUSES],
        )
        .orderBy(F.desc_nulls_first("date"))
    )


def counts_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), *[F.asc_nulls_last(k) for k in keys])
    )


def status_counts(files: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Files per status, of the last 24 hours when `as_of` is given."""
    return counts_by(files if as_of is None else clock.recent(files, as_of), "status")


def classification_totals(
    files: DataFrame, classifications: DataFrame, as_of: Column
) -> DataFrame:
    joined = _classified(clock.recent(files, as_of), classifications)
    return joined.agg(
        F.count_if("flagged").alias("flagged_count"), F.count("*").alias("total_classified")
    )


def flagged_span(files: DataFrame, classifications: DataFrame, as_of: Column) -> DataFrame:
    """Flagged files of 24 hours: how many, first and last time."""
    joined = _classified(clock.recent(files, as_of), classifications.filter("flagged"))
    return joined.agg(
        F.count("*").alias("flagged_count"),
        F.min("created_at").alias("earliest"),
        F.max("created_at").alias("latest"),
    )


def hourly_rate(
    files: DataFrame, as_of: Column, interval: str = "24 HOURS", limit: int | None = None
) -> DataFrame:
    """Files per hour, newest hour first."""
    hours = (
        clock.recent(files, as_of, interval)
        .groupBy(S.hour("created_at").alias("hour"))
        .agg(F.count("*").alias("processed"))
        .orderBy(F.desc_nulls_first("hour"))
    )
    return hours if limit is None else hours.limit(limit)


def hourly_labels(files: DataFrame, as_of: Column) -> DataFrame:
    """The last six hours with the hour as text."""
    hours = hourly_rate(files, as_of, "6 HOURS")
    return hours.select(
        S.hour_label("hour").alias("hour"), F.col("processed").alias("files")
    )


def category_scores(files: DataFrame, classifications: DataFrame, as_of: Column) -> DataFrame:
    joined = _classified(clock.recent(files, as_of), classifications.filter("flagged"))
    return (
        joined.groupBy("flag_category")
        .agg(
            F.count("*").alias("count"),
            S.round_half_up(F.avg("flag_score"), 3).alias("avg_score"),
        )
        .orderBy(F.desc("count"), F.asc_nulls_last("flag_category"))
    )


def archive_counts(files: DataFrame, as_of: Column, limit: int = 20) -> DataFrame:
    return counts_by(
        clock.recent(files, as_of), "archive_source", name="file_count"
    ).limit(limit)


def volume(files: DataFrame, as_of: Column) -> DataFrame:
    """GiB in total, mean KiB, mean duration, over 24 hours."""
    return clock.recent(files, as_of).agg(
        S.gib(F.sum("file_size_bytes")).alias("total_gb"),
        S.kib(F.avg("file_size_bytes")).alias("avg_kb"),
        F.avg("duration_seconds").alias("avg_duration_sec"),
    )


def _recent_children(files: DataFrame, children: DataFrame, as_of: Column) -> DataFrame:
    """Child rows of recent files; ids are unique, so this is a semi join."""
    recent = clock.recent(files, as_of)
    ids = recent.select(F.col("id").alias("audio_file_id"))
    return filters.within_ids(children, recent).join(ids, "audio_file_id", "left_semi")


def language_counts(files: DataFrame, transcripts: DataFrame, as_of: Column) -> DataFrame:
    return counts_by(
        _recent_children(files, transcripts.select("audio_file_id", "language"), as_of), "language"
    )


def transcript_lengths(files: DataFrame, transcripts: DataFrame, as_of: Column) -> DataFrame:
    """Mean and longest transcript in characters; lengths are taken before the join."""
    lengths = transcripts.select("audio_file_id", F.length("transcript_text").alias("chars"))
    return _recent_children(files, lengths, as_of).agg(
        F.avg("chars").alias("avg_chars"), F.max("chars").alias("max_chars")
    )


def failed_count(files: DataFrame, as_of: Column) -> DataFrame:
    return clock.recent(files, as_of).agg(
        F.count_if(F.col("status") == "failed").alias("failed_count")
    )


def queue_size(queue: DataFrame) -> DataFrame:
    return queue.agg(F.count("*").alias("ra_queue_size"))


def candidate_totals(candidates: DataFrame, threshold: float = 0.7) -> DataFrame:
    return candidates.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("label_1_pred") >= threshold).alias("above_threshold"),
    )


def candidates_by_country(candidates: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Candidates at or above the threshold per country; null and empty count as unknown."""
    return (
        candidates.filter(F.col("label_1_pred") >= threshold)
        .groupBy(S.value_or("country", "unknown").alias("country"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "country")
    )


def candidate_summary(candidates: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Totals and the per-country counts as one JSON object, in one pass over the candidates."""
    above = F.col("label_1_pred") >= threshold
    per_country = candidates.groupBy(S.value_or("country", "unknown").alias("country")).agg(
        F.count("*").alias("n"), F.count_if(above).alias("above")
    )
    pairs = F.array_sort(
        F.collect_list(F.when(F.col("above") > 0, F.struct("country", "above")))
    )
    return per_country.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_candidates"),
        F.coalesce(F.sum("above"), F.lit(0)).alias("above_threshold"),
        F.to_json(F.map_from_entries(pairs)).alias("by_country"),
    )


def batch_status_counts(files: DataFrame) -> DataFrame:
    return (
        files.groupBy("archive_source", "status")
        .agg(F.count("*").alias("count"))
        .orderBy("archive_source", "status")
    )


def _with_child(files: DataFrame, children: DataFrame, columns: list[str]) -> DataFrame:
    """Left join to child rows; several children of one file give several rows."""
    child = children.select(
        F.col("audio_file_id").alias("child_of"), F.col("id").alias("child_id"), *columns
    )
    return files.join(child, F.col("id") == F.col("child_of"), "left")


def transcript_coverage(files: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Per batch: joined rows, rows with a transcript, rows without."""
    joined = _with_child(files.select("id", "archive_source"), transcripts, [])
    return (
        joined.groupBy("archive_source")
        .agg(
            F.count("*").alias("total_files"),
            F.count("child_id").alias("has_transcript"),
            F.count_if(F.col("child_id").isNull()).alias("missing_transcript"),
        )
        .orderBy("archive_source")
    )


def classification_coverage(files: DataFrame, classifications: DataFrame) -> DataFrame:
    joined = _with_child(files.select("id", "archive_source"), classifications, ["flagged"])
    return (
        joined.groupBy("archive_source")
        .agg(
            F.count("*").alias("total_files"),
            F.count("child_id").alias("has_classification"),
            F.count_if("flagged").alias("flagged_count"),
            F.count_if(F.col("child_id").isNull()).alias("missing_classification"),
        )
        .orderBy("archive_source")
    )


def completeness(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    as_of: Column,
    interval: str = "24 HOURS",
) -> DataFrame:
    """One row over the window: totals, coverage and their percentages."""
    recent = clock.recent(files, as_of, interval)
    joined = _with_child(recent.select("id"), filters.within_ids(transcripts, recent), [])
    joined = joined.select("id", F.col("child_id").alias("transcript_id"))
    joined = _with_child(joined, filters.within_ids(classifications, recent), ["flagged"])
    totals = joined.agg(
        F.count("*").alias("total"),
        F.count("transcript_id").alias("with_transcript"),
        F.count("child_id").alias("with_classification"),
        F.count_if("flagged").alias("flagged"),
    )
    return totals.withColumns(
        {
            "transcript_pct": S.percent("with_transcript", "total"),
            "classification_pct": S.percent("with_classification", "total"),
        }
    )


def recent_batches(
    files: DataFrame, as_of: Column, interval: str = "24 HOURS", limit: int = 20
) -> DataFrame:
    """Newest batches: size, first creation, last completion."""
    return (
        clock.recent(files, as_of, interval)
        .groupBy("archive_source")
        .agg(
            F.count("*").alias("file_count"),
            F.min("created_at").alias("started"),
            F.max("processed_at").alias("completed"),
        )
        .orderBy(F.desc_nulls_first("started"), "archive_source")
        .limit(limit)
    )


def table_totals(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame
) -> DataFrame:
    """One row of four totals; the other tables come in as scalar subqueries."""
    return classifications.agg(
        F.count("*").alias("total_classifications"), F.count_if("flagged").alias("total_flagged")
    ).select(
        row_count(files).alias("total_files"),
        row_count(transcripts).alias("total_transcripts"),
        "total_classifications",
        "total_flagged",
    )


def row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def review_target(queue: DataFrame, ready: DataFrame, target: int = 200) -> DataFrame:
    """Queue size against the target, and what waits to be synced."""
    current = queue.agg(F.count("*").alias("current_count"))
    return current.select(
        "current_count",
        F.lit(target).alias("target"),
        (F.col("current_count") >= target).alias("target_met"),
        row_count(ready).alias("pipeline_pending"),
    )


def unpack_stats(
    conversions: DataFrame, metadata: DataFrame | None = None
) -> DataFrame:
    """Per batch: audio found, converted, failed, queued, metadata records and matches.

    `conversions` has (batch_id, stem, success); `metadata` has one row per (batch_id, stem).
    """
    results = conversions.select("batch_id", "stem", "success")
    if metadata is None:
        return attached_stats(results.withColumn("matched", F.lit(False)))
    known = metadata.select("batch_id", "stem", F.lit(True).alias("matched"))
    return attached_stats(results.join(known, ["batch_id", "stem"], "left"), metadata)


def attached_stats(attached: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """The same from conversions (batch_id, success, matched) that met their metadata already.

    A batch that has metadata but no audio counts its records.
    """
    stats = attached.groupBy("batch_id").agg(
        F.count("*").alias("mp3_found"),
        F.count_if("success").alias("converted"),
        F.count_if(~F.col("success")).alias("failed"),
        F.count_if("success").alias("queued"),
        F.count_if(F.col("success") & F.col("matched")).alias("metadata_matched"),
    )
    if metadata is None:
        return stats.withColumn("metadata_records", F.lit(0).cast("long"))
    records = metadata.groupBy("batch_id").agg(F.count("*").alias("metadata_records"))
    return stats.join(records, "batch_id", "full_outer").fillna(0)


def attempt_totals(results: DataFrame) -> DataFrame:
    """Successes, failures and batches over scored items (batch_id, success)."""
    per_batch = results.groupBy("batch_id").agg(
        F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("bad")
    )
    return per_batch.agg(
        F.count("*").alias("batches"),
        F.sum("ok").alias("success"),
        F.sum("bad").alias("failed"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of one run over (error, flagged) rows."""
    failed = F.col("error").isNotNull()
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(~failed).alias("successful"),
        F.count_if(failed).alias("errors"),
        F.count_if("flagged").alias("flagged"),
    )


def transfer_totals(manifest: DataFrame) -> DataFrame:
    """Copied and skipped archives of one cycle (column `outcome`)."""
    copied = F.col("outcome") == "queued"
    return manifest.agg(
        F.count_if(copied).alias("files_copied"), F.count_if(~copied).alias("files_skipped")
    )


def folder_usage(listing: DataFrame, as_of: Column, idle: str = "120 MINUTES") -> DataFrame:
    """Per first-level folder: bytes, files, newest change, and whether it lies idle."""
    folders = listing.groupBy(F.element_at(F.split("key", "/"), 1).alias("folder")).agg(
        F.sum("length").alias("bytes"),
        F.count("*").alias("files"),
        F.max("modification_time").alias("last_change"),
    )
    return folders.withColumn("idle", F.col("last_change") <= clock.before(as_of, idle))


def scratch_usage(listing: DataFrame, as_of: Column) -> DataFrame:
    """One row: total bytes, folders, idle folders."""
    return folder_usage(listing, as_of).agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.count("*").alias("directories"),
        F.count_if("idle").alias("old_directories"),
    )
