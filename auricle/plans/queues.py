"""The named queues: what waits for review, for sync, or for a look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.operators import filters
from auricle.session import staged

# A limited result of at most this many rows may be broadcast to its wide columns.
BROADCAST_ROWS = 10_000


def _flagged_items(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    stage: bool,
    threshold: float | None = None,
) -> DataFrame:
    """files ⋈ transcripts ⋈ flagged classifications.

    The flagged side is the most selective, so it is joined to the files first. With `stage` that
    result is written, and its real size decides the join with the transcripts: a small one is
    broadcast and the transcripts stay where they are; a large one is joined by shuffle. Flags below
    the threshold are left out before.
    """
    flagged = filters.flagged_only(classifications)
    if threshold is not None:
        flagged = flagged.filter(F.col("flag_score") >= threshold)
    flags = flagged.select(
        F.col("id").alias("classification_id"),
        F.col("audio_file_id").alias("flag_of"),
        "flag_score",
        "flag_category",
    )
    texts = transcripts.drop(clock.PARTITION_DATE).withColumnsRenamed(
        {"id": "transcript_id", "audio_file_id": "text_of", "created_at": "transcribed_at"}
    )
    hits = files.join(flags, F.col("id") == F.col("flag_of"))
    if stage:
        hits = staged(hits)
    return hits.join(texts, F.col("id") == F.col("text_of"))


def flagged_queue(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    as_of: Column,
    ordered: bool = True,
    stage: bool = False,
) -> DataFrame:
    """Flagged files of the last 24 hours, best score first."""
    fresh = filters.with_status(clock.recent(files, as_of), "flagged").select(
        "id",
        "original_filename",
        "opus_path",
        "s3_opus_path",
        "parquet_lang",
        "parquet_country",
        "parquet_metadata",
        "synced_to_ra",
        "created_at",
    )
    queue = _flagged_items(
        fresh,
        filters.within_ids(transcripts, fresh),
        filters.within_ids(classifications, fresh),
        stage,
    ).select(
        "id",
        "original_filename",
        "opus_path",
        "s3_opus_path",
        "parquet_lang",
        "parquet_country",
        "parquet_metadata",
        S.json_text("parquet_metadata", "meta_id").alias("meta_id"),
        "transcript_text",
        "flag_score",
        "flag_category",
        "synced_to_ra",
        "created_at",
    )
    return queue.orderBy(F.desc_nulls_first("flag_score"), "id") if ordered else queue


def pending_flagged(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    as_of: Column,
    limit: int = 100,
) -> DataFrame:
    """The first `limit` rows of the flagged queue.

    The top rows are chosen on narrow columns; only then is the text of those rows fetched, so
    transcripts are never shuffled whole.
    """
    fresh = filters.with_status(clock.recent(files, as_of), "flagged").select(
        "id", "original_filename", "opus_path", "created_at"
    )
    transcripts = filters.within_ids(transcripts, fresh)
    classifications = filters.within_ids(classifications, fresh)
    top = (
        _flagged_items(fresh, transcripts.select("id", "audio_file_id"), classifications, True)
        .orderBy(F.desc_nulls_first("flag_score"), "id", "transcript_id", "classification_id")
        .limit(limit)
    )
    return with_text(top, transcripts, limit).select(
        "id",
        "original_filename",
        "opus_path",
        "transcript_text",
        "flag_score",
        "flag_category",
        "created_at",
    )


def with_text(top: DataFrame, transcripts: DataFrame, limit: int) -> DataFrame:
    """Fetch the transcript text of a limited result by transcript id."""
    texts = transcripts.select(F.col("id").alias("transcript_id"), "transcript_text")
    if limit <= BROADCAST_ROWS:
        top = F.broadcast(top)
    return texts.join(top, "transcript_id")


def sync_candidates(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    stage: bool = False,
    threshold: float | None = None,
) -> DataFrame:
    """Flagged, unsynced files that carry a metadata id; of a threshold on, if there is one."""
    fresh = filters.with_metadata_key(files.filter(~F.col("synced_to_ra")), "meta_id").select(
        "id",
        S.json_text("parquet_metadata", "meta_id").alias("meta_id"),
        S.json_text("parquet_metadata", "author_uniqueid").alias("author_uniqueid"),
        "parquet_country",
        "parquet_lang",
        "created_at",
    )
    items = _flagged_items(fresh, transcripts, classifications, stage, threshold)
    return items.select(
        F.col("id").alias("audio_file_id"),
        "meta_id",
        *(
            [F.col("transcript_text").alias("transcript")]
            if "transcript_text" in transcripts.columns
            else []
        ),
        F.col("flag_score").alias("label_1_pred"),
        F.col("parquet_country").alias("country"),
        F.col("parquet_lang").alias("lang"),
        "author_uniqueid",
        F.year("created_at").alias("year"),
        F.month("created_at").alias("month"),
        F.dayofmonth("created_at").alias("day"),
        "created_at",
        "transcript_id",
        "classification_id",
    )


SYNC_CANDIDATE_COLUMNS = [
    "audio_file_id",
    "meta_id",
    "transcript",
    "label_1_pred",
    "country",
    "lang",
    "author_uniqueid",
    "year",
    "month",
    "day",
    "created_at",
]


def review_queue(
    review_rows: DataFrame, files: DataFrame, as_of: Column, threshold: float = 0.70
) -> DataFrame:
    """Unqueued review rows of the last 24 hours at or above the threshold, with their file."""
    waiting = clock.recent(review_rows, as_of).filter(
        (F.col("queue_status") == "unqueued") & (F.col("label_1_pred") >= threshold)
    )
    media = files.filter(F.col("meta_id").isNotNull()).select(
        "meta_id", "opus_path", "duration_seconds"
    )
    return (
        waiting.join(media, "meta_id", "left")
        .select(
            "meta_id",
            "transcript",
            "label_1_pred",
            "country",
            "lang",
            "video_url",
            "created_at",
            "opus_path",
            "duration_seconds",
        )
        .orderBy(F.desc_nulls_first("label_1_pred"), "meta_id")
    )


def ready_for_sync(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame, stage: bool = False
) -> DataFrame:
    """Unified variant: classified, flagged and not yet synced."""
    waiting = (
        filters.with_status(files, "classified")
        .filter(F.col("meta_id").isNull())
        .select("id", "original_filename", "opus_path", "created_at")
    )
    columns = [
        F.col("id").alias("audio_file_id"),
        "original_filename",
        "opus_path",
        "created_at",
        *(["transcript_text"] if "transcript_text" in transcripts.columns else ["transcript_id"]),
        "language",
        F.col("confidence").alias("whisper_confidence"),
        F.lit(True).alias("flagged"),
        "flag_score",
        "flag_category",
    ]
    return (
        _flagged_items(waiting, transcripts, classifications, stage)
        .select(*columns)
        .orderBy(F.desc_nulls_first("flag_score"), "audio_file_id")
    )


def file_details(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    pattern: str,
    limit: int = 50,
) -> DataFrame:
    """The first files of matching batches by id, with transcript and classification state.

    The limit is applied to the joined rows. Each file gives at least one row, so the first
    `limit` files are enough to join.
    """
    first = (
        filters.in_batches(files, pattern)
        .select("id", "original_filename", "status", "s3_opus_path")
        .orderBy("id")
        .limit(limit)
    )
    if limit <= BROADCAST_ROWS:
        keys = F.broadcast(first.select(F.col("id").alias("audio_file_id")))
    else:
        keys = first.select(F.col("id").alias("audio_file_id"))
    texts = filters.within_ids(transcripts, first).join(keys, "audio_file_id", "left_semi").select(
        F.col("audio_file_id").alias("text_of"),
        F.col("id").alias("transcript_id"),
        F.col("transcript_text").isNotNull().alias("text_present"),
        "language",
    )
    flags = filters.within_ids(classifications, first).join(keys, "audio_file_id", "left_semi").select(
        F.col("audio_file_id").alias("flag_of"),
        F.col("id").alias("classification_id"),
        "flagged",
        "flag_score",
        "flag_category",
    )
    return (
        first.join(texts, F.col("id") == F.col("text_of"), "left")
        .join(flags, F.col("id") == F.col("flag_of"), "left")
        .orderBy("id", "transcript_id", "classification_id")
        .limit(limit)
        .select(
            "id",
            "original_filename",
            "status",
            "s3_opus_path",
            F.coalesce("text_present", F.lit(False)).alias("has_transcript"),
            "language",
            "flagged",
            "flag_score",
            "flag_category",
        )
    )


def top_by_metadata(files: DataFrame, key: str, limit: int = 10) -> DataFrame:
    """Files with the largest whole number under a metadata key; a missing number sorts first."""
    return (
        files.select("id", "original_filename", S.json_int("parquet_metadata", key).alias("plays"))
        .orderBy(F.desc_nulls_first("plays"), "id")
        .limit(limit)
    )
