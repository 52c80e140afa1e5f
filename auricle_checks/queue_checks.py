"""The named queues."""

from pyspark.sql import functions as F

from auricle.plans import queues
from auricle_checks.aggregate_checks import CANDIDATES, READY, REVIEW_QUEUE
from auricle_checks.registry import check

FLAGGED_QUEUE = """
SELECT f.id, f.original_filename, f.opus_path, f.s3_opus_path, f.parquet_lang, f.parquet_country,
       f.parquet_metadata, json_extract_string(f.parquet_metadata, '$.meta_id') AS meta_id,
       t.transcript_text, c.flag_score, c.flag_category, f.synced_to_ra, f.created_at
FROM day_files f
JOIN pipeline_transcripts t ON t.audio_file_id = f.id
JOIN pipeline_classifications c ON c.audio_file_id = f.id
WHERE c.flagged AND f.status = 'flagged'
"""
PENDING = """
SELECT f.id, f.original_filename, f.opus_path, t.transcript_text, c.flag_score, c.flag_category,
       f.created_at
FROM day_files f
JOIN pipeline_transcripts t ON t.audio_file_id = f.id
JOIN pipeline_classifications c ON c.audio_file_id = f.id
WHERE c.flagged AND f.status = 'flagged'
ORDER BY c.flag_score DESC, f.id LIMIT 100
"""


@check("Q1_flagged_queue", FLAGGED_QUEUE)
def _(t):
    return queues.flagged_queue(
        t.audio_files, t.transcripts, t.classifications, t.as_of, stage=True
    )


@check("Q2_sync_candidates", CANDIDATES + "SELECT * FROM candidates")
def _(t):
    found = queues.sync_candidates(
        t.audio_files, t.transcripts, t.classifications, stage=True
    )
    return found.select(*queues.SYNC_CANDIDATE_COLUMNS)


@check("Q3_review_queue", REVIEW_QUEUE)
def _(t):
    queue = queues.review_queue(t.review_rows, t.unified_files, t.as_of)
    return queue.withColumn("label_1_pred", F.col("label_1_pred").cast("double"))


@check("Q4_ready_for_sync", READY)
def _(t):
    return queues.ready_for_sync(
        t.unified_files, t.transcripts, t.classifications, stage=True
    )


@check("Q5_pending_flagged", PENDING)
def _(t):
    return queues.pending_flagged(t.audio_files, t.transcripts, t.classifications, t.as_of)


@check(
    "Q6_file_details",
    """SELECT f.id, f.original_filename, f.status, f.s3_opus_path,
       p.transcript_text IS NOT NULL AS has_transcript, p.language, c.flagged, c.flag_score,
       c.flag_category
FROM audio_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id
LEFT JOIN pipeline_classifications c ON c.audio_file_id = f.id
WHERE f.archive_source LIKE 'src1%' ORDER BY f.id LIMIT 50""",
)
def _(t):
    return queues.file_details(t.audio_files, t.transcripts, t.classifications, "src1%")


@check(
    "Q7_top_plays",
    """SELECT id, original_filename,
       json_extract_string(parquet_metadata, '$.stats_playcount')::INT AS plays
FROM audio_files ORDER BY plays DESC NULLS FIRST, id LIMIT 10""",
)
def _(t):
    return queues.top_by_metadata(t.audio_files, "stats_playcount")
