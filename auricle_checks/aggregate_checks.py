"""Aggregates over the whole derived tables."""

from pyspark.sql import functions as F

from auricle.operators import aggregates as A
from auricle.plans import queues
from auricle_checks.registry import check

RECENT_FLAGGED = """
    SELECT f.*, c.flagged, c.flag_score, c.flag_category
    FROM day_files f JOIN pipeline_classifications c ON c.audio_file_id = f.id
"""
CANDIDATES = """
, candidates AS (
    SELECT f.id AS audio_file_id, json_extract_string(f.parquet_metadata, '$.meta_id') AS meta_id,
           t.transcript_text AS transcript, c.flag_score AS label_1_pred,
           f.parquet_country AS country, f.parquet_lang AS lang,
           json_extract_string(f.parquet_metadata, '$.author_uniqueid') AS author_uniqueid,
           year(f.created_at)::INT AS year, month(f.created_at)::INT AS month,
           day(f.created_at)::INT AS day, f.created_at
    FROM pipeline_classifications c
    JOIN audio_files f ON f.id = c.audio_file_id
    JOIN pipeline_transcripts t ON t.audio_file_id = f.id
    WHERE c.flagged AND NOT f.synced_to_ra
      AND json_extract_string(f.parquet_metadata, '$.meta_id') IS NOT NULL
)
"""
# The review queue in SQL, for its size.
FLAGGED_QUEUE_ROWS = """
    SELECT f.id FROM day_files f
    JOIN pipeline_transcripts t ON t.audio_file_id = f.id
    JOIN pipeline_classifications c ON c.audio_file_id = f.id
    WHERE c.flagged AND f.status = 'flagged'
"""
REVIEW_QUEUE = """
    SELECT r.meta_id, r.transcript, r.label_1_pred::DOUBLE AS label_1_pred, r.country, r.lang,
           r.video_url, r.created_at, u.opus_path, u.duration_seconds
    FROM review_rows r LEFT JOIN unified_files u ON u.meta_id = r.meta_id
    WHERE r.queue_status = 'unqueued' AND r.label_1_pred >= 0.70
      AND r.created_at > (SELECT t FROM now_) - INTERVAL 24 HOURS
"""
READY = """
    SELECT u.id AS audio_file_id, u.original_filename, u.opus_path, u.created_at,
           t.transcript_text, t.language, t.confidence AS whisper_confidence, c.flagged,
           c.flag_score, c.flag_category
    FROM unified_files u
    JOIN pipeline_transcripts t ON t.audio_file_id = u.id
    JOIN pipeline_classifications c ON c.audio_file_id = u.id
    WHERE u.status = 'classified' AND u.meta_id IS NULL AND c.flagged
"""
DAILY = """
SELECT created_at::DATE::VARCHAR AS date, status, count(*) AS count FROM audio_files
WHERE created_at > (SELECT t FROM now_) - INTERVAL 7 DAYS GROUP BY ALL
"""
TOTALS = """
SELECT count(*) AS total_processed,
       count(*) FILTER (status = 'flagged') AS flagged_count,
       count(*) FILTER (synced_to_ra) AS synced_count,
       count(*) FILTER (status = 'flagged' AND NOT synced_to_ra) AS pending_sync
FROM day_files
"""


def _dated(df):
    return df.withColumn("date", F.col("date").cast("string"))


def candidates(t):
    narrow = t.transcripts.select("id", "audio_file_id")
    return queues.sync_candidates(t.audio_files, narrow, t.classifications)


@check("A1_rolling_totals", TOTALS)
def _(t):
    return A.rolling_totals(t.audio_files, t.as_of)


@check("A2_daily_status_counts", DAILY)
def _(t):
    return _dated(A.daily_status_counts(t.audio_files, t.as_of))


@check(
    "A3_daily_pivot",
    """
SELECT created_at::DATE::VARCHAR AS date, count(*) AS total_files,
       count(*) FILTER (status = 'pending') AS pending,
       count(*) FILTER (status = 'transcribed') AS transcribed,
       count(*) FILTER (status = 'classified') AS classified,
       count(*) FILTER (status = 'synced') AS synced,
       count(*) FILTER (status = 'failed') AS failed
FROM unified_files WHERE created_at > (SELECT t FROM now_) - INTERVAL 7 DAYS GROUP BY ALL
""",
)
def _(t):
    return _dated(A.daily_pivot(t.unified_files, t.as_of))


@check("A4_status_counts_24h", "SELECT status, count(*) AS count FROM day_files GROUP BY status")
def _(t):
    return A.status_counts(t.audio_files, t.as_of)


@check("A4_status_counts_all", "SELECT status, count(*) AS count FROM audio_files GROUP BY status")
def _(t):
    return A.status_counts(t.audio_files)


@check(
    "A5_classification_totals",
    f"""SELECT count(*) FILTER (flagged) AS flagged_count, count(*) AS total_classified
FROM ({RECENT_FLAGGED})""",
)
def _(t):
    return A.classification_totals(t.audio_files, t.classifications, t.as_of)


@check(
    "A6_flagged_span",
    f"""SELECT count(*) AS flagged_count, min(created_at) AS earliest, max(created_at) AS latest
FROM ({RECENT_FLAGGED}) WHERE flagged""",
)
def _(t):
    return A.flagged_span(t.audio_files, t.classifications, t.as_of)


@check(
    "A7_hourly_rate_last_12",
    """SELECT date_trunc('hour', created_at)::TIMESTAMP AS hour, count(*) AS processed
FROM day_files GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
)
def _(t):
    return A.hourly_rate(t.audio_files, t.as_of, limit=12)


@check(
    "A7_hourly_rate_24h",
    """SELECT date_trunc('hour', created_at)::TIMESTAMP AS hour, count(*) AS processed
FROM day_files GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
def _(t):
    return A.hourly_rate(t.audio_files, t.as_of, limit=24)


@check(
    "A7_hourly_labels_6h",
    """SELECT strftime(date_trunc('hour', created_at), '%H:%M') AS hour, count(*) AS files
FROM audio_files WHERE created_at > (SELECT t FROM now_) - INTERVAL 6 HOURS
GROUP BY date_trunc('hour', created_at)""",
)
def _(t):
    return A.hourly_labels(t.audio_files, t.as_of)


@check(
    "A8_category_scores",
    f"""SELECT flag_category, count(*) AS count,
       round(avg(flag_score)::DECIMAL(30,12), 3)::DOUBLE AS avg_score
FROM ({RECENT_FLAGGED}) WHERE flagged GROUP BY flag_category""",
)
def _(t):
    scores = A.category_scores(t.audio_files, t.classifications, t.as_of)
    return scores.withColumn("avg_score", F.col("avg_score").cast("double"))


@check(
    "A9_archive_counts",
    """SELECT archive_source, count(*) AS file_count FROM day_files
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def _(t):
    return A.archive_counts(t.audio_files, t.as_of)


@check(
    "A10_volume",
    """SELECT round((sum(file_size_bytes) / (1024.0 * 1024 * 1024))::DOUBLE, 12) AS total_gb,
       round(avg(file_size_bytes) / 1024.0, 9) AS avg_kb,
       round(avg(duration_seconds), 9) AS avg_duration_sec FROM day_files""",
)
def _(t):
    return A.volume(t.audio_files, t.as_of).select(
        F.round("total_gb", 12).alias("total_gb"),
        F.round("avg_kb", 9).alias("avg_kb"),
        F.round("avg_duration_sec", 9).alias("avg_duration_sec"),
    )


@check(
    "A11_language_counts",
    """SELECT p.language, count(*) AS count FROM pipeline_transcripts p
JOIN day_files f ON f.id = p.audio_file_id GROUP BY 1""",
)
def _(t):
    return A.language_counts(t.audio_files, t.transcripts, t.as_of)


@check(
    "A12_transcript_lengths",
    """SELECT round(avg(length(p.transcript_text)), 9) AS avg_chars,
       max(length(p.transcript_text)) AS max_chars
FROM pipeline_transcripts p JOIN day_files f ON f.id = p.audio_file_id""",
)
def _(t):
    return A.transcript_lengths(t.audio_files, t.transcripts, t.as_of).select(
        F.round("avg_chars", 9).alias("avg_chars"), F.col("max_chars").cast("long").alias("max_chars")
    )


@check(
    "A13_failed_count", "SELECT count(*) AS failed_count FROM day_files WHERE status = 'failed'"
)
def _(t):
    return A.failed_count(t.audio_files, t.as_of)


@check("A14_queue_size", f"SELECT count(*) AS ra_queue_size FROM ({FLAGGED_QUEUE_ROWS})")
def _(t):
    narrow = t.transcripts.select("id", "audio_file_id", "transcript_text", "created_at")
    queue = queues.flagged_queue(t.audio_files, narrow, t.classifications, t.as_of, ordered=False)
    return A.queue_size(queue)


@check("A14_review_queue_size", f"SELECT count(*) AS ra_queue_size FROM ({REVIEW_QUEUE})")
def _(t):
    return A.queue_size(queues.review_queue(t.review_rows, t.unified_files, t.as_of))


@check(
    "A15_candidate_totals",
    CANDIDATES
    + """SELECT count(*) AS total, count(*) FILTER (label_1_pred >= 0.7) AS above_threshold
FROM candidates""",
)
def _(t):
    return A.candidate_totals(candidates(t))


BY_COUNTRY = """SELECT coalesce(nullif(country, ''), 'unknown') AS country, count(*) AS count
FROM candidates WHERE label_1_pred >= 0.7 GROUP BY 1"""


@check("A16_candidates_by_country", CANDIDATES + BY_COUNTRY)
def _(t):
    return A.candidates_by_country(candidates(t))


SUMMARY_SQL = (
    CANDIDATES
    + f"""SELECT (SELECT count(*) FROM candidates) AS total_candidates,
       coalesce(sum(count), 0)::BIGINT AS above_threshold,
       '{{' || coalesce(string_agg('"' || country || '":' || count, ',' ORDER BY country), '')
           || '}}' AS by_country
FROM ({BY_COUNTRY})"""
)


@check("A17_candidate_summary_json", SUMMARY_SQL)
def _(t):
    return A.candidate_summary(candidates(t))


@check("UD3_candidate_summary", SUMMARY_SQL)
def _(t):
    return A.candidate_summary(candidates(t), threshold=0.7)


@check(
    "A18_batch_status_counts",
    """SELECT archive_source, status, count(*) AS count FROM audio_files
WHERE archive_source LIKE 'src%' GROUP BY ALL""",
)
def _(t):
    from auricle.operators import filters

    return A.batch_status_counts(filters.in_batches(t.audio_files, "src%"))


@check(
    "A19_transcript_coverage",
    """SELECT f.archive_source, count(*) AS total_files, count(p.id) AS has_transcript,
       count(*) - count(p.id) AS missing_transcript
FROM audio_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id GROUP BY 1""",
)
def _(t):
    return A.transcript_coverage(t.audio_files, t.transcripts)


@check(
    "A20_classification_coverage",
    """SELECT f.archive_source, count(*) AS total_files, count(c.id) AS has_classification,
       count(*) FILTER (c.flagged) AS flagged_count,
       count(*) - count(c.id) AS missing_classification
FROM audio_files f LEFT JOIN pipeline_classifications c ON c.audio_file_id = f.id GROUP BY 1""",
)
def _(t):
    return A.classification_coverage(t.audio_files, t.classifications)


@check(
    "A21_completeness",
    """SELECT count(*) AS total, count(p.id) AS with_transcript, count(c.id) AS with_classification,
       count(*) FILTER (c.flagged) AS flagged,
       round(100.0::DOUBLE * count(p.id) / greatest(count(*), 1), 9) AS transcript_pct,
       round(100.0::DOUBLE * count(c.id) / greatest(count(*), 1), 9) AS classification_pct
FROM day_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id
LEFT JOIN pipeline_classifications c ON c.audio_file_id = f.id""",
)
def _(t):
    row = A.completeness(t.audio_files, t.transcripts, t.classifications, t.as_of)
    return row.withColumns(
        {c: F.round(c, 9) for c in ("transcript_pct", "classification_pct")}
    )


@check(
    "A22_recent_batches",
    """SELECT archive_source, count(*) AS file_count, min(created_at) AS started,
       max(processed_at) AS completed
FROM day_files GROUP BY 1 ORDER BY started DESC, archive_source LIMIT 20""",
)
def _(t):
    return A.recent_batches(t.audio_files, t.as_of)


@check(
    "A23_table_totals",
    """SELECT (SELECT count(*) FROM audio_files) AS total_files,
       (SELECT count(*) FROM pipeline_transcripts) AS total_transcripts,
       count(*) AS total_classifications, count(*) FILTER (flagged) AS total_flagged
FROM pipeline_classifications""",
)
def _(t):
    return A.table_totals(t.audio_files, t.transcripts, t.classifications)


TARGET_SQL = f"""
SELECT q.n AS current_count, 200 AS target, q.n >= 200 AS target_met, r.n AS pipeline_pending
FROM (SELECT count(*) AS n FROM ({REVIEW_QUEUE})) q, (SELECT count(*) AS n FROM ({READY})) r
"""


def _target(t):
    return A.review_target(
        queues.review_queue(t.review_rows, t.unified_files, t.as_of),
        queues.ready_for_sync(t.unified_files, t.transcripts, t.classifications),
    )


check("A24_review_target", TARGET_SQL)(_target)
check("UD5_review_target", TARGET_SQL)(_target)


@check("UD2_rolling_totals", TOTALS)
def _(t):
    return A.rolling_totals(t.audio_files, t.as_of)
