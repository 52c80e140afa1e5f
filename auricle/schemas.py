"""Fixed table and message schemas, as DDL text that `read.schema` and `from_json` accept."""

AUDIO_FILES = """
    id BIGINT, original_filename STRING, opus_path STRING, s3_opus_path STRING,
    archive_source STRING, duration_seconds DOUBLE, file_size_bytes BIGINT,
    created_at TIMESTAMP_NTZ, processed_at TIMESTAMP_NTZ, status STRING,
    parquet_lang STRING, parquet_country STRING, parquet_metadata STRING,
    synced_to_ra BOOLEAN, synced_at TIMESTAMP_NTZ
"""

PIPELINE_TRANSCRIPTS = """
    id BIGINT, audio_file_id BIGINT, transcript_text STRING, language STRING,
    confidence DOUBLE, created_at TIMESTAMP_NTZ
"""

PIPELINE_CLASSIFICATIONS = """
    id BIGINT, audio_file_id BIGINT, flagged BOOLEAN, flag_score DOUBLE,
    flag_category STRING, created_at TIMESTAMP_NTZ
"""

TRANSCRIPTS = """
    meta_id STRING, year INT, month INT, day INT, transcript STRING,
    created_at TIMESTAMP_NTZ, video_url STRING, creator_id BIGINT,
    label_1_pred DECIMAL(10,9), country STRING, lang STRING, queue_status STRING,
    first_report_date DATE, first_report_device_id INT, total_report_count INT,
    review_status STRING, is_reportable BOOLEAN, confidence_level STRING,
    in_study BOOLEAN, treatment_assignment STRING, report_region STRING
"""

CREATORS = "creator_id BIGINT, author_uniqueid STRING, created_at TIMESTAMP_NTZ"

SEGMENTS = "audio_file_id BIGINT, idx INT, text STRING, avg_logprob DOUBLE"

LISTING = "key STRING, length BIGINT, modification_time TIMESTAMP"

TABLES = {
    "audio_files": AUDIO_FILES,
    "pipeline_transcripts": PIPELINE_TRANSCRIPTS,
    "pipeline_classifications": PIPELINE_CLASSIFICATIONS,
    "transcripts": TRANSCRIPTS,
    "creators": CREATORS,
}

UNPACK_JOB = "batch_id STRING, s3_key STRING, original_filename STRING, transferred_at STRING"

TRANSCRIBE_JOB = """
    batch_id STRING, opus_path STRING, original_filename STRING, parquet_metadata STRING
"""
