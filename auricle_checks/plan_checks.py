"""Composite jobs and reports over the whole derived tables."""

import pandas as pd
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import scoring
from auricle.plans import reports, score, transfer, unpack
from auricle.session import durable, run_dir
from auricle_checks.aggregate_checks import FLAGGED_QUEUE_ROWS, RECENT_FLAGGED
from auricle_checks.registry import check
from auricle_checks.scalar_checks import WS
from auricle_checks.source_checks import OBJECTS, event_objects, latest_event

# --- unpack -----------------------------------------------------------------------

# A job per archive, and one per nation for which there is no archive. A conversion fails where
# the document's event is an error.
UNPACK = """, batches AS (
    SELECT batch_id, count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok,
           count(metadata) AS records,
           count(metadata) FILTER (event_type <> 'error') AS matched
    FROM members GROUP BY batch_id
), jobs AS (
    SELECT batch_id FROM batches UNION ALL SELECT n_name FROM nation
), letters AS (
    SELECT batch_id, '{"batch_id":"' || batch_id || '","s3_key":"archives/' || batch_id || '.tar"'
           AS head FROM jobs
)
"""


def _unpacked(t):
    batches = t.archives.select(S.path_stem("path").alias("batch_id"))
    lost = t.raw("nation").select(F.col("n_name").alias("batch_id"))
    jobs = batches.unionByName(lost).withColumn("s3_key", S.archive_key("batch_id"))
    jobs = jobs.withColumn("value", S.row_json("batch_id", "s3_key"))
    converted = t._joined.select(
        F.concat_ws("-", "source", F.expr("doc_id div 64")).alias("batch_id"),
        F.concat(
            F.lit("audio/"),
            "stem",
            F.when(F.col("lang") == "de", ".MP3").otherwise(".mp3"),
        ).alias("member_path"),
        F.col("n_chars").alias("file_size_bytes"),
        (F.col("event_type") != "error").alias("success"),
    )
    return unpack.unpack(jobs, t.members, converted, latest_event(t))


@check(
    "P1_transcribe_messages",
    UNPACK
    + """SELECT m.batch_id, m.metadata IS NOT NULL AS matched,
       '{"batch_id":"' || m.batch_id || '","opus_path":"/data/scratch/' || m.batch_id || '/'
       || m.stem || '.opus","original_filename":"' || m.name || '","parquet_metadata":'
       || coalesce(m.metadata, '{}') || '}' AS value
FROM members m WHERE m.event_type <> 'error'""",
)
def _(t):
    return _unpacked(t).transcribe_jobs.select("batch_id", "matched", "value")


@check(
    "P1_batch_stats",
    UNPACK
    + """SELECT batch_id, n AS mp3_found, ok AS converted, n - ok AS failed, ok AS queued,
       matched AS metadata_matched, records AS metadata_records
FROM batches WHERE ok > 0""",
)
def _(t):
    return _unpacked(t).stats


@check(
    "P1_batch_totals",
    UNPACK
    + """SELECT batch_id, ok AS total, 0::BIGINT AS processed, 'archives/' || batch_id || '.tar' AS s3_key
FROM batches WHERE ok > 0""",
)
def _(t):
    return _unpacked(t).totals


@check(
    "P1_dead_letters",
    UNPACK
    + """SELECT head || ',"error":"' || CASE WHEN b.batch_id IS NULL
           THEN 'archive not found: archives/' || l.batch_id || '.tar'
           ELSE 'No files converted for batch ' || l.batch_id END
       || '","failed_at":"' || strftime((SELECT max(ts) FROM events), '%Y-%m-%dT%H:%M:%S.%fZ')
       || '"}' AS value
FROM letters l LEFT JOIN batches b USING (batch_id) WHERE b.batch_id IS NULL OR b.ok = 0""",
)
def _(t):
    return _unpacked(t).dead_letters


# --- scoring ----------------------------------------------------------------------


def _load_transcriber():
    """A stand-in model: each line of the content is a segment; no content is a failure."""

    def transcribe(jobs: pd.DataFrame) -> pd.DataFrame:
        heard = []
        for content in jobs["content"]:
            heard.append(
                [
                    {"text": line, "avg_logprob": None if i % 4 == 3 else float(-(i % 5))}
                    for i, line in enumerate(content.split("\n"))
                ]
            )
        return pd.DataFrame({"segments": heard, "language": jobs["heard_lang"]})

    return transcribe


def _load_classifier():
    """A stand-in model that answers 1 for prompts with a certain word."""

    def classify(prompts: pd.DataFrame) -> pd.DataFrame:
        answers = ["answer 1" if " the " in p else " 0" for p in prompts["prompt"]]
        return pd.DataFrame({"response": answers})

    return classify


SCORED = f""", lines AS (
    SELECT doc_id, source, stem, lang, meta_id, author, n_chars,
           list_transform(string_split(text, chr(10)),
                          lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')) AS parts
    FROM joined WHERE event_type <> 'error'
), heard AS (
    SELECT *, array_to_string(parts, ' ') AS heard_text,
           list_avg(list_transform(list_filter(range(len(parts)), lambda i: i % 4 <> 3),
                                   lambda i: -(i % 5))) AS mean
    FROM lines
), scored AS (
    SELECT *, least(1.0, greatest(0.0, 1.0 + mean / 5.0)) AS confidence,
           length(regexp_replace(heard_text, '{WS}', '', 'g')) > 0
               AND contains('Rate: ' || heard_text || '!', ' the ') AS flagged
    FROM heard
)
"""


def _score_jobs(t):
    return t._joined.select(
        F.col("source").alias("batch_id"),
        F.concat(F.lit("/scratch/"), "stem", F.lit(".opus")).alias("opus_path"),
        F.concat("stem", F.lit(".mp3")).alias("original_filename"),
        S.row_json("meta_id", "lang").alias("parquet_metadata"),
        F.when(F.col("event_type") != "error", F.col("text")).alias("content"),
        F.col("lang").alias("heard_lang"),
    )


def _scored(t):
    return score.score_jobs(
        _score_jobs(t),
        ("stand-in transcriber", _load_transcriber),
        ("stand-in classifier", _load_classifier),
        F.lit("Rate: {content_text}!"),
    ).drop("content", "heard_lang")


def _written_scores(t):
    path = run_dir(t.spark, "scored")
    scored = _scored(t)
    score.write_scored(scored, path)
    return score.read_scored(t.spark, path, scored)


@check(
    "P2_scored_items",
    SCORED
    + """SELECT source AS batch_id, '/scratch/' || stem || '.opus' AS opus_path,
       sha256(heard_text) AS digest, lang AS language, round(confidence, 9) AS confidence,
       flagged, CASE WHEN flagged THEN 1.0 ELSE 0.0 END AS flag_score,
       CASE WHEN flagged THEN 'flagged' ELSE 'transcribed' END AS status
FROM scored""",
)
def _(t):
    return _scored(t).filter("success").select(
        "batch_id",
        "opus_path",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        "language",
        F.round("confidence", 9).alias("confidence"),
        "flagged",
        "flag_score",
        "status",
    )


@check(
    "P2_failed_items",
    "SELECT source AS batch_id, '/scratch/' || stem || '.opus' AS opus_path, 'failed' AS status "
    "FROM joined WHERE event_type = 'error'",
)
def _(t):
    return _scored(t).filter(~F.col("success")).select("batch_id", "opus_path", "status")


def _tables(t):
    first = (t.audio_files.agg(F.max("id")).scalar(), 0, 0)
    return score.result_tables(_written_scores(t), None, latest_event(t), first)


NUMBERED = """, numbered AS (
    SELECT *, row_number() OVER (ORDER BY '/scratch/' || stem || '.opus') AS k FROM scored
)
"""


@check(
    "P2_result_files",
    SCORED
    + NUMBERED
    + """SELECT (SELECT max(id) FROM audio_files) + k AS id, stem || '.mp3' AS original_filename,
       'processed/' || strftime((SELECT max(ts) FROM events), '%Y-%m-%d') || '/' || stem || '.opus'
           AS s3_opus_path,
       source AS archive_source, CASE WHEN flagged THEN 'flagged' ELSE 'transcribed' END AS status,
       lang AS parquet_lang
FROM numbered""",
)
def _(t):
    return _tables(t).files.select(
        "id", "original_filename", "s3_opus_path", "archive_source", "status", "parquet_lang"
    )


@check(
    "P2_result_classifications",
    SCORED
    + NUMBERED
    + """SELECT k AS id, (SELECT max(id) FROM audio_files) + k AS audio_file_id, flagged,
       CASE WHEN flagged THEN 'reportable_content' END AS flag_category
FROM numbered""",
)
def _(t):
    return _tables(t).classifications.select("id", "audio_file_id", "flagged", "flag_category")


@check(
    "P2_result_transcripts",
    SCORED
    + NUMBERED
    + """SELECT k AS id, (SELECT max(id) FROM audio_files) + k AS audio_file_id,
       sha256(heard_text) AS digest, lang AS language, round(confidence, 9) AS confidence
FROM numbered""",
)
def _(t):
    return _tables(t).transcripts.select(
        "id",
        "audio_file_id",
        F.sha2(F.col("transcript_text").cast("binary"), 256).alias("digest"),
        "language",
        F.round("confidence", 9).alias("confidence"),
    )


@check(
    "P2_batch_progress",
    "SELECT source AS batch_id, count(*) AS processed FROM documents GROUP BY source",
)
def _(t):
    return _tables(t).progress


@check(
    "UD6_scored_rows",
    "SELECT doc_id, length(text) AS n, CASE WHEN length(text) > 1000 THEN 'ValueError: long' END "
    "AS error FROM documents WHERE length(text) <= 1000 "
    "UNION ALL SELECT doc_id, NULL, 'ValueError: long' FROM documents WHERE length(text) > 1000",
)
def _(t):
    def load():
        def lengths(rows):
            if (rows["text"].str.len() > 1000).any():
                raise ValueError("long")
            return pd.DataFrame({"n": rows["text"].str.len()})

        return lengths

    docs = t.raw("documents").select("doc_id", "text")
    return scoring.score_rows(docs, load, "n BIGINT", "text lengths").select(
        "doc_id", "n", "error"
    )


def _miscounting(keep):
    """A model whose answer has keep(length) rows for each row."""

    def load():
        def lengths(rows):
            n = rows["text"].str.len()
            return pd.DataFrame({"n": n.repeat(n.map(keep)).reset_index(drop=True)})

        return lengths

    return load


@check(
    "UD6_short_answers",
    """SELECT doc_id, CASE WHEN length(text) % 5 > 0 THEN length(text) END AS n,
       CASE WHEN length(text) % 5 = 0 THEN 'ValueError: the model gave 0 rows for 1' END AS error
FROM documents""",
)
def _(t):
    docs = t.raw("documents").select("doc_id", "text")
    load = _miscounting(lambda n: int(n % 5 > 0))
    return scoring.score_rows(docs, load, "n BIGINT", "short").select("doc_id", "n", "error")


@check(
    "UD6_long_answers",
    """SELECT doc_id, CASE WHEN length(text) % 5 > 0 THEN length(text) END AS n,
       CASE WHEN length(text) % 5 = 0 THEN 'ValueError: the model gave 2 rows for 1' END AS error
FROM documents""",
)
def _(t):
    docs = t.raw("documents").select("doc_id", "text")
    load = _miscounting(lambda n: 1 if n % 5 > 0 else 2)
    return scoring.score_rows(docs, load, "n BIGINT", "long").select("doc_id", "n", "error")


ASSEMBLED = f"""
SELECT d.doc_id AS audio_file_id, sha256(coalesce(s.heard, '')) AS digest,
       round(coalesce(s.confidence, 0.0), 9) AS confidence
FROM documents d LEFT JOIN (
    SELECT audio_file_id,
           string_agg(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), ' ' ORDER BY idx) AS heard,
           least(1.0, greatest(0.0, 1.0 + coalesce(avg(avg_logprob), 0.0) / 5.0)) AS confidence
    FROM segments GROUP BY audio_file_id
) s ON s.audio_file_id = d.doc_id
"""


def _assembled(t):
    files = t.raw("documents").select(
        F.col("doc_id").alias("audio_file_id"), F.col("lang").alias("language")
    )
    return scoring.assemble_transcripts(t.segments, files).select(
        "audio_file_id",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.round("confidence", 9).alias("confidence"),
    )


check("A25_assembled_transcripts", ASSEMBLED)(_assembled)
check(
    "A26_confidence",
    f"SELECT audio_file_id, confidence FROM ({ASSEMBLED})",
)(lambda t: _assembled(t).select("audio_file_id", "confidence"))


# --- transfer ----------------------------------------------------------------------

# Of the archives taken up, views hold a lease from their own time, sign-ups were staged short
# and clicks were never stored.
CYCLE = (
    OBJECTS
    + """, ready AS (
    SELECT key, regexp_extract(key, '[^/]+$') AS filename, length AS source_size
    FROM objects
    WHERE floor(epoch_us((SELECT t FROM clock_))/60000000.0 - epoch_us(modification_time)/60000000.0) > 10
      AND NOT key LIKE '%.lock' ORDER BY key LIMIT 50
), manifest AS (
    SELECT r.*, CASE WHEN e.event_type = 'view'
                       AND e.ts > (SELECT t FROM clock_) - INTERVAL 60 MINUTES THEN 'leased'
                     WHEN e.event_type = 'signup' THEN 'staging_mismatch'
                     WHEN e.event_type = 'click' THEN 'upload_mismatch' ELSE 'queued' END AS outcome
    FROM ready r JOIN events e ON r.filename = 'e' || e.event_id || '.tar'
)
"""
)


def _cycle(t):
    events = t.raw("events").withColumn("filename", F.concat(F.lit("e"), "event_id", F.lit(".tar")))
    kind = F.col("event_type")
    size = F.col("event_id")
    staged_size = F.when(kind == "signup", size + 1).otherwise(size)
    staged = events.select(
        "filename", staged_size.alias("staged_size"), staged_size.alias("local_size")
    )
    uploaded = events.filter(kind != "click").select("filename", staged_size.alias("uploaded_size"))
    leases = events.filter(kind == "view").select("filename", F.col("ts").alias("leased_at"))
    now = latest_event(t)
    sources = durable(transfer.select_sources(event_objects(t), now))
    return transfer.transfer(sources, leases, staged, uploaded, now, delete_after=True)


@check("P6_transfer_manifest", CYCLE + "SELECT filename, source_size, outcome FROM manifest")
def _(t):
    return _cycle(t).manifest.select("filename", "source_size", "outcome")


@check(
    "P6_transfer_totals",
    CYCLE
    + """SELECT count(*) FILTER (outcome = 'queued') AS files_copied,
       count(*) FILTER (outcome <> 'queued') AS files_skipped FROM manifest""",
)
def _(t):
    return _cycle(t).totals


@check(
    "P6_unpack_messages",
    CYCLE
    + """, named AS (
    SELECT filename, strftime((SELECT t FROM clock_), '%Y%m%d-%H%M%S') || '-'
           || substring(sha256(filename), 1, 6) AS batch_id FROM manifest WHERE outcome = 'queued'
)
SELECT batch_id, '{"batch_id":"' || batch_id || '","s3_key":"archives/' || batch_id
    || '.tar","original_filename":"' || filename || '","transferred_at":"'
    || strftime((SELECT t FROM clock_), '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value
FROM named""",
)
def _(t):
    return _cycle(t).jobs


@check(
    "P6_deletable_sources",
    CYCLE + "SELECT 'archive' AS kind, key FROM manifest WHERE outcome = 'queued'",
)
def _(t):
    return _cycle(t).deletable


@check(
    "P6_dry_run",
    CYCLE
    + """SELECT filename, printf('%.1f', source_size / 1048576.0) || ' MB' AS size FROM ready""",
)
def _(t):
    return transfer.dry_run(event_objects(t), latest_event(t))


# --- reports -----------------------------------------------------------------------


def _batch_report(t):
    return reports.verify_batch(t.audio_files, t.transcripts, t.classifications, "src%")


@check(
    "P7_batch_status_keys",
    "SELECT archive_source || ':' || status AS key, count(*) AS count FROM audio_files "
    "WHERE archive_source LIKE 'src%' GROUP BY archive_source, status",
)
def _(t):
    return _batch_report(t)["audio_files"]


@check(
    "P7_batch_issues",
    """SELECT DISTINCT p || archive_source AS issue
FROM audio_files f LEFT JOIN pipeline_transcripts t ON t.audio_file_id = f.id,
     (VALUES ('Missing transcripts in '), ('Missing classifications in ')) v(p)
WHERE t.id IS NULL""",
)
def _(t):
    return _batch_report(t)["issues"]


@check(
    "P7_recent_completeness",
    """SELECT count(*) AS total, count(p.id) AS with_transcript FROM audio_files f
LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id
WHERE f.created_at > (SELECT t FROM now_) - INTERVAL 48 HOURS""",
)
def _(t):
    report = reports.verify_recent(t.audio_files, t.transcripts, t.classifications, t.as_of, 48)
    return report["completeness"].select("total", "with_transcript")


@check(
    "P7_recent_statuses",
    """SELECT status, count(*) AS count FROM audio_files
WHERE created_at > (SELECT t FROM now_) - INTERVAL 48 HOURS GROUP BY status""",
)
def _(t):
    report = reports.verify_recent(t.audio_files, t.transcripts, t.classifications, t.as_of, 48)
    return report["stats"]


@check(
    "P7_overall_hourly",
    """SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:00') AS hour, count(*) AS count
FROM day_files GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
def _(t):
    stats = reports.overall_stats(t.audio_files, t.transcripts, t.classifications, t.as_of)
    return stats["hourly"]


# Queue depths are the files waiting by status; scratch holds the events' objects.
HEALTH = f""", usage AS (
    SELECT user_id, sum(event_id) AS bytes, max(ts) AS last_change FROM events GROUP BY 1
), metrics AS (
    SELECT 'processed' AS metric, count(*) AS value FROM day_files
    UNION ALL SELECT 'failed', count(*) FROM day_files WHERE status = 'failed'
    UNION ALL SELECT 'flagged', count(*) FROM ({RECENT_FLAGGED}) WHERE flagged
    UNION ALL SELECT 'review_queue', count(*) FROM ({FLAGGED_QUEUE_ROWS})
    UNION ALL SELECT 'total_bytes', sum(bytes)::BIGINT FROM usage
    UNION ALL SELECT 'directories', count(*) FROM usage
    UNION ALL SELECT 'old_directories', count(*) FROM usage
        WHERE last_change <= (SELECT t FROM now_) - INTERVAL 120 MINUTES
    UNION ALL SELECT 'queue:unpack', count(*) FROM audio_files WHERE status = 'pending'
    UNION ALL SELECT 'queue:transcribe', count(*) FROM audio_files WHERE status = 'transcribed'
)
"""


def _health(t):
    waiting = (
        t.audio_files.filter(F.col("status").isin("pending", "transcribed"))
        .groupBy(
            F.when(F.col("status") == "pending", "unpack").otherwise("transcribe").alias("queue")
        )
        .agg(F.count("*").alias("depth"))
    )
    scratch = t.raw("events").select(
        F.concat(F.lit("u"), "user_id", F.lit("/e"), "event_id").alias("key"),
        F.col("event_id").alias("length"),
        F.col("ts").alias("modification_time"),
    )
    return reports.health_metrics(
        t.audio_files, t.transcripts, t.classifications, waiting, scratch, t.as_of
    )


@check("P8_health_metrics", HEALTH + "SELECT * FROM metrics")
def _(t):
    return _health(t)


@check(
    "P8_health_alerts",
    HEALTH
    + """SELECT * FROM (SELECT metric, value, CASE
    WHEN metric = 'queue:unpack' AND value > 100 THEN 'Unpack queue backed up (>100)'
    WHEN metric = 'queue:transcribe' AND value > 1000 THEN 'Transcribe queue backed up (>1000)'
    WHEN metric = 'old_directories' AND value > 0
        THEN 'Old scratch directories detected - may indicate stuck batches'
    WHEN metric = 'flagged' AND value < 200 AND hour((SELECT t FROM now_)) BETWEEN 10 AND 11
        THEN 'Only ' || value || ' flagged items. Target is 200 by noon' END AS alert
FROM metrics) WHERE alert IS NOT NULL""",
)
def _(t):
    return reports.health_alerts(_health(t), t.as_of)


@check(
    "P9_unpack_verification",
    UNPACK
    + """SELECT j.batch_id, b.batch_id IS NOT NULL AS archive_present,
       coalesce(b.ok, 0) > 0 AS total_set, CASE WHEN b.ok > 0 THEN b.ok END AS batch_total,
       coalesce(b.ok, 0) AS queued_jobs, coalesce(b.ok, 0) AS opus_files,
       b.batch_id IS NOT NULL AND coalesce(b.ok, 0) > 0 AS success
FROM jobs j LEFT JOIN batches b USING (batch_id)""",
)
def _(t):
    result = _unpacked(t)
    archives = t.archives.select(F.col("path").alias("key"), "length")
    batches = (
        t.archives.select(S.path_stem("path").alias("batch_id"))
        .unionByName(t.raw("nation").select(F.col("n_name").alias("batch_id")))
        .withColumn("s3_key", S.archive_key("batch_id"))
    )
    scratch = result.transcribe_jobs.select(
        F.concat("batch_id", F.lit("/"), S.base_name("opus_path")).alias("key")
    )
    return reports.verify_unpack(batches, archives, result.totals, result.transcribe_jobs, scratch)


@check(
    "P10_result_verification",
    """SELECT archive_source AS batch_id, count(s3_opus_path) AS expected, count(*) AS audio_files,
       count(p.id) AS transcripts, count(p.id) AS classifications,
       count(s3_opus_path) AS s3_files,
       count(*) = count(s3_opus_path) AND count(p.id) = count(s3_opus_path) AS success
FROM audio_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id GROUP BY 1""",
)
def _(t):
    expected = t.audio_files.groupBy(F.col("archive_source").alias("batch_id")).agg(
        F.count("s3_opus_path").alias("expected")
    )
    listing = t.audio_files.filter(F.col("s3_opus_path").isNotNull()).select(
        F.col("s3_opus_path").alias("key"), F.col("file_size_bytes").alias("length")
    )
    return reports.verify_results(
        expected, t.audio_files, t.transcripts, t.classifications, listing
    )
