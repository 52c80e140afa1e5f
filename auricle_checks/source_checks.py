"""Listings, archives, metadata and job messages, over data derived from the whole tables."""

from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import aggregates as A
from auricle.plans import retention, transfer, unpack
from auricle.session import run_dir
from auricle.sources import archives, jobs, metadata, objects, storage
from auricle_checks.filter_checks import CONVERSIONS, conversions
from auricle_checks.filter_checks import metadata as file_metadata
from auricle_checks.registry import check

# --- listings -------------------------------------------------------------------

# Events play the objects of a bucket: errors left a lock file, purchases lie in staging.
OBJECTS = """, objects AS (
    SELECT CASE event_type WHEN 'purchase' THEN 'staging/' ELSE 'sounds/' END
           || 'u' || user_id || '/e' || event_id
           || CASE event_type WHEN 'error' THEN '.tar.lock' ELSE '.tar' END AS key,
           event_id AS length, ts AS modification_time
    FROM events
), clock_ AS (SELECT max(ts) AS t FROM events)
"""


def event_objects(t):
    kind = F.col("event_type")
    return t.raw("events").select(
        F.concat(
            F.when(kind == "purchase", "staging/").otherwise("sounds/"),
            F.lit("u"),
            "user_id",
            F.lit("/e"),
            "event_id",
            F.when(kind == "error", ".tar.lock").otherwise(".tar"),
        ).alias("key"),
        F.col("event_id").alias("length"),
        F.col("ts").alias("modification_time"),
    )


def latest_event(t):
    return t.raw("events").agg(F.max("ts")).scalar()


AGE = "floor(epoch_us((SELECT t FROM clock_))/60000000.0 - epoch_us(modification_time)/60000000.0)"


@check(
    "SRC1_ready_archives",
    OBJECTS
    + f"""SELECT key, length FROM objects
WHERE {AGE} > 10 AND NOT key LIKE '%.lock' ORDER BY key LIMIT 50""",
)
def _(t):
    return objects.ready_archives(event_objects(t), latest_event(t)).select("key", "length")


@check(
    "SRC1_one_in_test_mode",
    OBJECTS
    + f"""SELECT key, regexp_extract(key, '[^/]+$') AS filename, length AS source_size FROM objects
WHERE {AGE} > 10 AND NOT key LIKE '%.lock' ORDER BY key LIMIT 1""",
)
def _(t):
    return transfer.select_sources(event_objects(t), latest_event(t), test=True)


def _key(path):
    return F.concat(F.lit("archives/"), F.substring_index(path, "/", -1))


@check("SRC2_audio_stems", "SELECT 'archives/' || batch_id || '.tar' AS path, stem AS meta_id FROM members")
def _(t):
    stems = archives.audio_stems(t.archive_files)
    return stems.select(_key("path").alias("path"), "meta_id")


@check(
    "SRC3_archive_types",
    """SELECT DISTINCT 'archives/' || batch_id || '.tar' AS path,
       CASE kind WHEN 0 THEN 'tar' WHEN 1 THEN 'tar.gz' ELSE 'tar.xz' END AS archive_type
FROM members""",
)
def _(t):
    return archives.with_archive_type(t.archives).select("path", "archive_type")


@check(
    "SRC4_extracted_members",
    """SELECT 'archives/' || batch_id || '.tar' AS path, 'audio/' || name AS member_path,
       strlen(text)::BIGINT AS size, sha256(text) AS digest
FROM members""",
)
def _(t):
    members = archives.read_members(t.archive_files)
    return members.filter(F.col("member_path").startswith("audio/")).select(
        _key("path").alias("path"), "member_path", "size", F.sha2("content", 256).alias("digest")
    )


def _parquet_folder(t):
    """File metadata written as Parquet in two folders; the later folder repeats ids."""
    root = run_dir(t.spark, "parquet-metadata")
    rows = t.audio_files.select(
        S.json_text("parquet_metadata", "meta_id").alias("meta_id"), "id", "parquet_lang"
    ).repartitionByRange(4, "id").sortWithinPartitions("id")
    rows.write.parquet(f"{root}/a")
    rows.filter(F.col("parquet_lang") == "en").withColumn("extra", F.col("id") * 2).select(
        "meta_id", "id", "extra"
    ).write.parquet(f"{root}/b")
    return root


@check(
    "SRC5_parquet_metadata",
    """, rows_ AS (
    SELECT json_extract_string(parquet_metadata, '$.meta_id') AS meta_id, id, parquet_lang
    FROM audio_files
), ranked AS (
    SELECT meta_id, id, parquet_lang, NULL::BIGINT AS extra, 'a' AS folder FROM rows_
    UNION ALL SELECT meta_id, id, NULL, id * 2, 'b' FROM rows_ WHERE parquet_lang = 'en'
)
SELECT meta_id, id, parquet_lang, extra FROM ranked WHERE meta_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY folder DESC, id DESC) = 1""",
)
def _(t):
    rows = metadata.read_parquet_metadata(t.spark, _parquet_folder(t))
    parsed = S.json_row("metadata", "id BIGINT, parquet_lang STRING, extra BIGINT")
    return rows.select("meta_id", parsed.alias("r")).select("meta_id", "r.*")


@check(
    "SRC6_txt_metadata", "SELECT batch_id, stem, metadata FROM members WHERE metadata IS NOT NULL"
)
def _(t):
    return unpack.batch_metadata(t.members)


@check(
    "SRC7_audio_members",
    "SELECT batch_id, 'audio/' || name AS member_path, strlen(text)::BIGINT AS size FROM members",
)
def _(t):
    return archives.audio_members(t.members).select("batch_id", "member_path", "size")


# Messages: a job per file; where the event was an error the message is the raw text instead,
# and sign-ups lost the path.
MESSAGES = """, messages AS (
    SELECT doc_id, CASE WHEN event_type = 'error' THEN text
        ELSE '{"batch_id":"' || source || '"' ||
             CASE WHEN event_type = 'signup' THEN '' ELSE ',"opus_path":"/scratch/' || stem || '.opus"' END
             || ',"original_filename":"' || stem || '.mp3","parquet_metadata":{"n":' || n_chars || '}}'
        END AS value, event_type, source, stem, n_chars
    FROM joined
)
"""


def messages(t):
    plain = F.to_json(
        F.struct(
            F.col("source").alias("batch_id"),
            F.when(
                F.col("event_type") != "signup",
                F.concat(F.lit("/scratch/"), "stem", F.lit(".opus")),
            ).alias("opus_path"),
            F.concat("stem", F.lit(".mp3")).alias("original_filename"),
            F.struct(F.col("n_chars").alias("n")).alias("parquet_metadata"),
        )
    )
    value = F.when(F.col("event_type") == "error", F.col("text")).otherwise(plain)
    return t._joined.select(value.alias("value"))


@check(
    "SRC8_unpack_messages",
    MESSAGES
    + """SELECT source AS batch_id, stem || '.mp3' AS original_filename FROM messages
WHERE event_type <> 'error'""",
)
def _(t):
    good, _dead = jobs.unpack_jobs(messages(t))
    return good.select("batch_id", "original_filename")


@check(
    "SRC9_transcribe_messages",
    MESSAGES
    + """SELECT source AS batch_id, '/scratch/' || stem || '.opus' AS opus_path,
       stem || '.mp3' AS original_filename, '{"n":' || n_chars || '}' AS parquet_metadata
FROM messages WHERE event_type NOT IN ('error', 'signup')""",
)
def _(t):
    good, _rejected = jobs.transcribe_jobs(messages(t))
    return good


@check(
    "SRC9_rejected_messages",
    MESSAGES
    + """SELECT CASE WHEN event_type = 'signup' THEN 'missing field' ELSE 'invalid JSON' END AS reason,
       sha256(value) AS digest FROM messages WHERE event_type IN ('error', 'signup')""",
)
def _(t):
    _good, rejected = jobs.transcribe_jobs(messages(t))
    return rejected.select("reason", F.sha2(F.col("value").cast("binary"), 256).alias("digest"))


@check(
    "SRC10_table_read",
    """SELECT id, original_filename, status, created_at FROM audio_files""",
)
def _(t):
    return t.audio_files.select("id", "original_filename", "status", "created_at")


# One object for each document, a third of them empty, in folders of which one is named like the
# root and one like what Spark takes for hidden.
PLACES = """, placed AS (
    SELECT CASE doc_id % 4 WHEN 0 THEN 'bucket/a b/' WHEN 1 THEN '_x/1+2%20/' WHEN 2 THEN '' ELSE 'p/q/r/' END
           || 'd' || doc_id || '.tar' AS key,
           CASE WHEN doc_id % 3 = 0 THEN 0 ELSE strlen(text) END AS length
    FROM documents
)
"""


def placed_objects(t, which=None, root=None, suffix=".tar"):
    """The folder `bucket` of the objects of PLACES, or of some of them, written by the tasks."""
    root = root or f"{run_dir(t.spark, 'placed')}/bucket"
    place = F.col("doc_id") % 4
    rows = t.raw("documents").select(
        F.concat(
            F.when(place == 0, "bucket/a b/").when(place == 1, "_x/1+2%20/").when(place == 2, "").otherwise("p/q/r/"),
            F.lit("d"), "doc_id", F.lit(suffix),
        ).alias("key"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")).alias("text"),
    )

    def put(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, within = storage.resolve(f"{root}/{key}")
                system.create_dir(within.rpartition("/")[0])
                with system.open_output_stream(within) as out:
                    out.write(text.encode())
            yield batch.select(["key"])

    rows.where(F.lit(True) if which is None else which).mapInArrow(put, "key STRING").count()
    return root


@check("SRC11_object_keys", PLACES + "SELECT key, length FROM placed")
def _(t):
    return objects.list_objects(t.spark, placed_objects(t)).select("key", "length")


@check(
    "SRC11_object_folders",
    PLACES + "SELECT substr(key, 8) AS key, length FROM placed WHERE key LIKE 'bucket/%'",
)
def _(t):
    listed = objects.list_objects(t.spark, placed_objects(t), "bucket", "d*.tar")
    return listed.select(F.substring_index("key", "bucket/", -1).alias("key"), "length")


@check(
    "SRC12_object_sizes",
    OBJECTS
    + """SELECT 'sounds/u' || f.id || '/e' || f.file_size_bytes || '.tar' AS key, o.length AS size
FROM audio_files f
LEFT JOIN objects o ON o.key = 'sounds/u' || f.id || '/e' || f.file_size_bytes || '.tar'""",
)
def _(t):
    keys = t.audio_files.select(
        F.concat(
            F.lit("sounds/u"), "id", F.lit("/e"), "file_size_bytes", F.lit(".tar")
        ).alias("key")
    )
    return objects.object_sizes(keys, event_objects(t))


@check(
    "SRC13_template_prompts",
    """SELECT doc_id, sha256('POLICY' || chr(10) || text || chr(10) || 'ANSWER' || chr(10)) AS digest
FROM documents""",
)
def _(t):
    root = run_dir(t.spark, "template")
    t.spark.sql("SELECT 'POLICY\\n{content_text}\\nANSWER' AS value").coalesce(1).write.text(root)
    template = objects.text_value(t.spark, root)
    prompt = S.render_prompt(template, "text").cast("binary")
    return t.raw("documents").select("doc_id", F.sha2(prompt, 256).alias("digest"))


# --- sinks as messages and plan tables --------------------------------------------


@check(
    "SNK9_dead_letters",
    """SELECT '{"batch_id":"' || source || '","s3_key":"archives/' || stem || '.tar"'
    || ',"error":"no audio in ' || stem || '","failed_at":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value
FROM joined WHERE event_type = 'error'""",
)
def _(t):
    failed = t._joined.filter(F.col("event_type") == "error")
    job = S.row_json(
        F.col("source").alias("batch_id"),
        F.concat(F.lit("archives/"), "stem", F.lit(".tar")).alias("s3_key"),
    )
    error = F.concat(F.lit("no audio in "), "stem")
    return failed.select(jobs.dead_letter(job, error, F.col("ts")).alias("value"))


@check(
    "SNK10_transcribe_messages",
    CONVERSIONS
    + """SELECT '{"batch_id":"' || batch_id || '","opus_path":"' || opus_path
    || '","original_filename":"' || original_filename || '","parquet_metadata":'
    || coalesce(metadata, '{}') || '}' AS value
FROM conversions LEFT JOIN metadata USING (batch_id, stem) WHERE success""",
)
def _(t):
    from auricle.operators.joins import attach_metadata

    attached = attach_metadata(conversions(t).filter("success"), file_metadata(t))
    return attached.select(
        jobs.transcribe_message("batch_id", "opus_path", "original_filename", "metadata").alias(
            "value"
        )
    )


@check(
    "SNK11_unpack_messages",
    """SELECT '{"batch_id":"' || source || '","s3_key":"archives/' || source
    || '.tar","original_filename":"' || stem || '.tar","transferred_at":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value FROM joined""",
)
def _(t):
    return t._joined.select(
        jobs.unpack_message(
            "source", S.archive_key("source"), F.concat("stem", F.lit(".tar")), F.col("ts")
        ).alias("value")
    )


# Metadata files exist for the items with a metadata id.
@check(
    "SNK12_bundled_members",
    """SELECT 'archives/' || batch_id || '.tar' AS path, 'audio/' || name AS member_path FROM members
UNION ALL SELECT 'archives/' || batch_id || '.tar', 'metadata/' || stem || '.txt' FROM members
WHERE meta_id IS NOT NULL""",
)
def _(t):
    audio = archives.audio_members(t.members)
    stems = audio.select("path", S.path_stem("member_path").alias("meta_id"))
    listing = t._joined.filter(F.col("meta_id").isNotNull()).select(
        F.concat(F.lit("metadata/"), "stem", F.lit(".txt")).alias("key"),
        F.col("n_chars").alias("length"),
    )
    bundled = transfer.bundled_members(audio, stems, listing)
    return bundled.select(_key("path").alias("path"), "member_path")


@check(
    "SNK13_bucket_clear_plan",
    OBJECTS
    + """SELECT key, 'dry run' AS action FROM objects WHERE key NOT IN ('archives/', 'processed/')""",
)
def _(t):
    return retention.bucket_clear(event_objects(t))


@check(
    "SNK15_consumed_archives",
    CONVERSIONS
    + """SELECT batch_id, 'archives/' || batch_id || '.tar' AS s3_key FROM conversions
GROUP BY batch_id HAVING count(*) FILTER (success) > 0""",
)
def _(t):
    stats = A.unpack_stats(conversions(t))
    keys = conversions(t).select("batch_id").distinct().withColumn(
        "s3_key", S.archive_key("batch_id")
    )
    return retention.consumed_archives(stats, keys)


# Events as transfers: an archive per event; errors were cut short in the upload.
TRANSFER = """, sent AS (
    SELECT event_id, 'a' || event_id || '.tar' AS filename, user_id AS size,
           CASE event_type WHEN 'error' THEN user_id + 1 WHEN 'view' THEN NULL ELSE user_id END
               AS uploaded_size, ts
    FROM events
)
"""


def _sent(t):
    kind = F.col("event_type")
    return t.raw("events").select(
        F.concat(F.lit("a"), "event_id", F.lit(".tar")).alias("filename"),
        F.concat(F.lit("sounds/a"), "event_id", F.lit(".tar")).alias("key"),
        F.col("user_id").alias("source_size"),
        F.col("user_id").alias("staged_size"),
        F.when(kind == "error", F.col("user_id") + 1)
        .when(kind != "view", F.col("user_id"))
        .alias("uploaded_size"),
        F.concat(F.lit("i"), F.expr("event_id div 2")).alias("meta_id"),
    )


@check(
    "SNK16_deletable_sources",
    TRANSFER
    + """SELECT 'archive' AS kind, 'sounds/' || filename AS key FROM sent
WHERE uploaded_size = size
UNION ALL SELECT DISTINCT 'metadata', 'metadata/i' || (event_id // 2) || '.txt' FROM sent
WHERE uploaded_size = size""",
)
def _(t):
    verified = transfer.verified_sources(_sent(t))
    return transfer.deletable_sources(verified, _sent(t).select("filename", "meta_id"))


@check(
    "SNK17_expired_scratch", OBJECTS + f"SELECT key, length FROM objects WHERE {AGE} > 1440"
)
def _(t):
    return retention.expired_scratch(event_objects(t), latest_event(t)).select("key", "length")


# --- aggregates over job results ----------------------------------------------------


@check(
    "A27_unpack_stats",
    CONVERSIONS
    + """SELECT batch_id, count(*) AS mp3_found, count(*) FILTER (success) AS converted,
       count(*) FILTER (NOT success) AS failed, count(*) FILTER (success) AS queued,
       count(*) FILTER (success AND metadata IS NOT NULL) AS metadata_matched,
       count(metadata) AS metadata_records
FROM conversions LEFT JOIN metadata USING (batch_id, stem) GROUP BY batch_id""",
)
def _(t):
    return A.unpack_stats(conversions(t), file_metadata(t))


@check(
    "A27_batches_without_audio",
    CONVERSIONS
    + """, audio AS (SELECT * FROM conversions WHERE length(stem) % 3 = 0 AND batch_id NOT LIKE '%1')
SELECT coalesce(a.batch_id, m.batch_id) AS batch_id, coalesce(mp3_found, 0) AS mp3_found,
       coalesce(metadata_records, 0) AS metadata_records
FROM (SELECT batch_id, count(*) AS mp3_found FROM audio GROUP BY 1) a
FULL JOIN (SELECT batch_id, count(*) AS metadata_records FROM metadata GROUP BY 1) m
  ON a.batch_id = m.batch_id""",
)
def _(t):
    audio = conversions(t).where("length(stem) % 3 = 0 and batch_id not like '%1'")
    return A.unpack_stats(audio, file_metadata(t)).select(
        "batch_id", "mp3_found", "metadata_records"
    )


@check(
    "A28_attempt_totals",
    CONVERSIONS
    + """SELECT count(DISTINCT batch_id) AS batches, count(*) FILTER (success) AS success,
       count(*) FILTER (NOT success) AS failed FROM conversions""",
)
def _(t):
    return A.attempt_totals(conversions(t))


@check(
    "A29_run_summary",
    """SELECT count(*) AS total, count(*) FILTER (f.status <> 'failed') AS successful,
       count(*) FILTER (f.status = 'failed') AS errors,
       count(*) FILTER (c.flagged) AS flagged
FROM audio_files f LEFT JOIN pipeline_classifications c ON c.audio_file_id = f.id""",
)
def _(t):
    flags = t.classifications.select(F.col("audio_file_id").alias("id"), "flagged")
    results = t.audio_files.select(
        "id", F.when(F.col("status") == "failed", "failed").alias("error")
    ).join(flags, "id", "left")
    return A.run_summary(results)


@check(
    "A30_transfer_totals",
    TRANSFER
    + """SELECT count(*) FILTER (uploaded_size IS NOT DISTINCT FROM size) AS files_copied,
       count(*) FILTER (uploaded_size IS DISTINCT FROM size) AS files_skipped FROM sent""",
)
def _(t):
    from auricle.operators.joins import reconcile_sizes

    checked = reconcile_sizes(_sent(t)).withColumn(
        "outcome",
        F.when(F.col("size_check") == "verified", "queued").otherwise(F.col("size_check")),
    )
    return A.transfer_totals(checked)


@check(
    "A31_scratch_usage",
    """SELECT sum(bytes)::BIGINT AS total_bytes, count(*) AS directories,
       count(*) FILTER (last_change <= (SELECT max(ts) FROM events) - INTERVAL 120 MINUTES)
           AS old_directories
FROM (SELECT user_id, sum(event_id) AS bytes, max(ts) AS last_change FROM events GROUP BY 1)""",
)
def _(t):
    listing = t.raw("events").select(
        F.concat(F.lit("u"), "user_id", F.lit("/e"), "event_id").alias("key"),
        F.col("event_id").alias("length"),
        F.col("ts").alias("modification_time"),
    )
    return A.scratch_usage(listing, latest_event(t))
