"""Filters, projections, joins, ranks, limits and set operations."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.operators import filters, joins, ranking, sets
from auricle.plans import queues
from auricle.session import run_dir
from auricle_checks.aggregate_checks import READY
from auricle_checks.queue_checks import PENDING
from auricle_checks.registry import check

# --- filters ------------------------------------------------------------------


@check("F1_failed_files", "SELECT id, original_filename FROM audio_files WHERE status = 'failed'")
def _(t):
    return filters.with_status(t.audio_files, "failed").select("id", "original_filename")


@check("F1_one_batch", "SELECT id, status FROM audio_files WHERE archive_source = 'src7'")
def _(t):
    return filters.in_batches(t.audio_files, "src7").select("id", "status")


@check(
    "F2_flagged", "SELECT audio_file_id, flag_score FROM pipeline_classifications WHERE flagged"
)
def _(t):
    return filters.flagged_only(t.classifications).select("audio_file_id", "flag_score")


def _window(name, spark_interval, duck_interval):
    @check(
        name,
        f"""SELECT id, created_at FROM audio_files
WHERE created_at > (SELECT t FROM now_) - INTERVAL {duck_interval}""",
    )
    def _(t):
        return clock.recent(t.audio_files, t.as_of, spark_interval).select("id", "created_at")


_window("F3_last_6_hours", "6 HOURS", "6 HOURS")
_window("F3_last_24_hours", "24 HOURS", "24 HOURS")
_window("F3_last_48_hours", "48 HOURS", "48 HOURS")
_window("F3_last_7_days", "7 DAYS", "7 DAYS")


@check(
    "F4_score_threshold",
    "SELECT audio_file_id, flag_score FROM pipeline_classifications WHERE flag_score >= 0.7",
)
def _(t):
    return filters.at_least(t.classifications, "flag_score", 0.7).select(
        "audio_file_id", "flag_score"
    )


@check(
    "F5_batch_pattern",
    "SELECT id, archive_source FROM audio_files WHERE archive_source LIKE 's_c1%'",
)
def _(t):
    return filters.in_batches(t.audio_files, "s_c1%").select("id", "archive_source")


@check(
    "F6_stored_files", "SELECT id, s3_opus_path FROM audio_files WHERE s3_opus_path IS NOT NULL"
)
def _(t):
    return filters.stored(t.audio_files).select("id", "s3_opus_path")


@check("F6_unsynced_ids", "SELECT id FROM unified_files WHERE meta_id IS NULL")
def _(t):
    return t.unified_files.filter(F.col("meta_id").isNull()).select("id")


@check(
    "F7_with_metadata_id",
    """SELECT id, parquet_metadata FROM audio_files
WHERE json_extract_string(parquet_metadata, '$.meta_id') IS NOT NULL""",
)
def _(t):
    return filters.with_metadata_key(t.audio_files, "meta_id").select("id", "parquet_metadata")


@check(
    "F8_market",
    """SELECT id, opus_path FROM audio_files
WHERE parquet_country = 'NATION_3' AND parquet_lang = 'en'""",
)
def _(t):
    return filters.in_market(t.audio_files, "NATION_3", "en").select("id", "opus_path")


@check(
    "F9_has_transcript",
    """SELECT f.id, p.transcript_text IS NOT NULL AS has_transcript
FROM audio_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id""",
)
def _(t):
    texts = t.transcripts.select(
        F.col("audio_file_id").alias("id"), F.col("transcript_text").isNotNull().alias("present")
    )
    return (
        t.audio_files.select("id")
        .join(texts, "id", "left")
        .select("id", F.coalesce("present", F.lit(False)).alias("has_transcript"))
    )


@check(
    "F10_blank_text_verdict",
    r"""SELECT conv_id, turn, v AND NOT blank AS flagged,
       CASE WHEN v AND NOT blank THEN 1.0 ELSE 0.0 END AS flag_score,
       CASE WHEN v AND NOT blank THEN 'reportable_content' END AS flag_category
FROM (SELECT conv_id, turn, turn % 2 = 1 AS v,
             length(trim(CASE WHEN role = 'system' THEN ' ' || chr(10) || chr(9) ELSE text END,
                         ' ' || chr(10) || chr(9) || chr(13))) = 0 AS blank
      FROM conversations)""",
)
def _(t):
    turns = t.raw("conversations").withColumns(
        {
            "text": F.when(F.col("role") == "system", F.lit(" \n\t")).otherwise(F.col("text")),
            "response": (F.col("turn") % 2).cast("string"),
        }
    )
    return turns.select("conv_id", "turn", S.verdict("response", "text").alias("v")).select(
        "conv_id", "turn", "v.*"
    )


@check(
    "F11_validity_counts",
    """SELECT count(*) FILTER (s3_opus_path IS NOT NULL AND created_at IS NOT NULL) AS accepted,
       count(*) FILTER (s3_opus_path IS NULL OR created_at IS NULL) AS rejected
FROM audio_files""",
)
def _(t):
    return filters.validity_counts(t.audio_files, ["s3_opus_path", "created_at"])


@check(
    "F11_counted_while_written",
    """SELECT s3_opus_path IS NOT NULL AND created_at IS NOT NULL AS valid, count(*) AS n,
       count(*) AS counted FROM audio_files GROUP BY 1""",
)
def _(t):
    """Rows written once, by verdict; what was written beside what was counted on the way."""
    out = run_dir(t.spark, "validity")
    seen = Observation("validity")
    rows = filters.counted_validity(t.audio_files, ["s3_opus_path", "created_at"], seen)
    rows.select("id", "valid").write.partitionBy("valid").parquet(out)
    counts = [(True, seen.get["accepted"]), (False, seen.get["rejected"])]
    counted = t.spark.createDataFrame(counts, "valid BOOLEAN, counted BIGINT")
    written = t.spark.read.schema("id BIGINT, valid BOOLEAN").parquet(out)
    return written.groupBy("valid").agg(F.count("*").alias("n")).join(counted, "valid")


@check("F12_renamed_columns", READY)
def _(t):
    return queues.ready_for_sync(t.unified_files, t.transcripts, t.classifications)


FAILURES = """SELECT id, original_filename, archive_source, created_at FROM day_files
WHERE status = 'failed' ORDER BY created_at DESC, id LIMIT 20"""


@check("F13_recent_failures", FAILURES)
def _(t):
    return filters.recent_failures(t.audio_files, t.as_of)


# --- joins --------------------------------------------------------------------

CONVERSIONS = """, conversions AS (
    SELECT archive_source AS batch_id, 'v' || id AS stem, opus_path, original_filename,
           file_size_bytes, status <> 'failed' AS success
    FROM audio_files
), metadata AS (
    SELECT archive_source AS batch_id, 'v' || id AS stem, parquet_metadata AS metadata
    FROM audio_files
    WHERE json_extract_string(parquet_metadata, '$.meta_id') IS NOT NULL
)
"""


def conversions(t):
    """Conversion results: one per file, failed where the file's status says so."""
    return t.audio_files.select(
        F.col("archive_source").alias("batch_id"),
        F.concat(F.lit("v"), "id").alias("stem"),
        "opus_path",
        "original_filename",
        "file_size_bytes",
        (F.col("status") != "failed").alias("success"),
    )


def metadata(t):
    """Metadata rows, present where the file has a metadata id."""
    known = filters.with_metadata_key(t.audio_files, "meta_id")
    return known.select(
        F.col("archive_source").alias("batch_id"),
        F.concat(F.lit("v"), "id").alias("stem"),
        F.col("parquet_metadata").alias("metadata"),
    )


@check(
    "J1_attach_metadata",
    CONVERSIONS
    + """SELECT c.batch_id, c.stem, c.opus_path, coalesce(m.metadata, '{}') AS metadata,
       m.metadata IS NOT NULL AS matched
FROM conversions c LEFT JOIN metadata m USING (batch_id, stem)""",
)
def _(t):
    joined = joins.attach_metadata(conversions(t), metadata(t))
    return joined.select("batch_id", "stem", "opus_path", "metadata", "matched")


@check(
    "J2_scored_files",
    """SELECT f.id, p.id AS transcript_id, p.language, c.id AS classification_id, c.flagged,
       c.flag_score
FROM audio_files f JOIN pipeline_transcripts p ON p.audio_file_id = f.id
JOIN pipeline_classifications c ON c.audio_file_id = f.id""",
)
def _(t):
    rows = joins.scored_files(t.audio_files, t.transcripts, t.classifications)
    return rows.select(
        "id", "transcript_id", "language", "classification_id", "flagged", "flag_score"
    )


@check(
    "J3_coverage_join",
    """SELECT f.id, f.status, p.language, c.flagged::INT AS flagged
FROM audio_files f LEFT JOIN pipeline_transcripts p ON p.audio_file_id = f.id
LEFT JOIN pipeline_classifications c ON c.audio_file_id = f.id""",
)
def _(t):
    texts = t.transcripts.select(F.col("audio_file_id").alias("id"), "language")
    flags = t.classifications.select(
        F.col("audio_file_id").alias("id"), F.col("flagged").cast("int").alias("flagged")
    )
    files = t.audio_files.select("id", "status")
    return files.join(texts, "id", "left").join(flags, "id", "left")


@check(
    "J4_review_with_files",
    """SELECT r.meta_id, r.lang, u.id AS audio_file_id, u.opus_path
FROM review_rows r LEFT JOIN unified_files u ON u.meta_id = r.meta_id""",
)
def _(t):
    return joins.review_with_files(t.review_rows, t.unified_files).select(
        "meta_id", "lang", "audio_file_id", "opus_path"
    )


FILE_KEYS = "SELECT id, json_extract_string(parquet_metadata, '$.meta_id') AS meta_id FROM audio_files"


def file_keys(t):
    return t.audio_files.select("id", S.json_text("parquet_metadata", "meta_id").alias("meta_id"))


@check(
    "J5_already_reviewed",
    f"SELECT id, meta_id FROM ({FILE_KEYS}) WHERE meta_id IN (SELECT meta_id FROM review_rows)",
)
def _(t):
    return joins.existing(file_keys(t), t.review_rows, "meta_id").select("id", "meta_id")


@check(
    "J6_insert_if_new",
    f"""SELECT min(id) AS id, meta_id FROM ({FILE_KEYS})
WHERE meta_id NOT IN (SELECT meta_id FROM review_rows) GROUP BY meta_id""",
)
def _(t):
    return joins.new_rows(file_keys(t), t.review_rows, "meta_id", ["id"])


AUTHOR_KEYS = """SELECT DISTINCT json_extract_string(parquet_metadata, '$.author_uniqueid')
    AS author_uniqueid FROM audio_files"""


@check(
    "J7_get_or_create",
    f""", authors AS ({AUTHOR_KEYS}), fresh AS (
    SELECT author_uniqueid,
           (SELECT max(creator_id) FROM creators) + row_number() OVER (ORDER BY author_uniqueid)
               AS creator_id
    FROM authors WHERE author_uniqueid NOT IN (SELECT author_uniqueid FROM creators)
)
SELECT a.author_uniqueid, coalesce(c.creator_id, f.creator_id) AS creator_id
FROM authors a LEFT JOIN creators c USING (author_uniqueid)
LEFT JOIN fresh f USING (author_uniqueid)""",
)
def _(t):
    from auricle.operators.changes import get_or_create

    authors = t.audio_files.select(
        S.json_text("parquet_metadata", "author_uniqueid").alias("author_uniqueid")
    )
    return get_or_create(authors, t.creators, "author_uniqueid", "creator_id")


@check(
    "J8_totals_in_one_row",
    """SELECT f.n AS files, r.n AS reviewed, f.n - r.n AS rest
FROM (SELECT count(*) AS n FROM audio_files) f, (SELECT count(*) AS n FROM review_rows) r""",
)
def _(t):
    from auricle.operators.aggregates import row_count

    files = t.audio_files.agg(F.count("*").alias("files"))
    return files.withColumn("reviewed", row_count(t.review_rows)).withColumn(
        "rest", F.col("files") - F.col("reviewed")
    )


# Objects that exist: the stored path of every file that was not synced.
LISTING = """, listing AS (
    SELECT s3_opus_path AS key, file_size_bytes AS length FROM audio_files
    WHERE s3_opus_path IS NOT NULL AND NOT synced_to_ra
)
"""


def listing(t):
    return filters.stored(t.audio_files).filter(~F.col("synced_to_ra")).select(
        F.col("s3_opus_path").alias("key"), F.col("file_size_bytes").alias("length")
    )


@check(
    "J9_expected_objects",
    LISTING
    + """SELECT f.id, f.s3_opus_path AS path, l.key IS NOT NULL AS "exists"
FROM audio_files f LEFT JOIN listing l ON l.key = f.s3_opus_path
WHERE f.s3_opus_path IS NOT NULL""",
)
def _(t):
    return joins.expected_objects(t.audio_files, listing(t)).select("id", "path", "exists")


@check(
    "J9_object_summary",
    LISTING
    + """SELECT count(l.key) AS found, count(*) - count(l.key) AS missing
FROM audio_files f LEFT JOIN listing l ON l.key = f.s3_opus_path
WHERE f.s3_opus_path IS NOT NULL""",
)
def _(t):
    return joins.object_summary(joins.expected_objects(t.audio_files, listing(t)))


# A manifest in which documents play the archives: for some languages a stage changes the size.
MANIFEST = """, manifest AS (
    SELECT d.doc_id, d.n_chars AS source_size,
           CASE WHEN d.lang = 'de' THEN length(d.text) + 1 ELSE length(d.text) END AS staged_size,
           CASE WHEN d.lang = 'fr' THEN NULL ELSE d.n_chars END AS uploaded_size
    FROM documents d
)
"""


@check(
    "J10_reconcile_sizes",
    MANIFEST
    + """SELECT doc_id, CASE WHEN source_size IS DISTINCT FROM staged_size THEN 'staging_mismatch'
       WHEN staged_size IS DISTINCT FROM uploaded_size THEN 'upload_mismatch'
       ELSE 'verified' END AS size_check FROM manifest""",
)
def _(t):
    manifest = t.raw("documents").select(
        "doc_id",
        F.col("n_chars").alias("source_size"),
        (F.length("text") + F.when(F.col("lang") == "de", 1).otherwise(0))
        .cast("long")
        .alias("staged_size"),
        F.when(F.col("lang") != "fr", F.col("n_chars")).alias("uploaded_size"),
    )
    return joins.reconcile_sizes(manifest).select("doc_id", "size_check")


@check(
    "J11_children_of_batch",
    """SELECT id, audio_file_id FROM pipeline_classifications
WHERE audio_file_id IN (SELECT id FROM audio_files WHERE archive_source = 'src3')""",
)
def _(t):
    ids = filters.in_batches(t.audio_files, "src3").select(F.col("id").alias("audio_file_id"))
    return t.classifications.join(ids, "audio_file_id", "left_semi").select("id", "audio_file_id")


@check(
    "J12_keys_of_files",
    LISTING
    + """SELECT f.id AS audio_file_id, l.key, l.length
FROM listing l JOIN audio_files f ON l.key = f.s3_opus_path""",
)
def _(t):
    return joins.keys_of_files(listing(t), t.audio_files)


# Files whose objects are numbered anew in every batch, so a stem is found in many of them.
@check(
    "J12_shared_stems",
    """SELECT id AS audio_file_id, 'processed/' || archive_source || '/' || (id % 50) || '-' || (id // 50) || '/v.opus' AS key,
       file_size_bytes AS length FROM audio_files""",
)
def _(t):
    path = F.concat(
        F.lit("processed/"), "archive_source", F.lit("/"), F.col("id") % 50, F.lit("-"),
        F.expr("id div 50"), F.lit("/v.opus"),
    )
    files = t.audio_files.withColumn("s3_opus_path", path)
    objects = files.select(path.alias("key"), F.col("file_size_bytes").alias("length"))
    return joins.keys_of_files(objects, files)


# --- ranks and limits -----------------------------------------------------------


@check(
    "W1_last_per_key",
    f"""SELECT * FROM ({FILE_KEYS}) WHERE meta_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY id DESC) = 1""",
)
def _(t):
    return ranking.last_per_key(file_keys(t), "meta_id", ["id"])


# Candidates over every file with a metadata id: valid when the file was converted.
WALK = """, ranked AS (
    SELECT id AS rk, json_extract_string(parquet_metadata, '$.meta_id') AS meta_id,
           status <> 'failed' AS valid,
           json_extract_string(parquet_metadata, '$.meta_id')
               IN (SELECT meta_id FROM review_rows) AS exists_already
    FROM audio_files
    WHERE json_extract_string(parquet_metadata, '$.meta_id') IS NOT NULL
), steps AS (
    SELECT *, coalesce(max(valid::INT) OVER (PARTITION BY meta_id ORDER BY rk
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen_valid
    FROM ranked
)
SELECT rk, meta_id, CASE WHEN exists_already OR seen_valid = 1 THEN 'skipped'
       WHEN valid THEN 'synced' ELSE 'error' END AS outcome
FROM steps"""


@check("W2_first_valid_wins", WALK)
def _(t):
    known = t.review_rows.select("meta_id", F.lit(True).alias("known"))
    ranked = (
        t.audio_files.select(
            F.col("id").alias("rk"),
            S.json_text("parquet_metadata", "meta_id").alias("meta_id"),
            (F.col("status") != "failed").alias("valid"),
        )
        .filter(F.col("meta_id").isNotNull())
        .join(known, "meta_id", "left")
        .withColumn("exists_already", F.coalesce("known", F.lit(False)))
    )
    return ranking.label_outcomes(ranked).select("rk", "meta_id", "outcome")


@check("T1_top_flagged", PENDING)
def _(t):
    return queues.pending_flagged(t.audio_files, t.transcripts, t.classifications, t.as_of, 100)


@check(
    "T2_top_by_json_number",
    """SELECT id, json_extract_string(parquet_metadata, '$.stats_playcount')::INT AS plays
FROM audio_files ORDER BY plays DESC NULLS FIRST, id LIMIT 10""",
)
def _(t):
    plays = t.audio_files.select("id", S.json_int("parquet_metadata", "stats_playcount").alias("plays"))
    return ranking.top_k(plays, "plays", 10, "id")


@check("T3_first_by_id", "SELECT id, status FROM audio_files ORDER BY id LIMIT 50")
def _(t):
    return ranking.first_k(t.audio_files.select("id", "status"), 50, "id")


@check(
    "T4_newest_batches",
    """SELECT archive_source, min(created_at) AS started FROM audio_files
GROUP BY 1 ORDER BY started DESC, archive_source LIMIT 20""",
)
def _(t):
    started = t.audio_files.groupBy("archive_source").agg(F.min("created_at").alias("started"))
    return ranking.top_k(started, "started", 20, "archive_source")


@check(
    "T5_counts_descending",
    """SELECT parquet_country, count(*) AS count,
       row_number() OVER (ORDER BY count(*) DESC, parquet_country) AS position
FROM audio_files GROUP BY 1""",
)
def _(t):
    from pyspark.sql import Window

    from auricle.operators.aggregates import counts_by

    # One row per country reaches the window.
    counts = counts_by(t.audio_files, "parquet_country")
    order = Window.orderBy(F.desc("count"), F.asc_nulls_last("parquet_country"))
    return counts.withColumn("position", F.row_number().over(order).cast("long"))


@check(
    "T6_multi_key_order",
    """SELECT created_at::DATE::VARCHAR AS date, status, count(*) AS count,
       row_number() OVER (ORDER BY created_at::DATE DESC, status) AS position
FROM audio_files GROUP BY created_at::DATE, status""",
)
def _(t):
    from pyspark.sql import Window

    from auricle.operators.aggregates import daily_status_counts

    # One row per day and status reaches the window.
    rows = daily_status_counts(t.audio_files, t.as_of)
    order = Window.orderBy(F.desc_nulls_first("date"), F.asc_nulls_last("status"))
    placed = rows.withColumn("position", F.row_number().over(order).cast("long"))
    return placed.withColumn("date", F.col("date").cast("string"))


# --- sets -----------------------------------------------------------------------


@check(
    "U1_union_of_listings",
    """SELECT original_filename AS name, 'lower' AS kind FROM audio_files
UNION ALL SELECT upper(original_filename), 'upper' FROM audio_files""",
)
def _(t):
    lower = t.audio_files.select(
        F.col("original_filename").alias("name"), F.lit("lower").alias("kind")
    )
    upper = t.audio_files.select(
        F.lit("upper").alias("kind"), F.upper("original_filename").alias("name")
    )
    return sets.union_all(lower, upper)


@check(
    "U2_union_with_different_columns",
    """SELECT doc_id AS id, lang, NULL AS url FROM documents
UNION ALL SELECT page_id, NULL, url FROM pages""",
)
def _(t):
    docs = t.raw("documents").select(F.col("doc_id").alias("id"), "lang")
    pages = t.raw("pages").select(F.col("page_id").alias("id"), "url")
    return sets.union_loose(docs, pages)


@check(
    "U3_missing_names",
    f"SELECT * FROM ({AUTHOR_KEYS}) EXCEPT SELECT author_uniqueid FROM creators",
)
def _(t):
    required = t.audio_files.select(
        S.json_text("parquet_metadata", "author_uniqueid").alias("author_uniqueid")
    )
    return sets.missing_names(required, t.creators, "author_uniqueid")


@check(
    "U4_keys_without_preserved",
    """SELECT s3_opus_path AS key FROM audio_files WHERE s3_opus_path IS NOT NULL
UNION ALL SELECT archive_source FROM audio_files WHERE archive_source NOT IN ('src1', 'src2')""",
)
def _(t):
    keys = sets.union_all(
        filters.stored(t.audio_files).select(F.col("s3_opus_path").alias("key")),
        t.audio_files.select(F.col("archive_source").alias("key")),
    )
    return sets.without_preserved(keys, ("src1", "src2"))
