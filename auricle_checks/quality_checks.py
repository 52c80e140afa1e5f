"""Constraint checks and delete effects."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import changes
from auricle.operators import quality as Q
from auricle_checks.registry import check


@check(
    "DQ1_domain",
    """SELECT id, 'domain:status' AS rule FROM audio_files
WHERE status NOT IN ('pending', 'transcribed', 'flagged')""",
)
def _(t):
    allowed = ["pending", "transcribed", "flagged"]
    return Q.violations(t.audio_files, ["id"], {"domain:status": Q.in_domain("status", allowed)})


@check(
    "DQ2_range",
    """SELECT event_id, 'range:value' AS rule FROM events WHERE value NOT BETWEEN 1 AND 100
UNION ALL SELECT event_id, 'range:day' FROM events WHERE day(ts) > 20""",
)
def _(t):
    rules = {"range:value": Q.in_range("value", 1, 100), "range:day": Q.in_range("day", 1, 20)}
    return Q.violations(
        t.raw("events").withColumn("day", F.dayofmonth("ts")), ["event_id"], rules
    )


@check(
    "DQ3_not_null",
    """SELECT id, 'required:s3_opus_path' AS rule FROM audio_files WHERE s3_opus_path IS NULL
UNION ALL SELECT id, 'required:synced_at' FROM audio_files WHERE synced_at IS NULL""",
)
def _(t):
    rules = {f"required:{c}": Q.present(c) for c in ("s3_opus_path", "synced_at")}
    return Q.violations(t.audio_files, ["id"], rules)


META = "SELECT id, json_extract_string(parquet_metadata, '$.meta_id') AS meta_id, status FROM audio_files"


def _meta(t):
    return t.audio_files.select(
        "id", S.json_text("parquet_metadata", "meta_id").alias("meta_id"), "status"
    )


@check(
    "DQ4_unique",
    f"""SELECT meta_id, count(*) AS copies FROM ({META}) WHERE meta_id IS NOT NULL
GROUP BY 1 HAVING count(*) > 1""",
)
def _(t):
    return Q.duplicate_keys(_meta(t), ["meta_id"])


@check(
    "DQ4_composite_unique",
    f"""SELECT meta_id, status, count(*) AS copies FROM ({META}) WHERE meta_id IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(t):
    return Q.duplicate_keys(_meta(t), ["meta_id", "status"])


@check(
    "DQ5_one_active",
    """SELECT count(*) AS active FROM audio_files WHERE status = 'flagged'
HAVING count(*) > 1""",
)
def _(t):
    return Q.more_than_one(t.audio_files, F.col("status") == "flagged")


@check(
    "DQ6_orphans",
    f"""SELECT id, meta_id FROM ({META}) WHERE meta_id IS NOT NULL
AND meta_id NOT IN (SELECT meta_id FROM review_rows)""",
)
def _(t):
    return Q.orphans(_meta(t), "meta_id", t.review_rows, "meta_id").select("id", "meta_id")


@check(
    "DQ7_lengths",
    """SELECT doc_id, 'length:text' AS rule FROM documents WHERE length(text) > 2000
UNION ALL SELECT doc_id, 'decimal:n_chars' FROM documents
WHERE TRY_CAST(n_chars AS DECIMAL(4,1)) IS NULL""",
)
def _(t):
    rules = {
        "length:text": Q.at_most_chars("text", 2000),
        "decimal:n_chars": Q.fits_decimal("n_chars", 4, 1),
    }
    return Q.violations(t.raw("documents"), ["doc_id"], rules)


@check(
    "DQ_review_table_rules",
    """SELECT meta_id, 'domain:queue_status' AS rule FROM review_rows
WHERE queue_status NOT IN ('unqueued', 'queued', 'in_progress', 'completed', 'excluded')""",
)
def _(t):
    return Q.check_table(t.review_rows, "transcripts")


# Parents to delete: all flagged files, and all known creators.
@check(
    "DQ8_cascade",
    """SELECT id, audio_file_id, language FROM pipeline_transcripts
WHERE audio_file_id NOT IN (SELECT id FROM audio_files WHERE status = 'flagged')""",
)
def _(t):
    gone = t.audio_files.filter(F.col("status") == "flagged")
    left = Q.delete_effect(t.transcripts, "pipeline_transcripts", "audio_file_id", gone)
    return left.select("id", "audio_file_id", "language")


@check(
    "DQ8_set_null",
    """SELECT meta_id, CASE WHEN creator_id NOT IN (SELECT creator_id FROM creators)
                      THEN creator_id END AS creator_id FROM review_rows""",
)
def _(t):
    left = Q.delete_effect(t.review_rows, "transcripts", "creator_id", t.creators)
    return left.select("meta_id", "creator_id")


@check(
    "DQ8_restrict",
    """SELECT creator_id, author_uniqueid FROM creators
WHERE creator_id IN (SELECT creator_id FROM review_rows)""",
)
def _(t):
    refused = Q.restricted(t.creators, "creator_id", t.review_rows, "creator_id")
    return refused.select("creator_id", "author_uniqueid")


# --- table changes ----------------------------------------------------------------


@check(
    "SNK1_insert_files",
    """SELECT (SELECT max(id) FROM audio_files) + row_number() OVER (ORDER BY url) AS id,
       url AS original_filename, 'pending' AS status, false AS synced_to_ra
FROM pages""",
)
def _(t):
    records = t.raw("pages").select(
        F.col("url").alias("original_filename"),
        F.col("url").alias("opus_path"),
        F.lit("pages").alias("archive_source"),
        F.lit(None).cast("double").alias("duration_seconds"),
        F.length("html").alias("file_size_bytes"),
    )
    rows = changes.new_audio_files(records, t.audio_files, t.as_of)
    return rows.select("id", "original_filename", "status", "synced_to_ra")


@check(
    "SNK2_insert_transcripts",
    """SELECT (SELECT max(id) FROM pipeline_transcripts) + row_number() OVER (ORDER BY doc_id) AS id,
       doc_id AS audio_file_id, sha256(text) AS digest, lang AS language, 0.5 AS confidence
FROM documents""",
)
def _(t):
    scored = t.raw("documents").select(
        F.col("doc_id").alias("audio_file_id"),
        "text",
        F.col("lang").alias("language"),
        F.lit(0.5).cast("double").alias("confidence"),
    )
    rows = changes.new_transcripts(scored, t.transcripts, t.as_of)
    return rows.select(
        "id",
        "audio_file_id",
        F.sha2(F.col("transcript_text").cast("binary"), 256).alias("digest"),
        "language",
        "confidence",
    )


@check(
    "SNK3_insert_classifications",
    """SELECT (SELECT max(id) FROM pipeline_classifications) + row_number() OVER (ORDER BY doc_id) AS id,
       doc_id AS audio_file_id, lang = 'en' AS flagged, n_chars::DOUBLE AS flag_score
FROM documents""",
)
def _(t):
    scored = t.raw("documents").select(
        F.col("doc_id").alias("audio_file_id"),
        (F.col("lang") == "en").alias("flagged"),
        F.col("n_chars").cast("double").alias("flag_score"),
        F.lit(None).cast("string").alias("flag_category"),
    )
    rows = changes.new_classifications(scored, t.classifications, t.as_of)
    return rows.select("id", "audio_file_id", "flagged", "flag_score")


# Every event is a status change of the file numbered like its user, so files get many changes.
@check(
    "SNK4_status_updates",
    """SELECT f.id, coalesce(e.event_type, f.status) AS status,
       coalesce(e.ts, f.processed_at) AS processed_at
FROM audio_files f LEFT JOIN (
    SELECT user_id, event_type, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
) e ON e.user_id = f.id""",
)
def _(t):
    events = t.raw("events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
    )
    return changes.apply_status(t.audio_files, events).select("id", "status", "processed_at")


@check(
    "SNK5_path_updates",
    """SELECT f.id, coalesce(e.path, f.s3_opus_path) AS s3_opus_path
FROM audio_files f LEFT JOIN (
    SELECT user_id, 'processed/' || event_id || '.opus' AS path FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
) e ON e.user_id = f.id""",
)
def _(t):
    events = t.raw("events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("processed/"), "event_id", F.lit(".opus")).alias("s3_opus_path"),
        F.col("event_id").alias("seq"),
    )
    return changes.apply_paths(t.audio_files, events).select("id", "s3_opus_path")


@check(
    "SNK6_store_metadata",
    """SELECT f.id, CASE WHEN d.doc_id IS NULL THEN f.parquet_lang ELSE d.lang END AS parquet_lang,
       CASE WHEN d.doc_id IS NULL THEN f.parquet_country END AS parquet_country,
       coalesce('{"lang":"' || d.lang || '","n_chars":' || d.n_chars || '}', f.parquet_metadata)
           AS parquet_metadata
FROM audio_files f
LEFT JOIN (SELECT * FROM documents WHERE lang <> 'en') d ON d.doc_id = f.id""",
)
def _(t):
    events = (
        t.raw("documents")
        .filter(F.col("lang") != "en")
        .select(
            F.col("doc_id").alias("id"),
            S.row_json("lang", "n_chars").alias("metadata"),
            F.lit(1).alias("seq"),
        )
    )
    return changes.apply_metadata(t.audio_files, events).select(
        "id", "parquet_lang", "parquet_country", "parquet_metadata"
    )


@check(
    "SNK6_matched_updates",
    """SELECT DISTINCT event_id AS id, event_id IN (SELECT id FROM audio_files) AS updated
FROM events""",
)
def _(t):
    events = t.raw("events").select(F.col("event_id").alias("id"))
    return changes.matched_updates(events, t.audio_files)


@check(
    "SNK14_delete_batch",
    """SELECT 'files' AS part, count(*) AS n, sum(id)::BIGINT AS ids FROM audio_files
WHERE archive_source <> 'src5'
UNION ALL SELECT 'transcripts', count(*), sum(id)::BIGINT FROM pipeline_transcripts
WHERE audio_file_id NOT IN (SELECT id FROM audio_files WHERE archive_source = 'src5')
UNION ALL SELECT 'classifications', count(*), sum(id)::BIGINT FROM pipeline_classifications
WHERE audio_file_id NOT IN (SELECT id FROM audio_files WHERE archive_source = 'src5')""",
)
def _(t):
    left = changes.delete_batch(t.audio_files, t.transcripts, t.classifications, "src5")
    names = ("files", "transcripts", "classifications")
    counted = [
        frame.agg(F.count("*").alias("n"), F.sum("id").alias("ids")).select(
            F.lit(name).alias("part"), "n", "ids"
        )
        for name, frame in zip(names, left)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# Rows of the declared tables, made of documents so that every kind of rule is broken by some.
BROKEN = """
WITH rows_ AS (
    SELECT 'm' || doc_id AS meta_id, doc_id % 15 AS month, doc_id % 40 AS day,
           CASE WHEN doc_id % 7 > 0 THEN lang END AS transcript,
           CASE WHEN doc_id % 4 = 0 THEN 'lost' ELSE 'queued' END AS queue_status,
           repeat('x', (doc_id % 60)::INT) AS country
    FROM documents
)
SELECT meta_id, 'range:month' AS rule FROM rows_ WHERE month NOT BETWEEN 1 AND 12
UNION ALL SELECT meta_id, 'range:day' FROM rows_ WHERE day NOT BETWEEN 1 AND 31
UNION ALL SELECT meta_id, 'required:transcript' FROM rows_ WHERE transcript IS NULL
UNION ALL SELECT meta_id, 'domain:queue_status' FROM rows_ WHERE queue_status = 'lost'
UNION ALL SELECT meta_id, 'length:country' FROM rows_ WHERE length(country) > 50
"""


@check("DQ_broken_review_rows", BROKEN, whole=True)
def _(t):
    rows = t.raw("documents").select(
        F.concat(F.lit("m"), "doc_id").alias("meta_id"),
        (F.col("doc_id") % 15).alias("month"),
        (F.col("doc_id") % 40).alias("day"),
        F.when(F.col("doc_id") % 7 > 0, F.col("lang")).alias("transcript"),
        F.when(F.col("doc_id") % 4 == 0, "lost").otherwise("queued").alias("queue_status"),
        F.expr("repeat('x', cast(doc_id % 60 as int))").alias("country"),
    )
    return Q.check_table(rows, "transcripts")


@check(
    "DQ_repeated_users",
    """SELECT 'email' AS key, 'e' || custkey AS value, copies FROM (
    SELECT c_custkey % 90 AS custkey, count(*) AS copies FROM customer GROUP BY 1) WHERE copies > 1
UNION ALL SELECT 'username', 'n' || c_nationkey, count(*) FROM customer GROUP BY c_nationkey
HAVING count(*) > 1""",
    whole=True,
)
def _(t):
    users = t.raw("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("e"), F.col("c_custkey") % 90).alias("email"),
        F.concat(F.lit("n"), "c_nationkey").alias("username"),
    )
    parts = [
        found.select(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"), "copies")
        for found in Q.check_uniques(users, "users")
        for c in found.columns
        if c != "copies"
    ]
    return reduce(DataFrame.unionByName, parts)


@check(
    "DQ_orphans_of_declared_keys",
    """SELECT 'queue_assignments.user_id' AS relation, count(*) AS orphans FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 > 0)
UNION ALL SELECT 'queue_assignments.meta_id', count(*) FROM orders
WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)""",
    whole=True,
)
def _(t):
    rows = t.raw("orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("meta_id")
    )
    parents = {
        "users": t.raw("customer").where("c_custkey % 5 > 0").select(
            F.col("c_custkey").alias("user_id")
        ),
        "transcripts": t.raw("documents").select(F.col("doc_id").alias("meta_id")),
    }
    parts = [
        Q.orphans(rows, column, parents[parent], key).agg(
            F.lit(f"{child}.{column}").alias("relation"), F.count("*").alias("orphans")
        )
        for child, column, parent, key, _ in Q.FOREIGN_KEYS
        if child == "queue_assignments" and parent in parents
    ]
    return reduce(DataFrame.unionByName, parts)
