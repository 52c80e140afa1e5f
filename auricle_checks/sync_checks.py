"""Sync into the review tables."""

from pyspark.sql import functions as F

from auricle.plans import sync
from auricle.session import run_dir
from auricle_checks.aggregate_checks import CANDIDATES, READY, SUMMARY_SQL
from auricle_checks.registry import check

THRESHOLD = 0.7
LIMIT = 100

# The outcome labels from a walk over the ranked candidates: every candidate here is valid, so
# the first of a metadata id is synced unless the id was there before.
OUTCOMES = (
    CANDIDATES
    + f""", ranked AS (
    SELECT *, row_number() OVER (ORDER BY label_1_pred DESC, audio_file_id) AS rk
    FROM candidates WHERE label_1_pred >= {THRESHOLD}
    QUALIFY rk <= {LIMIT}
), outcomes AS (
    SELECT *, CASE WHEN meta_id IN (SELECT meta_id FROM review_rows) THEN 'skipped'
                   WHEN row_number() OVER (PARTITION BY meta_id ORDER BY rk) = 1 THEN 'synced'
                   ELSE 'skipped' END AS outcome
    FROM ranked
)
"""
)
SYNC_SUMMARY = (
    OUTCOMES
    + """SELECT count(*) FILTER (outcome = 'synced') AS synced_count,
       count(*) FILTER (outcome = 'skipped') AS skipped_existing,
       count(*) FILTER (outcome = 'error') AS errors FROM outcomes"""
)


def plan(t, limit=LIMIT, files=None, review_rows=None, creators=None):
    return sync.plan_sync(
        t.audio_files if files is None else files,
        t.transcripts,
        t.classifications,
        t.review_rows if review_rows is None else review_rows,
        t.creators if creators is None else creators,
        t.as_of,
        THRESHOLD,
        limit,
    )


@check("P3_sync_summary", SYNC_SUMMARY)
def _(t):
    return plan(t).summary


@check("UD1_sync_summary", SYNC_SUMMARY)
def _(t):
    return plan(t).summary


@check(
    "P3_sync_outcomes",
    OUTCOMES + "SELECT rk::INT AS rk, audio_file_id, meta_id, outcome FROM outcomes",
)
def _(t):
    return plan(t).outcomes.select("rk", "audio_file_id", "meta_id", "outcome")


@check(
    "P3_limited_outcomes",
    OUTCOMES.replace(f"<= {LIMIT}", "<= 5")
    + "SELECT rk::INT AS rk, audio_file_id, meta_id, outcome FROM outcomes",
)
def _(t):
    return plan(t, 5).outcomes.select("rk", "audio_file_id", "meta_id", "outcome")


@check(
    "P3_invalid_candidates",
    CANDIDATES
    + f""", ranked AS (
    SELECT *, row_number() OVER (ORDER BY label_1_pred DESC, audio_file_id) AS rk
    FROM candidates WHERE label_1_pred >= {THRESHOLD} QUALIFY rk <= {LIMIT}
), firsts AS (
    SELECT meta_id, min(rk) FILTER (audio_file_id % 2 = 1) AS first_valid FROM ranked GROUP BY 1
)
SELECT rk::INT AS rk, audio_file_id,
       CASE WHEN meta_id IN (SELECT meta_id FROM review_rows) THEN 'skipped'
            WHEN first_valid IS NULL OR rk < first_valid THEN 'error'
            WHEN rk = first_valid THEN 'synced' ELSE 'skipped' END AS outcome
FROM ranked JOIN firsts USING (meta_id)""",
)
def _(t):
    """Files with an even id have a country that the review table cannot hold."""
    long = F.when(F.col("id") % 2 == 0, F.lit("x" * 51)).otherwise(F.col("parquet_country"))
    files = t.audio_files.withColumn("parquet_country", long)
    return plan(t, files=files).outcomes.select("rk", "audio_file_id", "outcome")


@check(
    "P3_two_runs",
    OUTCOMES.replace(f"<= {LIMIT}", "<= 10")
    + """SELECT DISTINCT audio_file_id AS id, meta_id, outcome = 'synced' AS added
FROM outcomes WHERE outcome <> 'error'""",
)
def _(t):
    """Two runs of five take what one run of ten would."""
    root = run_dir(t.spark, "sync-runs")
    tables = t.audio_files, t.review_rows, t.creators
    outcomes = []
    for run in ("1", "2"):
        written = sync.earlier_runs(t.spark, root)
        files, review_rows, creators = sync.after_runs(*tables, written)
        made = plan(t, 5, files, review_rows, creators)
        sync.write_sync(made, root, run)
        outcomes.append(made.outcomes.select("audio_file_id", "meta_id", "outcome"))
    both = outcomes[0].unionByName(outcomes[1]).where("outcome <> 'error'")
    return both.select(
        F.col("audio_file_id").alias("id"), "meta_id", (F.col("outcome") == "synced").alias("added")
    ).distinct()


NEW_CREATORS = """, fresh AS (
    SELECT author_uniqueid, min(rk) AS rk FROM outcomes
    WHERE outcome = 'synced' AND author_uniqueid NOT IN (SELECT author_uniqueid FROM creators)
    GROUP BY 1
), new_creators AS (
    SELECT (SELECT max(creator_id) FROM creators) + row_number() OVER (ORDER BY rk) AS creator_id,
           author_uniqueid, (SELECT t FROM now_) AS created_at
    FROM fresh
)
"""


@check("P3_new_creators", OUTCOMES + NEW_CREATORS + "SELECT * FROM new_creators")
def _(t):
    return plan(t).creators


@check(
    "P3_new_review_rows",
    OUTCOMES
    + NEW_CREATORS
    + """SELECT o.meta_id, o.year, o.month, o.day, o.transcript, o.created_at, c.creator_id,
       o.label_1_pred::DECIMAL(10,9)::DOUBLE AS label_1_pred, o.country, o.lang,
       'unqueued' AS queue_status, 'unreviewed' AS review_status
FROM outcomes o LEFT JOIN (
    SELECT creator_id, author_uniqueid FROM creators
    UNION ALL SELECT creator_id, author_uniqueid FROM new_creators
) c USING (author_uniqueid)
WHERE o.outcome = 'synced'""",
)
def _(t):
    rows = plan(t).review_rows
    return rows.withColumn("label_1_pred", F.col("label_1_pred").cast("double"))


@check(
    "P3_file_updates",
    OUTCOMES
    + """SELECT DISTINCT audio_file_id AS id, (SELECT t FROM now_) AS at FROM outcomes
WHERE outcome <> 'error'""",
)
def _(t):
    return plan(t).file_events


NAME_SYNC = f""", taken AS (
    SELECT *, regexp_replace(original_filename, '\\.[^.]+$', '') AS meta_id,
           row_number() OVER (ORDER BY flag_score DESC, audio_file_id) AS rk
    FROM ({READY}) QUALIFY rk <= 100
)
"""
NAME_SYNC_SUMMARY = (
    NAME_SYNC
    + """SELECT count(*) AS synced_count, string_agg(meta_id, ',' ORDER BY rk) AS meta_ids
FROM taken"""
)


def plan_by_name(t):
    return sync.plan_sync_by_name(
        t.unified_files, t.transcripts, t.classifications, t.review_rows, 100
    )


def _name_summary(t):
    row = plan_by_name(t).summary
    return row.withColumn("meta_ids", F.array_join("meta_ids", ","))


for _name in ("P4_sync_by_name", "UD4_sync_by_name", "SC28_appended_ids"):
    check(_name, NAME_SYNC_SUMMARY)(_name_summary)


@check(
    "P4_new_review_rows",
    NAME_SYNC
    + """SELECT meta_id, year(created_at)::INT AS year, month(created_at)::INT AS month,
       day(created_at)::INT AS day, transcript_text AS transcript,
       flag_score::DECIMAL(10,9)::DOUBLE AS label_1_pred, language AS lang,
       'unqueued' AS queue_status, audio_file_id, created_at
FROM taken WHERE meta_id NOT IN (SELECT meta_id FROM review_rows)""",
)
def _(t):
    rows = plan_by_name(t).review_rows
    return rows.withColumn("label_1_pred", F.col("label_1_pred").cast("double"))


@check("P5_sync_dry_run", SUMMARY_SQL)
def _(t):
    return sync.dry_run(t.audio_files, t.transcripts, t.classifications, THRESHOLD)
