"""The named views and table functions as temporary SQL objects of a session.

After `register_views` the usual statements run unchanged, for example
`SELECT * FROM pipeline_flagged_queue` or `SELECT * FROM check_sync_candidates(0.8)`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from auricle import clock
from auricle.operators import aggregates
from auricle.plans import queues


def register_views(
    spark: SparkSession,
    audio_files: DataFrame,
    pipeline_transcripts: DataFrame,
    pipeline_classifications: DataFrame,
    transcripts: DataFrame,
    creators: DataFrame,
    as_of: Column | None = None,
) -> None:
    """Register tables, views and table functions; windows end at `as_of`, by default now."""
    at = clock.now() if as_of is None else as_of
    core = (audio_files, pipeline_transcripts, pipeline_classifications)
    frames = {
        "audio_files": audio_files,
        "pipeline_transcripts": pipeline_transcripts,
        "pipeline_classifications": pipeline_classifications,
        "transcripts": transcripts,
        "creators": creators,
        "pipeline_flagged_queue": queues.flagged_queue(*core, at),
        "pipeline_sync_candidates": queues.sync_candidates(*core).select(
            *queues.SYNC_CANDIDATE_COLUMNS
        ),
        "daily_stats": aggregates.daily_status_counts(audio_files, at),
        "_rolling_totals": aggregates.rolling_totals(audio_files, at),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    for statement in _FUNCTIONS:
        spark.sql(statement)


def register_unified_views(
    spark: SparkSession,
    audio_files: DataFrame,
    pipeline_transcripts: DataFrame,
    pipeline_classifications: DataFrame,
    transcripts: DataFrame,
    as_of: Column | None = None,
) -> None:
    """The views of the unified variant, whose files carry a meta_id column."""
    at = clock.now() if as_of is None else as_of
    frames = {
        "ra_queue": queues.review_queue(transcripts, audio_files, at),
        "pipeline_ready_for_sync": queues.ready_for_sync(
            audio_files, pipeline_transcripts, pipeline_classifications
        ),
        "daily_pipeline_stats": aggregates.daily_pivot(audio_files, at),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    spark.sql(_TARGET)


_FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION check_pipeline_stats()
       RETURNS TABLE (total_processed BIGINT, flagged_count BIGINT, synced_count BIGINT,
                      pending_sync BIGINT)
       RETURN SELECT * FROM _rolling_totals""",
    """CREATE OR REPLACE TEMPORARY FUNCTION check_sync_candidates(
           score_threshold DOUBLE DEFAULT 0.7D)
       RETURNS TABLE (total_candidates BIGINT, above_threshold BIGINT, by_country STRING)
       RETURN
       WITH marked AS (
           SELECT coalesce(nullif(country, ''), 'unknown') AS country,
                  label_1_pred >= score_threshold AS hit
           FROM pipeline_sync_candidates
       ), per_country AS (
           SELECT country, count(*) AS n, count_if(hit) AS above FROM marked GROUP BY country
       )
       SELECT coalesce(sum(n), 0), coalesce(sum(above), 0),
              to_json(map_from_entries(array_sort(
                  collect_list(struct(country, above)) FILTER (WHERE above > 0))))
       FROM per_country""",
]

_TARGET = """CREATE OR REPLACE TEMPORARY FUNCTION check_ra_target(target_count INT DEFAULT 200)
    RETURNS TABLE (current_count BIGINT, target INT, target_met BOOLEAN, pipeline_pending BIGINT)
    RETURN SELECT q.n, target_count, q.n >= target_count,
                  (SELECT count(*) FROM pipeline_ready_for_sync)
    FROM (SELECT count(*) AS n FROM ra_queue) q"""
