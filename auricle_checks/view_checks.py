"""The named views and table functions, called through SQL."""

from auricle import views
from auricle_checks.aggregate_checks import SUMMARY_SQL, TARGET_SQL, TOTALS
from auricle_checks.registry import check
from auricle_checks.tables import Tables


def _register(t: Tables) -> None:
    views.register_views(
        t.spark,
        t.audio_files,
        t.transcripts,
        t.classifications,
        t.review_rows,
        t.creators,
        t.as_of,
    )
    views.register_unified_views(
        t.spark, t.unified_files, t.transcripts, t.classifications, t.review_rows, t.as_of
    )


@check("UD2_sql_table_function", TOTALS)
def _(t):
    _register(t)
    return t.spark.sql("SELECT * FROM check_pipeline_stats()")


@check("UD3_sql_table_function", SUMMARY_SQL)
def _(t):
    _register(t)
    return t.spark.sql("SELECT * FROM check_sync_candidates(0.7D)")


@check("UD5_sql_table_function", TARGET_SQL)
def _(t):
    _register(t)
    return t.spark.sql("SELECT * FROM check_ra_target()")


@check(
    "Q1_sql_view",
    """SELECT f.parquet_country, count(*) AS n FROM day_files f
JOIN pipeline_transcripts t ON t.audio_file_id = f.id
JOIN pipeline_classifications c ON c.audio_file_id = f.id
WHERE c.flagged AND f.status = 'flagged' GROUP BY 1""",
)
def _(t):
    _register(t)
    return t.spark.sql(
        "SELECT parquet_country, count(*) AS n FROM pipeline_flagged_queue GROUP BY parquet_country"
    )
