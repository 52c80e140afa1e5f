"""Score jobs: each audio file is transcribed and classified once, and the tables follow.

The models are caller-supplied functions. Scored rows are written once, partitioned by batch, so
a retry overwrites its own batches; files, transcripts, classifications, status and object key
are derived from that output and scoring never runs twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import scoring
from auricle.operators.ids import assign_ids

SEGMENT_TYPE = "segments ARRAY<STRUCT<text: STRING, avg_logprob: DOUBLE>>, language STRING"
RESPONSE_TYPE = "response STRING"


def score_jobs(
    jobs: DataFrame,
    transcriber,
    classifier,
    template: Column,
    partitions: int | None = None,
) -> DataFrame:
    """One row per job: text, language, confidence, verdict, `success` and `error`.

    Job rows are small and the models slow, so the jobs are spread evenly by their path over
    `partitions` tasks (default: four per core) before anything is scored.

    `transcriber` and `classifier` are (key, load) pairs for `scoring.score_rows`. The
    classifier sees the rendered prompt; blank texts are not sent to it.
    """
    width = partitions or 4 * jobs.sparkSession.sparkContext.defaultParallelism
    spread = jobs.repartition(width, "opus_path")
    heard = scoring.score_rows(spread, transcriber[1], SEGMENT_TYPE, transcriber[0])
    texts = (
        heard.withColumns(
            {
                "text": F.coalesce(scoring.transcript_text("segments"), F.lit("")),
                "language": F.coalesce("language", F.lit(scoring.UNKNOWN_LANGUAGE)),
                "confidence": scoring.transcript_confidence("segments"),
            }
        )
        .withColumnRenamed("error", "hearing_error")
        .drop("segments")
    )
    prompts = texts.withColumn(
        "prompt", F.when(~S.is_blank("text"), S.render_prompt(template, "text"))
    )
    judged = scoring.score_rows(
        prompts, classifier[1], RESPONSE_TYPE, classifier[0], needs="prompt"
    )
    failure = F.coalesce("hearing_error", "error")
    return (
        judged.withColumns({"verdict": S.verdict("response", "text"), "failure": failure})
        .select(
            *jobs.columns,
            "text",
            "language",
            "confidence",
            "verdict.*",
            F.col("failure").isNull().alias("success"),
            F.col("failure").alias("error"),
        )
        .withColumn("status", F.when(F.col("success"), S.status_for("flagged")).otherwise("failed"))
    )


def write_scored(scored: DataFrame, path: str) -> None:
    """Write by batch; a rerun replaces the batches it holds. The rebalance hint lets Spark
    split a large batch over tasks and merge small ones at run time."""
    (
        scored.hint("rebalance", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_scored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Scored rows as written, with the schema of the frame that was written."""
    return spark.read.schema(like.schema).parquet(path)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Store processed audio (date, key, content) under one folder per date."""
    payloads.write.mode("append").partitionBy("date").parquet(path)


@dataclass(frozen=True)
class ResultTables:
    files: DataFrame
    transcripts: DataFrame
    classifications: DataFrame
    progress: DataFrame  # batch_id, processed: every attempted item counts


def result_tables(
    scored: DataFrame,
    sizes: DataFrame | None,
    now: Column,
    first_ids: tuple[Column | int, Column | int, Column | int] = (0, 0, 0),
) -> ResultTables:
    """Rows for the three core tables from written scored rows.

    `sizes` (key, length) gives file sizes by path, 0 when unknown. `first_ids` are the largest
    ids the tables hold.
    """
    good = scored.filter("success")
    if sizes is None:
        sized = good.withColumn("file_size_bytes", F.lit(0).cast("long"))
    else:
        known = sizes.select(F.col("key").alias("opus_path"), "length")
        sized = good.join(known, "opus_path", "left").withColumn(
            "file_size_bytes", F.coalesce("length", F.lit(0))
        )
    # One numbering serves all three tables, since each file has one row in each.
    numbered = assign_ids(sized, ["opus_path"], 0)
    offset = [F.lit(i) if isinstance(i, int) else F.coalesce(i, F.lit(0)) for i in first_ids]
    file_id = F.col("id") + offset[0]
    has_metadata = F.col("parquet_metadata").isNotNull() & (F.col("parquet_metadata") != "{}")
    files = numbered.select(
        file_id.alias("id"),
        "original_filename",
        "opus_path",
        S.processed_key(S.date_text(now), file_id, "original_filename").alias("s3_opus_path"),
        F.col("batch_id").alias("archive_source"),
        F.lit(None).cast("double").alias("duration_seconds"),
        "file_size_bytes",
        now.alias("created_at"),
        now.alias("processed_at"),
        "status",
        F.when(has_metadata, S.json_text("parquet_metadata", "lang")).alias("parquet_lang"),
        F.when(has_metadata, S.json_text("parquet_metadata", "country")).alias("parquet_country"),
        F.when(has_metadata, F.col("parquet_metadata")).alias("parquet_metadata"),
        F.lit(False).alias("synced_to_ra"),
        F.lit(None).cast("timestamp_ntz").alias("synced_at"),
    )
    transcripts = numbered.select(
        (F.col("id") + offset[1]).alias("id"),
        file_id.alias("audio_file_id"),
        F.col("text").alias("transcript_text"),
        "language",
        "confidence",
        now.alias("created_at"),
    )
    classifications = numbered.select(
        (F.col("id") + offset[2]).alias("id"),
        file_id.alias("audio_file_id"),
        "flagged",
        "flag_score",
        "flag_category",
        now.alias("created_at"),
    )
    progress = scored.groupBy("batch_id").agg(F.count("*").alias("processed"))
    return ResultTables(files, transcripts, classifications, progress)
