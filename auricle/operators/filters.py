"""Row filters and projections over the content tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S


def with_status(files: DataFrame, status: str) -> DataFrame:
    return files.filter(F.col("status") == status)


def flagged_only(classifications: DataFrame) -> DataFrame:
    return classifications.filter("flagged")


def at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Score threshold, inclusive."""
    return df.filter(F.col(column) >= threshold)


def in_batches(files: DataFrame, pattern: str) -> DataFrame:
    """Files whose batch id matches a pattern with % and _; a plain id becomes an equality."""
    if "%" in pattern or "_" in pattern:
        return files.filter(F.col("archive_source").like(pattern))
    return files.filter(F.col("archive_source") == pattern)


def stored(files: DataFrame) -> DataFrame:
    """Files that have an object path."""
    return files.filter(F.col("s3_opus_path").isNotNull())


def with_metadata_key(files: DataFrame, key: str) -> DataFrame:
    return files.filter(S.json_has("parquet_metadata", key))


def in_market(files: DataFrame, country: str, lang: str) -> DataFrame:
    return files.filter((F.col("parquet_country") == country) & (F.col("parquet_lang") == lang))


def split_valid(messages: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by presence of all required fields."""
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    return messages.filter(present), messages.filter(~present)


def counted_validity(
    messages: DataFrame, required: list[str], into: Observation | str
) -> DataFrame:
    """The messages with `valid`, presence of all required fields; accepted and rejected ones are
    counted by the pass that writes them.

    A batch takes an `Observation`, whose `get` has the counts once the rows are written; a stream
    takes a name, under which the progress of each micro-batch has them.
    """
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    return messages.withColumn("valid", present).observe(
        into, F.count_if("valid").alias("accepted"), F.count_if(~F.col("valid")).alias("rejected")
    )


def validity_counts(messages: DataFrame, required: list[str]) -> DataFrame:
    """One row: accepted and rejected messages."""
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    return messages.agg(
        F.count_if(present).alias("accepted"), F.count_if(~present).alias("rejected")
    )


def recent_failures(files: DataFrame, as_of: Column, limit: int = 20) -> DataFrame:
    """Newest failed files of the last 24 hours."""
    return (
        with_status(clock.recent(files, as_of), "failed")
        .select("id", "original_filename", "archive_source", "created_at")
        .orderBy(F.desc_nulls_first("created_at"), "id")
        .limit(limit)
    )


def within_ids(children: DataFrame, files: DataFrame) -> DataFrame:
    """Child rows from the least id of the files on.

    A bound for the scan only: a child table written in order of its file id skips the row groups
    below. The join that follows decides. Windows end at the newest file, so one bound is enough,
    and one alone reaches the scan: Spark merges two subqueries over the same rows into one struct,
    whose fields it does not push down.
    """
    low = files.agg(F.min("id")).scalar()
    return children.filter(F.col("audio_file_id") >= low)
