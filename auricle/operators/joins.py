"""Joins between content tables, object listings and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auricle.functions import scalars as S


def attach_metadata(conversions: DataFrame, metadata: DataFrame) -> DataFrame:
    """Converted files with the metadata JSON of the same batch and stem; '{}' when missing.

    `metadata` has one row per (batch_id, stem), so the join cannot fan out.
    """
    known = metadata.select("batch_id", "stem", "metadata")
    return conversions.join(known, ["batch_id", "stem"], "left").withColumns(
        {
            "matched": F.coalesce(F.col("metadata") != "{}", F.lit(False)),
            "metadata": F.coalesce("metadata", F.lit("{}")),
        }
    )


def scored_files(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame
) -> DataFrame:
    """files ⋈ transcripts ⋈ classifications, one row per combination."""
    texts = transcripts.select(
        F.col("audio_file_id").alias("text_of"),
        F.col("id").alias("transcript_id"),
        "transcript_text",
        "language",
        "confidence",
    )
    flags = classifications.select(
        F.col("audio_file_id").alias("flag_of"),
        F.col("id").alias("classification_id"),
        "flagged",
        "flag_score",
        "flag_category",
    )
    return (
        files.join(texts, F.col("id") == F.col("text_of"))
        .join(flags, F.col("id") == F.col("flag_of"))
        .drop("text_of", "flag_of")
    )


def review_with_files(review_rows: DataFrame, files: DataFrame) -> DataFrame:
    """Review rows with the media file of the same metadata id, when there is one."""
    media = files.filter(F.col("meta_id").isNotNull()).select(
        "meta_id", F.col("id").alias("audio_file_id"), "opus_path", "duration_seconds"
    )
    return review_rows.join(media, "meta_id", "left")


def existing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key is already in the table."""
    return rows.join(table.select(key), key, "left_semi")


def new_rows(rows: DataFrame, table: DataFrame, key: str, first_by: list[str]) -> DataFrame:
    """Rows to insert when a conflicting key means "do nothing".

    Keys of the table are dropped; of rows sharing a key the first by `first_by` stays. The
    choice is a min aggregate, which combines before the shuffle, so a hot key stays cheap.
    """
    names = rows.columns
    fresh = rows.filter(F.col(key).isNotNull()).join(table.select(key), key, "left_anti")
    first = fresh.groupBy(key).agg(
        F.min_by(F.struct(*names), F.struct(*first_by)).alias("row")
    )
    return first.select(*[F.col("row")[n].alias(n) for n in names])


def expected_objects(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Files with an object path, and whether that object is listed."""
    wanted = files.filter(F.col("s3_opus_path").isNotNull()).select(
        "id", F.col("s3_opus_path").alias("path")
    )
    present = listing.select(F.col("key").alias("path"), F.lit(True).alias("exists"))
    return wanted.join(present, "path", "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )


def object_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count_if("exists").alias("found"), F.count_if(~F.col("exists")).alias("missing")
    )


def reconcile_sizes(manifest: DataFrame) -> DataFrame:
    """Archives with the verdict of both size checks: source = staged and staged = uploaded."""
    staged_ok = F.col("source_size").isNotNull() & F.col("source_size").eqNullSafe(
        F.col("staged_size")
    )
    uploaded_ok = F.col("staged_size").isNotNull() & F.col("staged_size").eqNullSafe(
        F.col("uploaded_size")
    )
    return manifest.withColumn(
        "size_check",
        F.when(~staged_ok, "staging_mismatch")
        .when(~uploaded_ok, "upload_mismatch")
        .otherwise("verified"),
    )


def keys_of_files(listing: DataFrame, files: DataFrame) -> DataFrame:
    """Processed objects of the given files, matched on the key that is stored with a file."""
    stored = files.select(F.col("id").alias("audio_file_id"), F.col("s3_opus_path").alias("key"))
    objects = listing.filter(
        F.col("key").startswith("processed/") & F.col("key").endswith(".opus")
    )
    return objects.join(stored, "key").select("audio_file_id", "key", "length")
