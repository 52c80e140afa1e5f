"""Inserts, updates and deletes as DataFrame steps.

Parquet tables are not updated in place. An update is an appended event; the current state is
the newest event per key joined to the base rows. A delete is an anti join whose result is
written to a new path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators.ids import assign_ids

PENDING = "pending"


def new_audio_files(records: DataFrame, files: DataFrame, now: Column) -> DataFrame:
    """Insertable rows with ids after the table's largest, in order of the unique path."""
    rows = records.select(
        "original_filename",
        "opus_path",
        "archive_source",
        F.col("duration_seconds").cast("double").alias("duration_seconds"),
        F.col("file_size_bytes").cast("long").alias("file_size_bytes"),
    )
    start = files.agg(F.max("id")).scalar()
    return assign_ids(rows, ["opus_path"], start).withColumns(
        {
            "created_at": now,
            "status": F.lit(PENDING),
            "synced_to_ra": F.lit(False),
        }
    )


def new_transcripts(scored: DataFrame, table: DataFrame, now: Column) -> DataFrame:
    """(audio_file_id, text, language, confidence) as transcript rows with ids."""
    rows = scored.select(
        "audio_file_id", F.col("text").alias("transcript_text"), "language", "confidence"
    )
    start = table.agg(F.max("id")).scalar()
    return assign_ids(rows, ["audio_file_id"], start).withColumn("created_at", now)


def new_classifications(scored: DataFrame, table: DataFrame, now: Column) -> DataFrame:
    """(audio_file_id, flagged, flag_score, flag_category) as classification rows with ids."""
    rows = scored.select("audio_file_id", "flagged", "flag_score", "flag_category")
    start = table.agg(F.max("id")).scalar()
    return assign_ids(rows, ["audio_file_id"], start).withColumn("created_at", now)


def apply_status(files: DataFrame, events: DataFrame) -> DataFrame:
    """Current status and processed_at from events (id, status, at, seq)."""
    newest = events.groupBy("id").agg(
        F.max_by(F.struct("status", "at"), "seq").alias("change")
    )
    return _overlay(files, newest, {"status": "status", "processed_at": "at"})


def apply_paths(files: DataFrame, events: DataFrame) -> DataFrame:
    """Current object path from events (id, s3_opus_path, seq)."""
    newest = events.groupBy("id").agg(F.max_by(F.struct("s3_opus_path"), "seq").alias("change"))
    return _overlay(files, newest, {"s3_opus_path": "s3_opus_path"})


def apply_metadata(files: DataFrame, events: DataFrame) -> DataFrame:
    """Store metadata JSON (id, metadata, seq): the whole row, with lang and country promoted."""
    newest = events.groupBy("id").agg(
        F.max_by(
            F.struct(
                F.col("metadata").alias("document"),
                S.json_text("metadata", "lang").alias("lang"),
                S.json_text("metadata", "country").alias("country"),
            ),
            "seq",
        ).alias("change")
    )
    return _overlay(
        files,
        newest,
        {
            "parquet_lang": "lang",
            "parquet_country": "country",
            "parquet_metadata": "document",
        },
    )


def apply_sync(files: DataFrame, events: DataFrame) -> DataFrame:
    """Mark files synced from events (id, at); the newest time wins."""
    newest = events.groupBy("id").agg(F.struct(F.max("at").alias("at")).alias("change"))
    merged = files.join(newest, "id", "left")
    hit = F.col("change").isNotNull()
    return merged.withColumns(
        {
            "synced_to_ra": F.when(hit, F.lit(True)).otherwise(F.col("synced_to_ra")),
            "synced_at": F.when(hit, F.col("change.at")).otherwise(F.col("synced_at")),
        }
    ).select(*files.columns)


def matched_updates(events: DataFrame, files: DataFrame) -> DataFrame:
    """Per event id: did a row match?"""
    known = files.select("id", F.lit(True).alias("updated"))
    return (
        events.select("id")
        .distinct()
        .join(known, "id", "left")
        .withColumn("updated", F.coalesce("updated", F.lit(False)))
    )


def _overlay(base: DataFrame, newest: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Replace columns by the fields of `change` where a change exists, also by null."""
    merged = base.join(newest, "id", "left")
    hit = F.col("change").isNotNull()
    replaced = {
        column: F.when(hit, F.col(f"change.{field}")).otherwise(F.col(column))
        for column, field in fields.items()
    }
    return merged.withColumns(replaced).select(*base.columns)


def delete_batch(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame, batch_id: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without a batch: children of its files first, then the files."""
    doomed = files.filter(F.col("archive_source") == batch_id).select(
        F.col("id").alias("audio_file_id")
    )
    kept_files = files.filter(~F.col("archive_source").eqNullSafe(F.lit(batch_id)))
    return (
        kept_files,
        transcripts.join(doomed, "audio_file_id", "left_anti"),
        classifications.join(doomed, "audio_file_id", "left_anti"),
    )


def get_or_create(rows: DataFrame, table: DataFrame, name: str, id_column: str) -> DataFrame:
    """(name, id) for every distinct non-null name: the known id, or the next free one."""
    wanted = rows.select(name).filter(F.col(name).isNotNull()).distinct()
    fresh = wanted.join(table.select(name), name, "left_anti")
    start = table.agg(F.max(id_column)).scalar()
    created = assign_ids(fresh, [name], start).withColumnRenamed("id", id_column)
    known = table.select(name, id_column).join(wanted, name, "left_semi")
    return known.unionByName(created.select(name, id_column))
