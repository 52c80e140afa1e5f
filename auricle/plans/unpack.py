"""Unpack jobs: archives and their metadata become transcribe jobs, counters and dead letters.

Audio conversion happens elsewhere; its results come in as rows (batch_id, member_path,
file_size_bytes, success). Audio content never leaves the extraction stage, so every shuffle
here moves names and metadata only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import aggregates, joins, ranking
from auricle.session import durable, staged
from auricle.sources import archives as tar
from auricle.sources import jobs as messages
from auricle.sources import metadata as meta

METADATA_SUFFIXES = {"txt": [".txt"], "parquet": [".parquet"]}


@dataclass(frozen=True)
class UnpackResult:
    transcribe_jobs: DataFrame  # batch_id, opus_path, original_filename, matched, value (JSON)
    totals: DataFrame  # batch_id, total, processed, s3_key
    stats: DataFrame  # per batch: mp3_found, converted, failed, queued, metadata_*
    dead_letters: DataFrame  # value (JSON)
    consumed: DataFrame  # batch_id, s3_key of archives that may be deleted


def batch_members(archives: DataFrame, metadata_format: str = "txt") -> DataFrame:
    """Members with the batch id, which is the stem of the archive's key."""
    members = tar.read_members(archives, METADATA_SUFFIXES[metadata_format])
    return members.withColumn("batch_id", S.path_stem("path"))


def batch_metadata(members: DataFrame, metadata_format: str = "txt") -> DataFrame:
    """(batch_id, stem, metadata), one row per key; of repeated keys the last one stays."""
    files = members.filter(F.col("content").isNotNull())
    if metadata_format == "parquet":
        names = files.select(F.col("batch_id").alias("path"), "member_path", "content").filter(
            F.col("member_path").endswith(".parquet")
        )
        rows = meta.parse_parquet_members(names).select(
            F.col("path").alias("batch_id"),
            F.col("meta_id").alias("stem"),
            "metadata",
            F.struct("member_path", "position").alias("at"),
        )
    else:
        named = files.select(
            "batch_id", F.col("member_path").alias("name"), "content", "has_metadata_dir"
        )
        rows = meta.parse_txt_files(meta.pick_txt(named)).select(
            "batch_id", "stem", "metadata", F.struct("name").alias("at")
        )
    keyed = rows.withColumn("key", F.struct("batch_id", "stem"))
    return ranking.last_per_key(keyed, "key", ["at"]).select("batch_id", "stem", "metadata")


def unpack(
    jobs: DataFrame,
    members: DataFrame,
    conversions: DataFrame,
    as_of: Column,
    metadata_format: str = "txt",
    scratch: str = "/data/scratch",
) -> UnpackResult:
    """`jobs` are parsed unpack jobs with their text in `value`; `members` come from
    `batch_members` and are read several times, so pass a written or checkpointed frame."""
    broken = members.filter(F.col("error").isNotNull()).select(
        "batch_id", F.col("error").alias("unpack_error")
    )
    present = members.select("batch_id").distinct().withColumn("present", F.lit(True))
    audio = tar.audio_members(members).select(
        "batch_id",
        "member_path",
        S.path_stem("member_path").alias("stem"),
        S.base_name("member_path").alias("original_filename"),
    )
    done = conversions.select("batch_id", "member_path", "file_size_bytes", "success")
    results = (
        audio.join(done, ["batch_id", "member_path"], "left")
        .withColumn("success", F.coalesce("success", F.lit(False)))
        .withColumn(
            "opus_path",
            F.concat(F.lit(f"{scratch}/"), "batch_id", F.lit("/"), "stem", F.lit(".opus")),
        )
    )
    # Several outputs read the metadata, the audio that met it and the batch counts, so all are kept.
    metadata = durable(batch_metadata(members, metadata_format))
    met = staged(joins.attach_metadata(results, metadata))
    stats = durable(aggregates.attached_stats(met, metadata))
    state = (
        jobs.select("batch_id", "s3_key", "value")
        .join(present, "batch_id", "left")
        .join(broken, "batch_id", "left")
        .join(stats, "batch_id", "left")
    )
    failure = (
        F.when(F.col("present").isNull(), F.concat(F.lit("archive not found: "), "s3_key"))
        .when(
            F.col("unpack_error").isNotNull(),
            F.concat(F.lit("Failed to extract archive for batch "), "batch_id"),
        )
        .when((F.col("mp3_found") > 0) & (F.col("converted") == 0), F.concat(F.lit("No files converted for batch "), "batch_id"))
    )
    state = state.withColumn("failure", failure)
    good = state.filter(F.col("failure").isNull())
    counted = good.filter(F.col("converted") > 0)
    attached = met.filter("success").join(counted.select("batch_id"), "batch_id", "left_semi")
    numbers = [c for c in stats.columns if c != "batch_id"]
    return UnpackResult(
        transcribe_jobs=attached.select(
            "batch_id",
            "opus_path",
            "original_filename",
            "matched",
            messages.transcribe_message(
                "batch_id", "opus_path", "original_filename", "metadata"
            ).alias("value"),
        ),
        totals=counted.select(
            "batch_id",
            F.col("converted").alias("total"),
            F.lit(0).cast("long").alias("processed"),
            "s3_key",
        ),
        stats=good.select("batch_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers]),
        dead_letters=state.filter(F.col("failure").isNotNull()).select(
            messages.dead_letter("value", F.col("failure"), as_of).alias("value")
        ),
        consumed=counted.select("batch_id", "s3_key"),
    )
