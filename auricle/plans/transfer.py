"""The transfer cycle on listing tables: which archives to take, and what became of them.

Copying bytes happens elsewhere. Inputs are listings and manifests; outputs are the manifest of
the cycle, the unpack jobs, and plan tables of what may be deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.operators import aggregates, joins
from auricle.sources import jobs as messages
from auricle.sources import objects

LEASE = "60 MINUTES"


@dataclass(frozen=True)
class TransferResult:
    manifest: DataFrame  # one row per archive taken up, with `outcome`
    jobs: DataFrame  # batch_id, value (JSON)
    deletable: DataFrame  # kind, key: sources and their metadata that may be deleted
    totals: DataFrame  # files_copied, files_skipped


def select_sources(listing: DataFrame, as_of: Column, test: bool = False) -> DataFrame:
    """(key, filename, source_size): archives of this cycle; at most 50, or 1 in test mode."""
    ready = objects.ready_archives(listing, as_of, limit=1 if test else 50)
    return ready.select(
        "key", S.base_name("key").alias("filename"), F.col("length").alias("source_size")
    )


def dry_run(listing: DataFrame, as_of: Column) -> DataFrame:
    """What a cycle would transfer, with the size in MB as shown to the operator."""
    return select_sources(listing, as_of).select(
        "filename",
        F.coalesce(
            F.concat(F.format_string("%.1f", S.mib("source_size")), F.lit(" MB")),
            F.lit("unknown size"),
        ).alias("size"),
    )


def transfer(
    sources: DataFrame,
    leases: DataFrame,
    staged: DataFrame,
    uploaded: DataFrame,
    as_of: Column,
    delete_after: bool = False,
    audio: DataFrame | None = None,
) -> TransferResult:
    """Outcome of each source: leased (refused), a size mismatch, or queued.

    `leases` (filename, leased_at) holds the leases in force; `staged` (filename, staged_size,
    local_size) and `uploaded` (filename, uploaded_size) report the copies; `audio`
    (filename, meta_id) lists the audio items of each archive for metadata deletion.
    """
    held = (
        leases.filter(F.col("leased_at") > clock.before(as_of, LEASE))
        .select("filename")
        .distinct()
        .withColumn("leased", F.lit(True))
    )
    manifest = (
        sources.join(held, "filename", "left")
        .join(staged, "filename", "left")
        .join(uploaded, "filename", "left")
    )
    copied = F.col("source_size").isNotNull() & F.col("source_size").eqNullSafe(
        F.col("staged_size")
    )
    stored = F.col("local_size").isNotNull() & F.col("local_size").eqNullSafe(
        F.col("uploaded_size")
    )
    manifest = manifest.withColumns(
        {
            "outcome": F.when(F.col("leased"), "leased")
            .when(~copied, "staging_mismatch")
            .when(~stored, "upload_mismatch")
            .otherwise("queued"),
            "batch_id": S.batch_id(as_of, "filename"),
        }
    ).drop("leased")
    queued = manifest.filter(F.col("outcome") == "queued")
    jobs = queued.select(
        "batch_id",
        messages.unpack_message(
            "batch_id", S.archive_key("batch_id"), "filename", as_of
        ).alias("value"),
    )
    return TransferResult(
        manifest=manifest,
        jobs=jobs,
        deletable=deletable_sources(queued if delete_after else queued.limit(0), audio),
        totals=aggregates.transfer_totals(manifest),
    )


def deletable_sources(verified: DataFrame, audio: DataFrame | None = None) -> DataFrame:
    """Sources with a verified upload, and the metadata files of their audio items."""
    plan = verified.select(F.lit("archive").alias("kind"), "key")
    if audio is None:
        return plan
    items = audio.join(verified.select("filename"), "filename", "left_semi").select(
        F.lit("metadata").alias("kind"),
        F.concat(F.lit("metadata/"), "meta_id", F.lit(".txt")).alias("key"),
    )
    return plan.unionByName(items.distinct())


def verified_sources(manifest: DataFrame) -> DataFrame:
    """Manifest rows whose three sizes agree."""
    return joins.reconcile_sizes(manifest).filter(F.col("size_check") == "verified")


def bundle_metadata(audio: DataFrame, listing: DataFrame) -> DataFrame:
    """Member rows to add per archive: metadata/{id}.txt for each audio item whose metadata
    file is listed."""
    wanted = audio.select(
        "path",
        "meta_id",
        F.concat(F.lit("metadata/"), "meta_id", F.lit(".txt")).alias("member_path"),
    ).distinct()
    files = listing.filter(F.col("key").startswith("metadata/")).select(
        F.col("key").alias("member_path"), F.col("length").alias("size")
    )
    return wanted.join(files, "member_path").select("path", "member_path", "size")


def bundled_members(members: DataFrame, audio: DataFrame, listing: DataFrame) -> DataFrame:
    """The archive's members together with the metadata added to it."""
    added = bundle_metadata(audio, listing)
    return members.select("path", "member_path", "size").unionByName(added)
