"""Plan tables of what may be deleted. Nothing is deleted here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.operators import sets
from auricle.sources.objects import idle_minutes


def bucket_clear(listing: DataFrame, confirm: bool = False) -> DataFrame:
    """All objects but the folder markers; without `confirm` the plan is marked a dry run."""
    return sets.without_preserved(listing).select(
        "key", F.lit("delete" if confirm else "dry run").alias("action")
    )


def consumed_archives(stats: DataFrame, archives: DataFrame) -> DataFrame:
    """Archive objects of batches that were unpacked with at least one converted file."""
    done = stats.filter(F.col("converted") > 0).select("batch_id")
    return archives.join(done, "batch_id", "left_semi")


def expired_scratch(listing: DataFrame, as_of: Column, minutes: int = 1440) -> DataFrame:
    """Scratch files idle for more than a day, in whole minutes."""
    return listing.filter(idle_minutes("modification_time", as_of) > minutes).select(
        "key", "length", "modification_time"
    )
