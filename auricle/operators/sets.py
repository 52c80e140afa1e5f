"""Unions and differences of listings and metadata frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Folder markers that a bucket clear leaves in place.
PRESERVED_KEYS = ("archives/", "processed/")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_loose(*frames: DataFrame) -> DataFrame:
    """Union of frames with different columns; missing ones become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_names(required: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """Required names that are absent."""
    return required.select(name).distinct().join(present.select(name), name, "left_anti")


def without_preserved(listing: DataFrame, preserved: tuple[str, ...] = PRESERVED_KEYS) -> DataFrame:
    return listing.filter(~F.col("key").isin(*preserved))
