"""From raw documents to packed training sequences: each stage works on what the one before kept.

Every stage first releases what the one before left in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auricle.llm import decontamination, packing, pii, quality, simhash
from auricle.llm.common import release, stage, table
from auricle.llm.registry import tokenizer_path


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    release(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    release(spark)
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    release(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    release(spark)
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    release(spark)
    return packing.digests(docs, tokenizer_path())


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]
#: No stage but the last has SQL for its rows; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result is written and read again as the next input."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
