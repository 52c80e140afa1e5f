"""Last-per-key, first-valid-per-key and top-k operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by `order`; rows without a key are dropped.

    A max aggregate instead of a window: it combines before the shuffle, so one key holding a
    large share of the rows sends one row per task.
    """
    names = rows.columns
    last = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(F.struct(*names), F.struct(*order)).alias("row"))
    )
    return last.select(*[F.col("row")[n].alias(n) for n in names])


def label_outcomes(ranked: DataFrame) -> DataFrame:
    """Outcome of each ranked candidate when they are taken in order of `rk`.

    Needs (meta_id, rk, valid, exists_already). The first valid candidate of a metadata id is
    synced, later ones are skipped, earlier invalid ones are errors; an id that was there before
    makes all its candidates skipped.
    """
    first_valid = ranked.groupBy("meta_id").agg(
        F.min(F.when(F.col("valid"), F.col("rk"))).alias("first_valid")
    )
    before_first = F.col("first_valid").isNull() | (F.col("rk") < F.col("first_valid"))
    return (
        ranked.join(first_valid, "meta_id")
        .withColumn(
            "outcome",
            F.when(F.col("exists_already"), "skipped")
            .when(before_first, "error")
            .when(F.col("rk") == F.col("first_valid"), "synced")
            .otherwise("skipped"),
        )
        .drop("first_valid")
    )


def top_k(df: DataFrame, column: str, k: int, *tiebreak: str) -> DataFrame:
    """The k largest values; nulls come first, as in the source database."""
    return df.orderBy(F.desc_nulls_first(column), *tiebreak).limit(k)


def first_k(df: DataFrame, k: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(k)
