"""Moving the best-scoring flagged items into the review tables.

The candidates are cut to the batch limit first, by a top-k over narrow columns. Everything
after that has at most `limit` rows, so the review tables are only ever probed with a small
broadcast side and never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators import aggregates, quality, ranking
from auricle.plans import queues
from auricle.session import durable


@dataclass(frozen=True)
class SyncPlan:
    """What one sync run changes. All frames derive from the checkpointed outcomes."""

    outcomes: DataFrame  # one row per candidate taken: rk, audio_file_id, meta_id, outcome, …
    review_rows: DataFrame  # rows to append to the review table
    creators: DataFrame  # rows to append to the creators table
    file_events: DataFrame  # (id, at): files to mark as synced
    summary: DataFrame  # one row: synced_count, skipped_existing, errors


def _small(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if limit <= queues.BROADCAST_ROWS else df


def _probe(table: DataFrame, keys: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows of a large table whose key is among at most `limit` keys."""
    return table.join(_small(keys.select(key).distinct(), limit), key, "left_semi")


def _valid() -> Column:
    """Does the candidate pass the review table's constraints?"""
    rules = quality.RULES["transcripts"]
    author_limit = quality.RULES["creators"].lengths["author_uniqueid"]
    return (
        F.col("transcript").isNotNull()
        & F.col("created_at").isNotNull()
        & (F.length("meta_id") <= rules.lengths["meta_id"])
        & F.coalesce(F.length("country") <= rules.lengths["country"], F.lit(True))
        & F.coalesce(F.length("lang") <= rules.lengths["lang"], F.lit(True))
        & F.coalesce(F.length("author_uniqueid") <= author_limit, F.lit(True))
        & (F.col("label_1_pred").isNull() | S.as_score("label_1_pred").isNotNull())
    )


def plan_sync(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    review_rows: DataFrame,
    creators: DataFrame,
    as_of: Column,
    threshold: float = 0.7,
    limit: int = 100,
) -> SyncPlan:
    narrow = queues.sync_candidates(
        files, transcripts.select("id", "audio_file_id"), classifications, True, threshold
    )
    top = narrow.orderBy(
        F.desc_nulls_first("label_1_pred"),
        "audio_file_id",
        "transcript_id",
        "classification_id",
    ).limit(limit)
    by_score = Window.orderBy(
        F.desc_nulls_first("label_1_pred"), "audio_file_id", "transcript_id", "classification_id"
    )
    # The window runs over the rows the limit has left.
    ranked = durable(top.withColumn("rk", F.row_number().over(by_score)))
    taken = queues.with_text(ranked, transcripts, limit).withColumnRenamed(
        "transcript_text", "transcript"
    )
    known = _probe(review_rows.select("meta_id"), ranked, "meta_id", limit)
    flags = known.distinct().withColumn("exists_already", F.lit(True))
    checked = (
        taken.join(_small(flags, limit), "meta_id", "left")
        .withColumn("exists_already", F.coalesce("exists_already", F.lit(False)))
        .withColumn("valid", _valid())
    )
    outcomes = durable(ranking.label_outcomes(checked))
    synced = outcomes.filter(F.col("outcome") == "synced")
    new_creators = _new_creators(synced, creators, as_of, limit)
    return SyncPlan(
        outcomes=outcomes,
        review_rows=_review_rows(synced, creators, new_creators, limit),
        creators=new_creators,
        file_events=outcomes.filter(F.col("outcome") != "error")
        .select(F.col("audio_file_id").alias("id"))
        .distinct()
        .withColumn("at", as_of),
        summary=outcomes.agg(
            F.count_if(F.col("outcome") == "synced").alias("synced_count"),
            F.count_if(F.col("outcome") == "skipped").alias("skipped_existing"),
            F.count_if(F.col("outcome") == "error").alias("errors"),
        ),
    )


def _new_creators(
    synced: DataFrame, creators: DataFrame, as_of: Column, limit: int
) -> DataFrame:
    """Authors seen for the first time, numbered after the largest id in order of rank."""
    authors = (
        synced.filter(F.col("author_uniqueid").isNotNull())
        .groupBy("author_uniqueid")
        .agg(F.min("rk").alias("rk"))
    )
    known = _probe(creators.select("author_uniqueid"), authors, "author_uniqueid", limit)
    fresh = authors.join(known, "author_uniqueid", "left_anti")
    start = F.coalesce(creators.agg(F.max("creator_id")).scalar(), F.lit(0))
    return fresh.select(
        (start + F.row_number().over(Window.orderBy("rk"))).alias("creator_id"),
        "author_uniqueid",
        as_of.alias("created_at"),
    )


def _review_rows(
    synced: DataFrame, creators: DataFrame, new_creators: DataFrame, limit: int
) -> DataFrame:
    names = ["creator_id", "author_uniqueid"]
    known = _probe(creators.select(*names), synced, "author_uniqueid", limit)
    # one id for each author, also where the creators table holds an author twice
    ids = (
        known.unionByName(new_creators.select(*names))
        .groupBy("author_uniqueid")
        .agg(F.min("creator_id").alias("creator_id"))
    )
    return synced.join(_small(ids, limit), "author_uniqueid", "left").select(
        "meta_id",
        "year",
        "month",
        "day",
        "transcript",
        "created_at",
        "creator_id",
        S.as_score("label_1_pred").alias("label_1_pred"),
        "country",
        "lang",
        F.lit("unqueued").alias("queue_status"),
        F.lit("unreviewed").alias("review_status"),
    )


def write_sync(plan: SyncPlan, root: str, run: str) -> None:
    """Append the changes of a run. Each run has its own folder, overwritten when retried."""
    for name, frame in (
        ("transcripts", plan.review_rows),
        ("creators", plan.creators),
        ("sync_events", plan.file_events),
        ("sync_runs", plan.summary),
    ):
        frame.write.mode("overwrite").parquet(f"{root}/{name}/run={run}")


def earlier_runs(
    spark: SparkSession, root: str, before: Column | None = None
) -> dict[str, DataFrame] | None:
    """What runs have written below `root` (those for which `before` holds); None if none has."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/sync_runs")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    names = ("transcripts", "creators", "sync_events")
    frames = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    return frames if before is None else {n: f.filter(before) for n, f in frames.items()}


def after_runs(
    files: DataFrame,
    review_rows: DataFrame,
    creators: DataFrame,
    written: dict[str, DataFrame] | None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files left to sync, review ids and creators as they are after the earlier runs."""
    if written is None:
        return files, review_rows, creators
    left = files.join(written["sync_events"].select("id").distinct(), "id", "left_anti")
    keys = review_rows.select("meta_id").unionByName(written["transcripts"].select("meta_id"))
    names = ["creator_id", "author_uniqueid"]
    known = creators.select(*names).unionByName(written["creators"].select(*names))
    return left, keys, known


def dry_run(
    files: DataFrame, transcripts: DataFrame, classifications: DataFrame, threshold: float = 0.7
) -> DataFrame:
    """Counts only: total candidates, those above the threshold, and per country as JSON."""
    narrow = transcripts.select("id", "audio_file_id")
    return aggregates.candidate_summary(
        queues.sync_candidates(files, narrow, classifications), threshold
    )


@dataclass(frozen=True)
class NameSyncPlan:
    """The older sync, which takes the review id from the file name."""

    review_rows: DataFrame
    file_updates: DataFrame  # (id, meta_id, status)
    summary: DataFrame  # synced_count, meta_ids


def plan_sync_by_name(
    files: DataFrame,
    transcripts: DataFrame,
    classifications: DataFrame,
    review_rows: DataFrame,
    limit: int = 100,
) -> NameSyncPlan:
    """Every taken item counts, also when its review row exists. A review id that would be given
    to two files breaks the unique key of the files and fails the whole run."""
    ready = queues.ready_for_sync(
        files,
        transcripts.select("id", "audio_file_id", "language", "confidence"),
        classifications,
        stage=True,
    )
    taken = durable(
        queues.with_text(ready.limit(limit), transcripts, limit)
        .withColumn("meta_id", S.strip_extension("original_filename"))
        .withColumn(
            "rk",
            F.row_number().over(
                Window.orderBy(F.desc_nulls_first("flag_score"), "audio_file_id")
            ),
        )
    )
    holders = taken.select("meta_id", "audio_file_id").distinct()
    holders = holders.unionByName(
        _probe(
            files.select("meta_id", F.col("id").alias("audio_file_id")), taken, "meta_id", limit
        )
    ).distinct()
    clash = holders.groupBy("meta_id").agg(F.count("*").alias("n")).filter("n > 1")
    if not clash.isEmpty():
        raise ValueError("a review id would belong to several files; nothing was written")
    known = _probe(review_rows.select("meta_id"), taken, "meta_id", limit)
    first = taken.groupBy("meta_id").agg(F.min("rk").alias("rk"))
    fresh = taken.join(first, ["meta_id", "rk"], "left_semi").join(known, "meta_id", "left_anti")
    return NameSyncPlan(
        review_rows=fresh.select(
            "meta_id",
            F.year("created_at").alias("year"),
            F.month("created_at").alias("month"),
            F.dayofmonth("created_at").alias("day"),
            F.col("transcript_text").alias("transcript"),
            S.as_score("flag_score").alias("label_1_pred"),
            F.col("language").alias("lang"),
            F.lit("unqueued").alias("queue_status"),
            "audio_file_id",
            "created_at",
        ),
        file_updates=taken.select(
            F.col("audio_file_id").alias("id"), "meta_id", F.lit("synced").alias("status")
        ).distinct(),
        summary=taken.agg(
            F.count("*").alias("synced_count"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("rk", "meta_id"))), lambda x: x["meta_id"]
            ).alias("meta_ids"),
        ),
    )
