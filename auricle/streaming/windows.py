"""Event-time streams: hourly rates and the lease on re-ingested files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from auricle.streaming.ordered import judge
from auricle.streaming.sinks import last_state, leave_state, write_epoch


def hourly_counts(files: DataFrame, delay: str) -> DataFrame:
    """Files per hour of `created_at`, which streaming needs as a zoned timestamp.

    Rows that come more than `delay` late are dropped; the query's progress counts them. Where none
    may be lost, use `hourly_tick`.
    """
    timed = files.select(F.col("created_at").cast("timestamp").alias("at")).withWatermark(
        "at", delay
    )
    counts = timed.groupBy(F.window("at", "1 hour")).agg(F.count("*").alias("processed"))
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("hour"), "processed"
    )


def hourly_tick(out: str, delay: timedelta) -> Callable[[DataFrame, int], None]:
    """Each micro-batch adds its rows (hour, late, processed) to `out`: files per hour of
    `created_at`, those apart that came `delay` or more after their hour had ended.

    The clock is the newest `created_at` of all micro-batches before, one row that is handed from one
    to the next at `out`-seen. Nothing is dropped: rows that are late correct an hour that others may
    have taken for settled. Rows without a time have the hour null and are never late.
    """
    seen_at = f"{out}-seen"

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = last_state(spark, seen_at, epoch)
        seen = None if before is None else before.first()["seen"]
        hour = F.date_trunc("hour", F.col("created_at").cast("timestamp")).cast("timestamp_ntz")
        late = F.lit(False)
        if seen is not None:
            settled = F.lit(seen) - F.make_dt_interval(secs=F.lit(delay.total_seconds()))
            late = F.coalesce(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= settled, F.lit(False))
        counts = (
            batch.select(hour.alias("hour"))
            .withColumn("late", late)
            .groupBy("hour", "late")
            .agg(F.count("*").alias("processed"))
        )
        write_epoch(counts, out, epoch)
        newest = batch.agg(F.max(F.col("created_at").cast("timestamp_ntz")).alias("seen"))
        if seen is not None:
            newest = newest.select(F.greatest("seen", F.lit(seen)).alias("seen"))
        leave_state(newest, seen_at, epoch)

    return each


def hourly_totals(rows: DataFrame) -> DataFrame:
    """(hour, settled, late, processed) from what `hourly_tick` wrote."""
    late = F.col("late")
    return rows.groupBy("hour").agg(
        F.coalesce(F.sum(F.when(~late, F.col("processed"))), F.lit(0)).alias("settled"),
        F.coalesce(F.sum(F.when(late, F.col("processed"))), F.lit(0)).alias("late"),
        F.sum("processed").alias("processed"),
    )


def accepted_attempts(attempts: DataFrame, idle: timedelta | None = None) -> DataFrame:
    """The accepted rows of a stream of attempts (filename, seq, at, released), exactly.

    The state holds the moment a file is free again, one number per file; an outcome that releases
    the lease removes it. With `idle` a file that is quiet for so long in processing time, which must
    exceed a lease, is forgotten, and the query runs until stopped; without, it ends with its input.
    Attempts of one file are taken in order of (at, seq) within a micro-batch; across
    micro-batches the stream has to bring them in order of time.
    """
    kind = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["at", "seq"])
        free_at = state.get[0] if state.exists else None
        keep, free_at = judge(rows["at"].to_numpy(), rows["released"].to_numpy(bool), free_at)
        if free_at is None:
            if state.exists:
                state.remove()
        else:
            state.update((int(free_at),))
            if idle:
                state.setTimeoutDuration(int(idle.total_seconds() * 1000))
        yield rows.iloc[keep]

    narrow = attempts.select(
        "filename",
        "seq",
        F.unix_micros(F.col("at").cast("timestamp")).alias("at"),
        F.coalesce("released", F.lit(False)).alias("released"),
    ).where("filename is not null and at is not null")
    return (
        narrow.groupBy("filename")
        .applyInPandasWithState(
            step,
            "filename STRING, seq BIGINT, at BIGINT, released BOOLEAN",
            "free_at BIGINT",
            "append",
            kind,
        )
        .withColumn("at", F.timestamp_micros("at").cast("timestamp_ntz"))
    )
