"""Batch progress as streams: running counts, completion events, stuck batches."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# How long state outlives completion, and when a batch counts as stuck.
KEEP_DONE_MS = 60_000
STUCK_MS = 120 * 60_000

_SIGNAL = "batch_id STRING, total BIGINT, processed BIGINT"
_EVENT = "batch_id STRING, event STRING, total BIGINT, processed BIGINT"
_COUNTS = "total BIGINT, processed BIGINT"
_STATE = "total BIGINT, processed BIGINT, first_seen BIGINT, done BOOLEAN, stuck BOOLEAN"


class Progress(StatefulProcessor):
    """Counts of one batch: the value state `open` until it is complete, then `done`, each forgotten
    by its time to live when no more signals come."""

    def __init__(self, keep_ms: int | None, forget_ms: int | None) -> None:
        self.keep_ms, self.forget_ms = keep_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", _COUNTS, self.forget_ms)
        self.done = handle.getValueState("done", _COUNTS, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.done if self.done.exists() else self.open
        total, processed = held.get() if held.exists() else (None, 0)
        for frame in rows:
            processed += int(frame["processed"].sum())
            given = frame["total"].dropna()
            if len(given):
                total = int(given.max())
        complete = total is not None and processed >= total
        if complete:
            self.open.clear()
        (self.done if complete or held is self.done else self.open).update((total, processed))
        yield pd.DataFrame(
            {
                "batch_id": [key[0]],
                "total": pd.array([total], dtype="Int64"),
                "processed": [processed],
                "complete": [complete],
            }
        )

    def close(self) -> None:
        pass


def running_progress(
    signal_stream: DataFrame,
    keep_done: timedelta = timedelta(milliseconds=KEEP_DONE_MS),
    forget: timedelta = timedelta(days=1),
    timers: bool = True,
) -> DataFrame:
    """(batch_id, total, processed, complete) of each batch with signals in a micro-batch, so far.

    Successes and failures both count; a batch without a total is never complete. A complete batch is
    forgotten once no signal has come for `keep_done`, another one after `forget`, in processing time;
    so the state holds the batches under way, not all there ever were. A signal after that begins
    anew. Such a query runs until stopped; without `timers` it can work off its input and end, and
    then forgets nothing. Signals are summed inside each task before the shuffle. Signals without a
    batch are left out.
    """
    ttl = [int(t.total_seconds() * 1000) if timers else None for t in (keep_done, forget)]
    combined = signal_stream.where("batch_id is not null").mapInPandas(_combine, _SIGNAL)
    return combined.groupBy("batch_id").transformWithStateInPandas(
        Progress(*ttl),
        "batch_id STRING, total BIGINT, processed BIGINT, complete BOOLEAN",
        "Append",
        "ProcessingTime" if timers else "None",
    )


def newest_progress(rows: DataFrame) -> DataFrame:
    """The last counts of each batch from rows of `running_progress` with their epoch."""
    names = ["total", "processed", "complete"]
    last = rows.groupBy("batch_id").agg(F.max_by(F.struct(*names), "epoch").alias("last"))
    return last.select("batch_id", "last.*")


def signals(attempts: DataFrame, totals: DataFrame) -> DataFrame:
    """One stream of (batch_id, total, processed) from the totals and the attempted items."""
    done = attempts.select(
        "batch_id", F.lit(None).cast("long").alias("total"), F.lit(1).cast("long").alias("processed")
    )
    known = totals.select("batch_id", F.col("total").cast("long").alias("total")).withColumn(
        "processed", F.lit(0).cast("long")
    )
    return done.unionByName(known)


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        summed = pdf.groupby("batch_id", as_index=False).agg(
            total=("total", "max"), processed=("processed", "sum")
        )
        summed["total"] = summed["total"].astype("Int64")
        yield summed[["batch_id", "total", "processed"]]


def _step(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, timers: bool
) -> Iterator[pd.DataFrame]:
    now = state.getCurrentProcessingTimeMs() if timers else 0
    total, processed, first_seen, done, stuck = (
        state.get if state.exists else (None, 0, now, False, False)
    )
    if state.hasTimedOut:
        if done:
            state.remove()
            return
        stuck, event = True, "stuck"
    else:
        event = None
        for pdf in frames:
            processed += int(pdf["processed"].sum())
            given = pdf["total"].dropna()
            if len(given):
                total = int(given.max())
        if not done and total is not None and processed >= total:
            done, event = True, "complete"
    state.update((total, processed, first_seen, done, stuck))
    if timers and done:
        state.setTimeoutDuration(KEEP_DONE_MS)
    elif timers and not stuck:
        state.setTimeoutDuration(max(1, first_seen + STUCK_MS - now))
    if event:
        yield pd.DataFrame(
            {
                "batch_id": [key[0]],
                "event": [event],
                "total": pd.array([total], dtype="Int64"),
                "processed": [processed],
            }
        )


def batch_events(signal_stream: DataFrame, timers: bool = True) -> DataFrame:
    """One "complete" event per batch when processed reaches the total, and one "stuck" event
    when a batch stays incomplete for two hours.

    Signals are summed inside each task before the shuffle, so a batch that holds a large share
    of the items sends a few rows per task. State is kept for another minute after completion.
    A query with timers runs until it is stopped; without them it can work off its input and end,
    and then gives completion events only.
    """

    def step(key, frames, state):
        return _step(key, frames, state, timers)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if timers else GroupStateTimeout.NoTimeout
    combined = signal_stream.mapInPandas(_combine, _SIGNAL)
    return combined.groupBy("batch_id").applyInPandasWithState(
        step, _EVENT, _STATE, "append", timeout
    )
