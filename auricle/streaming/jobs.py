"""Job streams: dead-letter routing and scoring in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from auricle.sources import jobs as messages
from auricle.streaming.sinks import write_batches, write_epoch


def route_unpack(out: str) -> Callable[[DataFrame, int], None]:
    """Jobs to out/jobs, messages that are not JSON objects to out/dead."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        good, dead = messages.unpack_jobs(batch)
        write_epoch(good, f"{out}/jobs", epoch)
        write_epoch(dead, f"{out}/dead", epoch)
        batch.unpersist()

    return each


def route_transcribe(out: str) -> Callable[[DataFrame, int], None]:
    """Valid jobs to out/jobs, rejected messages with their reason to out/rejected."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        good, rejected = messages.transcribe_jobs(batch)
        write_epoch(good, f"{out}/jobs", epoch)
        write_epoch(rejected, f"{out}/rejected", epoch)
        batch.unpersist()

    return each


def route_transcribe_batches(out: str) -> Callable[[DataFrame, int], None]:
    """As `route_transcribe` for micro-batches of several batches (`batched.job_batches` with
    `together`): the number of the batch takes the place of the epoch."""

    def each(micro: DataFrame, epoch: int) -> None:
        micro = micro.withColumnRenamed("batch", "epoch").persist()
        good, rejected = messages.transcribe_jobs(micro, ("epoch",))
        write_batches(good, f"{out}/jobs")
        write_batches(rejected, f"{out}/rejected")
        micro.unpersist()

    return each


def score_micro_batches(
    score: Callable[[DataFrame], DataFrame], out: str
) -> Callable[[DataFrame, int], None]:
    """Score the valid jobs of each micro-batch and write the rows once.

    The micro-batch size is set on the source (`max_files`) and the pace by the trigger; the
    scoring harness cuts rows into model-sized slices itself.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        good, _rejected = messages.transcribe_jobs(batch)
        write_epoch(score(good), out, epoch)

    return each
