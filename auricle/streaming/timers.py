"""Periodic jobs driven by a stream: the incremental sync and the directory poll.

The stream only sets the pace; each tick reads the current tables or listing. Results are written
per epoch, so a retried tick replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.plans import sync
from auricle.sources import objects
from auricle.streaming.sinks import drop, last_state, leave_state, write_epoch

SYNC_EVERY = "5 minutes"
POLL_EVERY = "60 seconds"


def ticks(spark: SparkSession) -> DataFrame:
    """A stream that has a row at every trigger."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def sync_tick(
    spark: SparkSession,
    tables: Callable[[], tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]],
    as_of: Callable[[], Column],
    root: str,
    threshold: float = 0.7,
    limit: int = 500,
) -> Callable[[DataFrame, int], None]:
    """Each tick syncs up to `limit` candidates that earlier ticks left.

    `tables()` returns files, transcripts, classifications, review rows and creators as loaded
    from storage; what earlier ticks wrote below `root` is laid over them.
    """

    def each(_batch: DataFrame, epoch: int) -> None:
        files, transcripts, classifications, review_rows, creators = tables()
        written = sync.earlier_runs(spark, root, F.col("run").cast("long") < epoch)
        files, review_rows, creators = sync.after_runs(files, review_rows, creators, written)
        plan = sync.plan_sync(
            files,
            transcripts,
            classifications,
            review_rows,
            creators,
            as_of(),
            threshold,
            limit,
        )
        sync.write_sync(plan, root, str(epoch))

    return each


def poll_tick(
    spark: SparkSession, folder: str, out: str, as_of: Callable[[], Column], older_than: int = 10
) -> Callable[[DataFrame, int], None]:
    """Each tick emits the files that became old enough and were not emitted before.

    A tick remembers which of the files that are there it has emitted, with their times, for the next
    one, at `out`-known; so what it reads is bounded by the folder, not by the ticks before. A file
    that is written again is emitted again once it is old enough, and so is one that was away.
    """
    known = f"{out}-known"

    def each(_batch: DataFrame, epoch: int) -> None:
        listing, scratch = objects.listing(spark, folder)
        ready = listing.filter(
            (objects.idle_minutes("modification_time", as_of()) > older_than)
            & ~F.col("key").endswith(".lock")
        )
        before = last_state(spark, known, epoch)
        due = ready
        if before is not None:
            due = ready.join(before, ["key", "modification_time"], "left_anti")
        write_epoch(due.select("key", "length", "modification_time"), out, epoch)
        leave_state(ready.select("key", "modification_time"), known, epoch)
        drop(spark, *scratch)

    return each
