"""Micro-batch sinks that a retried epoch overwrites."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auricle.session import rocksdb_state


def write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def write_batches(df: DataFrame, path: str) -> None:
    """Rows of several epochs, told apart by the column `epoch`; those epochs are overwritten."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(path)
    )


def drop(spark: SparkSession, *paths: str) -> None:
    """Removes folders that this library wrote and nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def last_state(spark: SparkSession, path: str, epoch: int) -> DataFrame | None:
    """What the epoch before this one left with `leave_state`; None before the first."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch={epoch - 1}")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.parquet(f"{path}/epoch={epoch - 1}")


def leave_state(df: DataFrame, path: str, epoch: int) -> None:
    """What the next epoch needs to know. The state before the last is removed, the last one stays
    for a retry of this epoch."""
    write_epoch(df, path, epoch)
    drop(df.sparkSession, f"{path}/epoch={epoch - 2}")


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All epochs written so far, with the epoch as a column."""
    return spark.read.schema(f"{schema}, epoch BIGINT").parquet(path)


def newest_per_key(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value of the last epoch that updated each key."""
    return rows.groupBy(*keys).agg(F.max_by(value, "epoch").alias(value))


def run(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    rocksdb: bool = False,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to `each`.

    With `every` it polls at that interval; without, it works off what is there and stops. `rocksdb`
    is for streams that need that state store (`progress.running_progress`, `ordered`), in sessions
    that were not built with it.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with rocksdb_state(stream.sparkSession) if rocksdb else nullcontext():
        return writer.foreachBatch(each).trigger(**trigger).start()


def run_to_end(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    rocksdb: bool = False,
) -> None:
    """Work off all available input; a failure of the query is raised."""
    run(stream, each, checkpoint, mode, rocksdb=rocksdb).awaitTermination()
