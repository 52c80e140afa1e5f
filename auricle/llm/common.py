"""Helpers shared by the operators: reading, staging, hashing buckets, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written to the shared folder and read back, with its path; cuts the lineage."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str = "llm") -> DataFrame:
    return write_staged(df, name)[0]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows in an Arrow batch for what runs inside: for long texts, the JVM and the
    Python worker each hold whole batches of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lean(run: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """The same function over batches, giving freed memory back to the system when its task ends: a
    Python worker lives on, and stages of other kinds follow."""

    def wrapped(batches: Iterator[Any]) -> Iterator[Any]:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def trim() -> None:
    """Gives freed memory of this Python process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files and broadcasts of frames that nothing refers to any more,
    which it does once the driver has collected its garbage; the driver gives memory back too."""
    trim()
    spark._jvm.System.gc()


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes staged tables that no later step reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """What make() gave the first time a Python worker asked for the key.

    Functions travel to workers by value, their module's globals with them, so what is to outlast a
    task has a module of its own there.
    """
    held = sys.modules.setdefault("auricle_worker", ModuleType("auricle_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose summed size stays near `limit`, so a task holds little at a time."""
    begin, total, end = 0, 0, 0
    for end, size in enumerate(sizes, start=1):
        total += size
        if total >= limit:
            yield begin, end
            begin, total = end, 0
    if end > begin:
        yield begin, end


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node.

    Alternates large-star and small-star rounds. Every round combines minima before the shuffle,
    joins them back (a join that Spark may split by skew) and is written to the shared folder, so
    no component is ever held by one task and a lost executor repeats one round at most.
    Loops and null ends are left out; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    start = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    current, path = write_staged(start, "edges")
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large, large_path = write_staged(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(joined.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after, after_path = write_staged(small, "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        remove(spark, [path, large_path])
        current, path = after, after_path
        if before == tuple(state):
            break
        before = tuple(state)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
