"""Listings of objects and files. No file is opened for a listing."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.session import run_dir
from auricle.sources import storage


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All files below a path as (path, modificationTime, length, content), one per row."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


#: Rows of a listing that a task sends on at a time.
LISTED = 10_000
_ENTRY = "path STRING, length BIGINT, changed TIMESTAMP, folder BOOLEAN"


def _entries(folders: DataFrame) -> DataFrame:
    """What lies directly in each folder of folders(path), listed by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = storage.children(path)
                for low in range(0, len(found), LISTED):
                    part = found[low : low + LISTED]
                    inside = [info.type == fs.FileType.Directory for info in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f"{path}/{info.base_name}" for info in part]),
                            pa.array([info.size for info in part], pa.int64()),
                            pa.array([(info.mtime_ns or 0) // 1000 for info in part], pa.int64()).cast(
                                pa.timestamp("us", "UTC")
                            ),
                            pa.array(inside),
                        ],
                        names=["path", "length", "changed", "folder"],
                    )

    return folders.select("path").mapInArrow(run, _ENTRY)


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", glob: str | None = None
) -> DataFrame:
    """(key, length, modification_time) of all objects below root/prefix, keys relative to root.

    Folders are listed level by level: each round deals the folders of one level to tasks and writes
    what they found, and the driver sees how many folders are left. Empty objects and names that
    Spark's readers skip are listed too; a prefix that names no folder gives no rows. `glob` holds
    for the last part of the key.
    """
    return listing(spark, root, prefix, glob)[0]


def listing(
    spark: SparkSession, root: str, prefix: str = "", glob: str | None = None
) -> tuple[DataFrame, list[str]]:
    """As list_objects, with the folders of the shared folder that hold it, to be removed by whoever
    lists time and again."""
    base = root.rstrip("/")
    begin = "/".join([base, *prefix.strip("/").split("/")]) if prefix.strip("/") else base
    width = max(1, spark.sparkContext.defaultParallelism)
    rounds: list[str] = []
    folders = spark.createDataFrame([(begin,)], "path STRING")
    left = 1
    while left:
        rounds.append(run_dir(spark, "listing"))
        # a round of many folders is split over many tasks, whatever the file sizes say
        spread = folders.repartition(min(left, 8 * width))
        _entries(spread).write.parquet(rounds[-1])
        folders = spark.read.schema(_ENTRY).parquet(rounds[-1]).where("folder").select("path")
        left = folders.count()
    files = spark.read.schema(_ENTRY).parquet(*rounds).where("not folder")
    if glob:
        pattern = fnmatch.translate(glob).replace(r"\Z", r"\z")
        files = files.where(F.substring_index("path", "/", -1).rlike(f"^{pattern}"))
    listed = files.select(
        F.substring(F.col("path"), F.lit(len(base) + 2), F.length("path")).alias("key"),
        "length",
        F.col("changed").alias("modification_time"),
    )
    return listed, rounds


def idle_minutes(modified: Column | str, as_of: Column) -> Column:
    """Whole minutes since the last change."""
    changed = F.col(modified) if isinstance(modified, str) else modified
    seconds = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(changed.cast("timestamp"))
    return F.floor(seconds / F.lit(60_000_000))


def ready_archives(
    listing: DataFrame, as_of: Column, older_than: int = 10, limit: int = 50
) -> DataFrame:
    """Archives idle for more than `older_than` whole minutes, lock files left out, by key."""
    return (
        listing.filter(
            (idle_minutes("modification_time", as_of) > older_than)
            & ~F.col("key").endswith(".lock")
        )
        .orderBy("key")
        .limit(limit)
    )


def object_sizes(keys: DataFrame, listing: DataFrame) -> DataFrame:
    """Size per key, null when the object is missing."""
    sizes = listing.select("key", F.col("length").alias("size"))
    return keys.join(sizes, "key", "left")


def text_value(spark: SparkSession, path: str) -> Column:
    """The whole text of one file as a scalar; several files under the path are an error."""
    return spark.read.text(path, wholetext=True).select("value").scalar()
