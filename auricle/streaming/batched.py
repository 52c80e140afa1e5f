"""A streaming source of job messages that are handed out by count and by wait.

A micro-batch is closed when it holds `batch_size` valid jobs, when no message came for `first_wait`
seconds, or, once it holds a job, for `next_wait` seconds. Messages are lines of text files in one
folder; a file is complete when it appears and is never changed. Files are taken in the order of
(modified, name) once they are `settle` seconds old, so that a slower clock cannot put a file before
the ones already taken.

Where many jobs wait, a micro-batch may hold several such batches, `together` at most, each with its
number in the column `batch`. Those after the first are full ones; nothing is waited for to fill them.

The driver reads only as many lines as a batch has, to count them; tasks read the messages themselves
by byte range. The ranges are part of the offset, so a batch that is repeated after a failure has
exactly the messages it had, whatever has arrived since.
"""

from __future__ import annotations

import io
import json
import time
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from auricle.sources import storage

FORMAT = "auricle_jobs"
REQUIRED = ("batch_id", "opus_path")
BATCH_SIZE, FIRST_WAIT, NEXT_WAIT, SETTLE = 32, 30.0, 1.0, 2.0
#: Lines of one batch, invalid ones included; the rest comes in the next ones.
MOST_LINES = 10_000
#: Tasks that read one micro-batch of several batches.
READERS = 16
PAUSE = 0.05


def is_job(line: bytes) -> bool:
    """A JSON object that has all required fields, none of them null."""
    try:
        job = json.loads(line)
    except ValueError:
        return False
    return isinstance(job, dict) and all(job.get(name) is not None for name in REQUIRED)


class Lines(InputPartition):
    """Ranges of lines: (file, from byte, to byte, number of the batch)."""

    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        super().__init__(None)
        self.ranges = ranges


class Taken(NamedTuple):
    """What one look into a file gave: where it ended, lines and jobs among them."""

    end: int
    lines: int
    jobs: int


class JobReader(DataSourceStreamReader):
    """Plans micro-batches on the driver, reads their lines in tasks."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.size = int(options.get("batch_size", BATCH_SIZE))
        self.first_wait = float(options.get("first_wait", FIRST_WAIT))
        self.next_wait = float(options.get("next_wait", NEXT_WAIT))
        self.settle = float(options.get("settle", SETTLE))
        self.together = int(options.get("together", 1))
        if self.size < 1 or self.together < 1:
            raise ValueError("batch_size and together must be 1 or more")
        self.current: dict | None = None
        self.listed: list[tuple[int, str]] = []

    def initialOffset(self) -> dict:
        return {"number": 0, "batch": 0, "modified": 0, "file": "", "at": 0, "ranges": "[]"}

    def latestOffset(self) -> dict:
        """The end of the next batch; the last one's end again if nothing came in time."""
        if self.current is None:
            self.current = self.initialOffset()
        self.current = self._next(self.current)
        return self.current

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        if self.current is None:  # a restart: Spark plans the last batch again before it goes on
            self.current = end
        if start == end:
            return []
        if end["number"] != start["number"] + 1:
            raise ValueError(f"batch {end['number']} does not follow batch {start['number']}")
        # ranges that an earlier version left in the checkpoint have no number
        ranges = [(*part, end["number"] - 1)[:4] for part in json.loads(end["ranges"])]
        share = 1 if self.together == 1 else -(-len(ranges) // READERS)
        return [Lines(ranges[low : low + share]) for low in range(0, len(ranges), share)]

    def read(self, partition: Lines) -> Iterator[tuple]:
        for file, begin, end, batch in partition.ranges:
            with storage.open_file(file) as raw:
                raw.seek(begin)
                left = end - begin
                for line in io.BufferedReader(raw):
                    if left <= 0:
                        break
                    left -= len(line)
                    value = line.rstrip(b"\r\n").decode("utf-8", "replace")
                    yield (value,) if self.together == 1 else (value, batch)

    def _next(self, start: dict) -> dict:
        """The end of the micro-batch after this offset; the offset itself if nothing came in time."""
        first = batch = start.get("batch", start["number"])
        place = (start["modified"], start["file"], start["at"])
        ranges: list[list] = []
        for number in range(first, first + self.together):
            taken, after, full = self._close(place, wait=number == first)
            if not taken or (number > first and not full):
                self.listed = []  # files were passed that come again
                break
            place, batch = after, number + 1
            ranges += [[*part, number] for part in taken]
            if not full:
                break
        if not ranges:
            return start
        modified, file, at = place
        return {
            "number": start["number"] + 1,
            "batch": batch,
            "modified": modified,
            "file": file,
            "at": at,
            "ranges": json.dumps(ranges),
        }

    def _close(self, place: tuple[int, str, int], wait: bool) -> tuple[list[list], tuple, bool]:
        """The ranges of one batch, where it ends, and whether it is full."""
        modified, file, at = place
        ranges: list[list] = []
        lines = jobs = 0
        until = time.monotonic() + (self.first_wait if wait else 0)
        while jobs < self.size and lines < MOST_LINES:
            found = self._take(file, at, self.size - jobs, MOST_LINES - lines) if file else None
            if found and found.lines:
                ranges.append([file, at, found.end])
                at, lines, jobs = found.end, lines + found.lines, jobs + found.jobs
                if wait:
                    until = time.monotonic() + (self.next_wait if jobs else self.first_wait)
            elif follower := self._after(modified, file):
                (modified, file), at = follower, 0
            elif time.monotonic() >= until:
                return ranges, (modified, file, at), False
            else:
                time.sleep(PAUSE)
        return ranges, (modified, file, at), True

    def _take(self, file: str, at: int, jobs: int, lines: int) -> Taken:
        """Lines from a byte on, until so many jobs or lines are met or the file ends."""
        met = valid = 0
        with storage.open_file(file) as raw:
            raw.seek(at)
            for line in io.BufferedReader(raw):
                met, valid, at = met + 1, valid + is_job(line), at + len(line)
                if valid == jobs or met == lines:
                    break
        return Taken(at, met, valid)

    def _after(self, modified: int, file: str) -> tuple[int, str] | None:
        """The file after this one; the folder is listed when the last listing is used up."""
        while self.listed and self.listed[-1] <= (modified, file):
            self.listed.pop()
        if not self.listed:
            newest = time.time_ns() - int(self.settle * 1e9)
            prefix = self.path + "/"
            found = (
                (info.mtime_ns or 0, prefix + info.base_name)
                for info in storage.children(self.path)
                if info.is_file and info.size and not info.base_name.startswith((".", "_"))
            )
            self.listed = sorted(
                (f for f in found if (modified, file) < f and f[0] <= newest), reverse=True
            )
        return self.listed[-1] if self.listed else None


class JobSource(DataSource):
    """`spark.readStream.format("auricle_jobs")`: one text column, `value`, and `batch` with the option
    `together`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value STRING" if int(self.options.get("together", 1)) == 1 else "value STRING, batch BIGINT"

    def streamReader(self, schema) -> JobReader:
        return JobReader(self.options)


def job_batches(
    spark: SparkSession,
    path: str,
    batch_size: int = BATCH_SIZE,
    first_wait: float = FIRST_WAIT,
    next_wait: float = NEXT_WAIT,
    settle: float = SETTLE,
    together: int = 1,
) -> DataFrame:
    """Messages of a queue folder in micro-batches of at most `batch_size` valid jobs.

    With `together` above 1 a micro-batch holds up to so many batches that are full already, told apart
    by the column `batch`, which counts them from 0; so a backlog takes fewer micro-batches.

    Invalid messages are handed out beside them, for the router to reject; they do not count. Use a
    short `processingTime` trigger: the waiting is done by the source.
    """
    spark.dataSource.register(JobSource)
    options = {
        "batch_size": batch_size,
        "first_wait": first_wait,
        "next_wait": next_wait,
        "settle": settle,
        "together": together,
    }
    return spark.readStream.format(FORMAT).options(**options).load(path)
