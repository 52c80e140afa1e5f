"""Leases over a stream whose attempts come out of order: held back until the watermark has passed."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from auricle.operators.leases import LEASE_MICROS

#: Groups that files are dealt to by their names. A stream keeps the number it was started with.
GROUPS = 1024
_ATTEMPT = np.dtype([("file", "<i4"), ("at", "<i8"), ("seq", "<i8"), ("released", "?")])
_SLOT = np.dtype([("end", "<i8"), ("chunks", "<i8")])
_ACCEPTED = "filename STRING, seq BIGINT, at BIGINT, released BOOLEAN"
_FREE = np.iinfo(np.int64).min


class Leases(StatefulProcessor):
    """Attempts of a group of files, held by slots of time and judged slot by slot.

    The map state `held` has the attempts of a slot in chunks, as they came: packed records and the
    names of their files. The value state `slots` tells how many chunks each slot has, the value
    state `free_at` the moments at which leases end. Every slot has one timer at its end, and the
    last lease one at the end of the slot it ends in. A timer judges all slots that the watermark has
    passed and removes them, and leases that have ended by then; so quiet files leave no state.
    A group has one step over the state for each slot, however many files it has.
    """

    def __init__(self, slot_ms: int) -> None:
        self.slot_ms = slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState(
            "held", "until BIGINT, chunk BIGINT", "files ARRAY<STRING>, attempts BINARY"
        )
        self.slots = handle.getValueState("slots", "slots BINARY")
        self.free_at = handle.getValueState("free_at", "files ARRAY<STRING>, at BINARY")

    def _end_of_slot(self, micros):
        """The end, in milliseconds, of the slot that a moment lies in."""
        return (micros // (self.slot_ms * 1000) + 1) * self.slot_ms

    def _chunks(self) -> dict[int, int]:
        found = self.slots.get()
        return dict(np.frombuffer(bytes(found[0]), _SLOT).tolist()) if found else {}

    def _leave_chunks(self, chunks: dict[int, int]) -> None:
        if chunks:
            self.slots.update((np.array(list(chunks.items()), _SLOT).tobytes(),))
        else:
            self.slots.clear()

    def _leases(self) -> dict[str, int]:
        found = self.free_at.get()
        return dict(zip(found[0], np.frombuffer(bytes(found[1]), "<i8").tolist())) if found else {}

    def _leave_leases(self, leases: dict[str, int]) -> None:
        if leases:
            self.free_at.update((list(leases), np.array(list(leases.values()), "<i8").tobytes()))
        else:
            self.free_at.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:  # moves the clock only
            for _ in rows:
                pass
            return
        chunks = self._chunks()
        for frame in rows:
            records = np.empty(len(frame), _ATTEMPT)
            records["file"], files = pd.factorize(frame["filename"])
            for name in ("at", "seq", "released"):
                records[name] = frame[name]
            ends = self._end_of_slot(records["at"])
            order = np.argsort(ends, kind="stable")
            found, begin = np.unique(ends[order], return_index=True)
            for end, spots in zip(found.tolist(), np.split(order, begin[1:])):
                more = records[spots]
                own, more["file"] = np.unique(more["file"], return_inverse=True)
                if end not in chunks:
                    self.handle.registerTimer(end)
                at = chunks.get(end, 0)
                self.held.updateValue((end, at), (files[own].tolist(), more.tobytes()))
                chunks[end] = at + 1
        self._leave_chunks(chunks)
        yield from ()

    def _taken(self, end: int, chunks: int) -> tuple[list[str], np.ndarray]:
        """The files and attempts of a slot, which is removed, by file, time and `seq`."""
        codes: dict[str, int] = {}
        parts = []
        for chunk in range(chunks):
            files, packed = self.held.getValue((end, chunk))
            self.held.removeKey((end, chunk))
            part = np.frombuffer(bytes(packed), _ATTEMPT).copy()
            own = np.array([codes.setdefault(f, len(codes)) for f in files], dtype=np.int32)
            part["file"] = own[part["file"]]
            parts.append(part)
        due = np.concatenate(parts)
        return list(codes), due[np.lexsort((due["seq"], due["at"], due["file"]))]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // self.slot_ms * self.slot_ms
        chunks, leases = self._chunks(), self._leases()
        due, before = sorted(end for end in chunks if end <= now), dict(leases)
        for end in due:
            files, rows = self._taken(end, chunks.pop(end))
            free = np.array([leases.get(f, _FREE) for f in files], dtype=np.int64)
            keep, free = judge_files(rows["file"], rows["at"], rows["released"], free)
            leases.update(zip(files, free.tolist()))
            taken = rows[keep]
            columns = {name: np.ascontiguousarray(taken[name]) for name in ("seq", "at", "released")}
            if len(taken):
                names = np.array(files, dtype=object)[taken["file"]]
                yield pd.DataFrame({"filename": names, **columns})
        if due:
            self._leave_chunks(chunks)
        # every attempt before this moment has been judged
        leases = {f: at for f, at in leases.items() if at > now * 1000}
        if leases != before:
            self._leave_leases(leases)
            last = max(leases.values(), default=_FREE)
            if last > max(before.values(), default=_FREE):
                self.handle.registerTimer(int(self._end_of_slot(last)))

    def close(self) -> None:
        pass


def judge_files(
    files: np.ndarray, at: np.ndarray, released: np.ndarray, free_at: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The positions accepted of attempts in order of file, an index of free_at, and time; and when
    each file is free afterwards.

    `judge` for many files: where a file goes on after each attempt is found for all at once, so a
    file costs a step for each attempt accepted.
    """
    files = files.astype(np.int64)
    moments = np.unique(at)
    width = len(moments) + 1

    def spot_of(of: np.ndarray, micros: np.ndarray) -> np.ndarray:
        """The first attempt of a file at a moment or later, else the first of the next file."""
        return np.searchsorted(place, of * width + np.searchsorted(moments, micros))

    place = files * width + np.searchsorted(moments, at)
    each = np.arange(len(free_at))
    ends = np.searchsorted(files, each, side="right").tolist()
    goes_on = np.where(released, np.arange(1, len(at) + 1), spot_of(files, at + LEASE_MICROS))
    goes_on = memoryview(np.ascontiguousarray(goes_on, dtype=np.int64))
    accepted, holder = bytearray(len(at)), np.full(len(free_at), -1)
    for file, (spot, end) in enumerate(zip(spot_of(each, free_at).tolist(), ends)):
        last = -1
        while spot < end:
            accepted[spot] = 1
            last, spot = spot, goes_on[spot]
        holder[file] = last
    after = np.where(released[holder], _FREE, at[holder] + LEASE_MICROS)
    keep = np.flatnonzero(np.frombuffer(accepted, dtype=np.uint8))
    return keep, np.where(holder >= 0, after, free_at)


def judge(at: np.ndarray, released: np.ndarray, free_at: int | None) -> tuple[np.ndarray, int | None]:
    """The positions accepted of attempts in order, and when the file is free afterwards.

    Steps from one holder to the first attempt after its lease, so refused attempts cost nothing.
    """
    holders = np.flatnonzero(~released)
    keep, spot = [], 0
    while True:
        if free_at is not None:
            spot = max(spot, int(np.searchsorted(at, free_at)))
        if spot >= len(at):
            break
        later = int(np.searchsorted(holders, spot))
        if later == len(holders):
            keep.append(np.arange(spot, len(at)))
            free_at = None
            break
        holder = int(holders[later])
        keep.append(np.arange(spot, holder + 1))
        free_at, spot = int(at[holder]) + LEASE_MICROS, holder + 1
    return (np.concatenate(keep) if keep else np.empty(0, int)), free_at


def accepted_attempts(
    attempts: DataFrame, delay: timedelta, slot: timedelta = timedelta(minutes=1)
) -> DataFrame:
    """The accepted rows of a stream of attempts (filename, seq, at, released) in any order.

    An attempt is judged once the watermark, the newest time seen less `delay`, has passed the slot
    it lies in; so rows that come less than `delay` late are judged as `operators.leases` judges them
    all at once. Later ones are judged the same way while their slot is still held, else refused, and
    the query's progress counts them as dropped by the watermark. The attempts of the last `delay` wait for further input: a row without a filename is
    no attempt and only moves the clock. Rows without a time are left out; `released` null is false.
    Attempts of one file and moment are told apart by `seq`, as in the batch form.

    A lease makes the attempts of one file depend on each other, so a file belongs to one task. Files
    are dealt to GROUPS groups by name, which share their state, and a task holds one slot of a group
    at a time. Needs the RocksDB state store, which `session` sets.
    """
    time = F.col("at").cast("timestamp")
    timed = attempts.select("filename", "seq", time.alias("time"), "released").withWatermark(
        "time", f"{int(delay.total_seconds() * 1000)} milliseconds"
    )
    narrow = timed.select(
        "filename",
        # rows that only move the clock have no file to gather at
        F.when(F.col("filename").isNull(), -1 - F.pmod(F.xxhash64("seq", "time"), F.lit(64)))
        .otherwise(F.pmod(F.xxhash64("filename"), F.lit(GROUPS)))
        .alias("group"),
        "time",
        F.coalesce("seq", F.lit(0).cast("long")).cast("long").alias("seq"),
        F.unix_micros("time").alias("at"),
        F.coalesce("released", F.lit(False)).alias("released"),
    ).where("at is not null")
    slot_ms = max(1, int(slot.total_seconds() * 1000))
    return (
        narrow.groupBy("group")
        .transformWithStateInPandas(Leases(slot_ms), _ACCEPTED, "Append", "EventTime")
        .withColumn("at", F.timestamp_micros("at").cast("timestamp_ntz"))
    )
