"""Re-ingest leases: which attempts on a file are accepted.

An accepted attempt holds the file for 60 minutes, unless its outcome released the lease. A
refused attempt does not renew it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auricle.session import staged

LEASE_MICROS = 3600 * 1_000_000
LAST = (1 << 63) - 1


def accepted_attempts(attempts: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Accepted rows of (filename, seq, at, released), in order of (at, seq) per file.

    `held` (filename, free_at) gives leases that are in force at the start, one per file. Rows
    without a file or a time are never accepted; `seq` tells attempts of one moment apart.

    Attempts that release are accepted up to the next one that does not (the holder), which then
    blocks the file for an hour; so each holder has one holder that would follow it. Those reached
    from the first are found by doubling the steps: the rounds grow with the logarithm of the longest
    stretch of hours without a free hour, since the attempt after a gap of 60 minutes is always
    accepted. All windows are over one hour of one file, or over its hours.
    """
    rows = attempts.select(
        "filename", "seq", F.unix_micros(F.col("at").cast("timestamp")).alias("at"), "released"
    ).where("filename is not null and at is not null")
    if held is not None:
        leased = held.select(
            "filename", F.unix_micros(F.col("free_at").cast("timestamp")).alias("start")
        )
        rows = rows.join(leased, "filename", "left").where("start is null or at >= start")
        rows = rows.drop("start")
    hour = F.floor(F.col("at") / LEASE_MICROS)
    rows = staged(rows.withColumn("hour", hour).withColumn("spot", F.struct("at", "seq")))
    hours = staged(_hours(rows))
    placed = staged(_holders(rows, hours))
    entries = hours.where("opens").select("filename", F.col("first").alias("entry"))
    steps = _next_holders(placed, hours)
    chain = _reached(entries, placed, steps, _rounds(hours))
    reached = chain.select("filename", "holder", "entry")
    met = placed.join(reached, ["filename", "holder"]).where("spot >= entry")
    return met.select(
        "filename",
        "seq",
        F.timestamp_micros("at").cast("timestamp_ntz").alias("at"),
        "released",
    )


def _hours(rows: DataFrame) -> DataFrame:
    """One row per file and hour with attempts: its first attempt and holder, those of the hours
    after it, and whether an hour without attempts ends there (`opens`, `stretch`)."""
    holder = F.when(~F.coalesce("released", F.lit(False)), F.col("spot"))
    sums = rows.groupBy("filename", "hour").agg(
        F.min("spot").alias("first"), F.min(holder).alias("own_holder"), F.max("at").alias("until")
    )
    order = Window.partitionBy("filename").orderBy("hour")
    # a frame that grows from its start is kept up row by row, one that shrinks is read again each time
    after = Window.partitionBy("filename").orderBy(F.desc("hour"))
    after = after.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("first.at") - F.lag("until").over(order)
    marked = sums.select(
        "*",
        F.lead("first").over(order).alias("next_first"),
        F.last("own_holder", ignorenulls=True).over(after).alias("next_holder"),
        (gap.isNull() | (gap >= LEASE_MICROS)).alias("opens"),
    )
    return marked.withColumn("stretch", F.sum(F.col("opens").cast("int")).over(order))


def _holders(rows: DataFrame, hours: DataFrame) -> DataFrame:
    """The rows with the first holder at or after each; the end of the file stands for none."""
    back = Window.partitionBy("filename", "hour").orderBy(F.desc("spot"))
    ahead = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(~F.coalesce("released", F.lit(False)), F.col("spot"))
    here = rows.withColumn("holder", F.last(own, ignorenulls=True).over(ahead))
    later = hours.select("filename", "hour", "next_holder")
    end = F.struct(F.lit(LAST).alias("at"), F.lit(LAST).alias("seq"))
    return here.join(later, ["filename", "hour"]).select(
        *rows.columns, F.coalesce("holder", "next_holder", end).alias("holder")
    )


def _next_holders(placed: DataFrame, hours: DataFrame) -> DataFrame:
    """(filename, holder, entry, next): for each holder the first attempt an hour later, and the
    holder that comes of it."""
    asks = placed.where("spot = holder").select(
        "filename",
        (F.col("hour") + 1).alias("hour"),
        F.struct((F.col("at") + LEASE_MICROS).alias("at"), F.lit(-LAST).alias("seq")).alias("spot"),
        F.col("spot").alias("asking"),
        F.lit(None).cast(placed.schema["holder"].dataType).alias("holder"),
    )
    answers = placed.select(
        "filename",
        "hour",
        "spot",
        F.lit(None).cast(placed.schema["spot"].dataType).alias("asking"),
        "holder",
    )
    back = Window.partitionBy("filename", "hour").orderBy(F.desc("spot"))
    ahead = back.rowsBetween(Window.unboundedPreceding, -1)
    found = F.when(F.col("asking").isNull(), F.struct(F.col("spot").alias("entry"), "holder"))
    met = (
        answers.unionByName(asks)
        .withColumn("found", F.last(found, ignorenulls=True).over(ahead))
        .where("asking is not null")
    )
    # nothing left in that hour: the first attempt of the next hour that has any
    firsts = placed.select("filename", F.col("spot").alias("next_first"), F.col("holder").alias("of_first"))
    known = hours.select("filename", F.col("hour").alias("at_hour"), "next_first")
    before = hours.select("filename", "hour")
    order = Window.partitionBy("filename").orderBy("at_hour")
    ranges = known.withColumn("to_hour", F.lead("at_hour").over(order))
    missing = met.where("found is null").select("filename", "hour", "asking")
    same = missing.join(before, ["filename", "hour"], "left_semi").join(
        ranges.select("filename", F.col("at_hour").alias("hour"), "next_first"), ["filename", "hour"]
    )
    # the hour itself has no attempt: the hour before it is the holder's own
    empty = (
        missing.join(before, ["filename", "hour"], "left_anti")
        .withColumn("at_hour", F.col("hour") - 1)
        .join(ranges.select("filename", "at_hour", "next_first"), ["filename", "at_hour"])
    )
    columns = ["filename", "asking", "next_first"]
    rest = same.select(*columns).union(empty.select(*columns)).join(firsts, ["filename", "next_first"])
    return met.where("found is not null").select(
        "filename",
        F.col("asking").alias("holder"),
        F.col("found.entry").alias("entry"),
        F.col("found.holder").alias("next"),
    ).union(
        rest.select("filename", F.col("asking").alias("holder"), F.col("next_first").alias("entry"), F.col("of_first").alias("next"))
    )


def _rounds(hours: DataFrame) -> int:
    """Doublings that cover the longest stretch: a holder is followed an hour later at the least."""
    length = (
        hours.groupBy("filename", "stretch")
        .agg((F.max("hour") - F.min("hour") + 2).alias("n"))
        .agg(F.max("n"))
        .first()[0]
    )
    return math.ceil(math.log2(length)) if length else 0


def _reached(entries: DataFrame, placed: DataFrame, steps: DataFrame, rounds: int) -> DataFrame:
    """(filename, holder, entry): the holders reached from the entries, with the first attempt of
    those that lead to each."""
    starts = entries.join(
        placed.select("filename", F.col("spot").alias("entry"), "holder"), ["filename", "entry"]
    )
    reached = staged(starts.groupBy("filename", "holder").agg(F.min("entry").alias("entry")))
    jumps = staged(steps)
    for step in range(rounds):
        if step:
            further = jumps.select(
                "filename",
                F.col("holder").alias("next"),
                F.col("entry").alias("far_entry"),
                F.col("next").alias("far"),
            )
            jumps = staged(
                jumps.join(further, ["filename", "next"]).select(
                    "filename", "holder", F.col("far_entry").alias("entry"), F.col("far").alias("next")
                )
            )
        more = reached.select("filename", "holder").join(jumps, ["filename", "holder"]).select(
            "filename", F.col("next").alias("holder"), "entry"
        )
        reached = staged(
            reached.unionByName(more)
            .groupBy("filename", "holder")
            .agg(F.min("entry").alias("entry"))
        )
    return reached


def leases_after(accepted: DataFrame) -> DataFrame:
    """(filename, free_at) from accepted attempts: the last one decides, a release frees."""
    last = accepted.groupBy("filename").agg(
        F.max_by(F.struct("at", "released"), F.struct("at", "seq")).alias("a")
    )
    return last.filter(~F.col("a.released")).select(
        "filename", (F.col("a.at") + F.expr("INTERVAL 60 MINUTES")).alias("free_at")
    )
