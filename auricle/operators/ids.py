"""Surrogate ids for bulk loads without funnelling the rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auricle.session import durable

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def assign_ids(
    rows: DataFrame, order: list[str], start: Column | int = 0, partitions: int | None = None
) -> DataFrame:
    """Ids start+1, start+2, … in the order of unique columns.

    Rows are range-partitioned and sorted, and each is tagged with its partition and position.
    The tagged rows are checkpointed, because a recomputed partition could differ. The only
    global step runs over one row per partition.
    """
    width = [partitions] if partitions else []
    tagged = durable(
        rows.repartitionByRange(*width, *order)
        .sortWithinPartitions(*order)
        .withColumn("_tag", F.monotonically_increasing_id())
    )
    part = F.shiftright("_tag", _POSITION_BITS)
    position = F.col("_tag").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    begin = F.lit(start) if isinstance(start, int) else F.coalesce(start, F.lit(0))
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("id", begin + F.col("_offset") + position + 1)
        .drop("_tag", "_part", "_offset")
    )
