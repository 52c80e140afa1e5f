"""Best-fit packing of token sequences, large items matched first.

A plan depends on nothing but how many pieces there are of each length, at most `capacity` numbers.
So the lengths are counted by Spark, the plan is made from the counts, and every piece finds its
place from its length and its rank among pieces of that length, which Spark computes.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auricle.llm.common import arrow_rows, lean, shuffle_width, slices, stage
from auricle.llm.subwords import encoder

CAPACITY = 1024
END_ID = 2
SLICE = 16 << 20
#: Documents in an Arrow batch.
BATCH = 5000


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row of docs(doc_id, text, …).

    A document is its ids and then end_id; a null text is empty, so it has the end alone. Documents
    longer than capacity are cut into pieces of capacity, the first one taking the rest. ids: the
    piece's ids as little-endian unsigned 32-bit numbers. Repeated ids stay separate documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer).encode_all
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for low, high in slices(sizes, SLICE):
                part = batch.slice(low, high - low)
                keys, numbers, starts, lengths, cut = [], [], [], [], []
                for key, ids in zip(part.column(0).to_pylist(), encode_all(part.column(1))):
                    ids += end
                    total = len(ids) // 4
                    begin, number = 0, 0
                    size = (total - 1) % capacity + 1
                    while begin < total:
                        keys.append(key)
                        numbers.append(number)
                        starts.append(begin)
                        lengths.append(size)
                        cut.append(ids[4 * begin : 4 * (begin + size)])
                        begin, number, size = begin + size, number + 1, capacity
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids binary")


@dataclass
class Plan:
    """Runs of ranks by length: ranks from `low` on go `each` to a bin, from bin `bin` on."""

    capacity: int
    bins: int = 0
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)

    def arrays(self) -> dict[int, np.ndarray]:
        return {k: np.array(v, dtype=np.int64).T for k, v in self.runs.items()}


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs counts[length] pieces of each length below capacity.

    First the pieces above a third of the capacity, two to a bin at most: each, the longest first,
    is matched with the tightest open bin that takes it, or opens one. Then the shorter ones, the
    longest first, fill the tightest gap left. Bins that look alike are handled as one run, so the
    steps depend on the number of lengths, not of pieces.
    """
    plan = Plan(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []

    def put(gap: int, first: int, count: int) -> None:
        if not count:
            return
        if gap not in open_bins:
            open_bins[gap] = []
            insort(gaps, gap)
        open_bins[gap].append((first, count))

    def take(length: int, left: int) -> tuple[int, int, int]:
        """gap, first bin and number of bins of the run with the tightest gap that takes length."""
        at = bisect_left(gaps, length)
        if at == len(gaps):
            fresh = -(-left // (capacity // length))
            plan.bins += fresh
            return capacity, plan.bins - fresh, fresh
        gap = gaps[at]
        first, count = open_bins[gap].pop()
        if not open_bins[gap]:
            del open_bins[gap], gaps[at]
        return gap, first, count

    def fill(length: int) -> None:
        rank, left = 0, counts.get(length, 0)
        runs = plan.runs.setdefault(length, []) if left else []
        while left:
            gap, first, count = take(length, left)
            each = gap // length
            whole = min(count, left // each)
            if whole:
                runs.append((rank, first, each, capacity - gap))
                put(gap - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
                first, count = first + whole, count - whole
            if left and count:
                runs.append((rank, first, left, capacity - gap))
                put(gap - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            put(gap, first, count)

    third = capacity // 3
    for length in range(capacity - 1, third, -1):
        fill(length)
    for length in range(third, 0, -1):
        fill(length)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces(doc_id, piece, length, …) with sequence_id and offset, in place of columns of these
    names.

    Pieces are ranked within their length by (salt, doc_id, piece): a length that holds a large part
    of all rows is spread over as many salts as there are shuffle partitions, whose counts give the
    first rank of each. Pieces of full capacity are sequences of their own. Other columns may have
    any name; null ids are kept, repeated ids are separate. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    width = shuffle_width(spark)
    pieces = pieces.drop("sequence_id", "offset")
    rows = pieces.select(
        F.struct(*(f"`{name}`" for name in pieces.columns)).alias("row"),
        F.col("length").cast("long").alias("size"),
        F.pmod(F.xxhash64("doc_id", "piece"), F.lit(width)).cast("int").alias("salt"),
    )
    short = rows.where(F.col("size") < capacity)
    sizes = short.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity x shuffle partitions rows
    first = sizes.select("size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = sizes.groupBy("size").agg(F.sum("n").alias("n")).collect()  # at most capacity rows
    plan = make_plan({r["size"]: r["n"] for r in totals}, capacity)
    runs = plan.arrays()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.zeros(len(size), dtype=np.int64)
            offset = np.zeros(len(size), dtype=np.int64)
            for value in np.unique(size):
                at = np.flatnonzero(size == value)
                low, bins, each, begin = runs[int(value)]
                run = np.searchsorted(low, rank[at], side="right") - 1
                step = rank[at] - low[run]
                sequence[at] = bins[run] + step // each[run]
                offset[at] = begin[run] + step % each[run] * value
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sequence), pa.array(offset)],
                names=["row", "sequence_id", "offset"],
            )

    within = Window.partitionBy("size", "salt").orderBy("row.doc_id", "row.piece")
    ranked = (
        short.withColumn("place", F.row_number().over(within) - 1)
        .join(first, ["size", "salt"])
        .select("row", "size", (F.col("place") + F.col("base")).alias("rank"))
    )
    kind = rows.schema["row"].dataType.simpleString()
    placed = ranked.mapInArrow(place, f"row {kind}, sequence_id long, offset long")
    full = rows.where(F.col("size") >= capacity).select(
        "row",
        (F.lit(plan.bins) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return placed.union(full).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence, at most capacity, of packed pieces with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.reduce(parts, F.lit(b""), lambda out, part: F.concat(out, part["ids"])).alias("ids")
    )


def digests(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packing with a checksum in place of the ids: (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset), one row per piece of every document."""
    pieces = token_pieces(docs, tokenizer, capacity)
    with arrow_rows(docs.sparkSession, BATCH):
        narrow = stage(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(narrow, capacity)
