"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents lie in ascending order of id, each file a range of ids, so the statistics of files, stripes
and row groups let a reader skip what it does not ask for, and its stripes are read side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.llm.common import arrow_rows, lean, release, slices
from auricle.llm.subwords import spaced_encoder

END_ID = 2
#: Encoded text that a task holds at a time, bytes.
SLICE = 16 << 20
#: Documents in an Arrow batch.
BATCH = 5000
#: Rows of the input for one file; files are the unit that the writing tasks share.
DOCS_PER_FILE = 100_000
#: ORC settings. Stripes are what a reader takes as a unit, a row group is what an index entry and
#: a Bloom filter stand for.
STRIPE_BYTES = 16 << 20
ROW_GROUP = 1000
BLOOM_FPP = 0.01

SCHEMA = "doc_id long, file int, begin long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    docs_per_file: int = DOCS_PER_FILE,
) -> None:
    """Encodes every row of docs(doc_id, text, …) and writes ORC files to `path`.

    Columns: doc_id; file, number of the file in ascending order of ids; begin, the ids in the file
    before the document; n_tokens; ids, unsigned 32-bit numbers kept as int, end_id last. A null or
    empty text has the end alone, texts of any length are read whole, null ids come first, rows with
    one id are separate documents in any order (a third of all rows may share an id: a row number
    splits them over files). Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    total = docs.count()
    width = max(1, -(-total // docs_per_file), min(total, spark.sparkContext.defaultParallelism))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = spaced_encoder(tokenizer).encode_all
        end = np.array([end_id], dtype="<u4").tobytes()
        file, begin = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for low, high in slices(sizes, SLICE):
                part = batch.slice(low, high - low)
                raw = [ids + end for ids in encode_all(part.column(1))]
                counts = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                ends = np.append(0, np.cumsum(counts))
                ids = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)),
                    pa.array(np.frombuffer(b"".join(raw), dtype="<i4")),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.full(len(raw), file, dtype=np.int32)),
                        pa.array(begin + ends[:-1]),
                        pa.array(counts),
                        ids,
                    ],
                    names=["doc_id", "file", "begin", "n_tokens", "ids"],
                )
                begin += int(ends[-1])

    ordered = narrow.repartitionByRange(width, "doc_id", "row").sortWithinPartitions(
        "doc_id", "row"
    )
    with arrow_rows(spark, BATCH):
        (
            ordered.select("doc_id", "text")
            .mapInArrow(lean(encode), SCHEMA)
            .write.option("orc.bloom.filter.columns", "doc_id")
            .option("orc.bloom.filter.fpp", str(BLOOM_FPP))
            .option("orc.create.index", "true")
            .option("orc.row.index.stride", str(ROW_GROUP))
            .option("orc.stripe.size", str(STRIPE_BYTES))
            .option("orc.rows.between.memory.checks", str(ROW_GROUP))
            .option("compression", "zstd")
            .orc(path)
        )
    release(spark)


def read_tokens(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in the files, or of those that `wanted`, a
    condition on doc_id, names: ORC skips files, stripes and row groups by it. start: the ids of all
    documents before it in the whole of the files."""
    files = spark.read.schema(SCHEMA).orc(path)
    # one row per file, from columns of small numbers alone
    sizes = files.groupBy("file").agg(F.sum("n_tokens").alias("size")).collect()
    first, total = [], 0
    for r in sorted(sizes, key=lambda r: r["file"]):
        first.append((r["file"], total))
        total += r["size"]
    starts = spark.createDataFrame(first, "file int, first long")
    chosen = files if wanted is None else files.where(wanted)
    return chosen.join(F.broadcast(starts), "file").select(
        "doc_id", (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids"
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the ids of read_tokens as their unsigned crc32, taken
    over little-endian unsigned 32-bit numbers. n_tokens counts the ids that were read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
