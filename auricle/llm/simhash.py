"""SimHash fingerprints and their links, found by deletion variants of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auricle.llm.common import arrow_rows, components, lean, release, stage

SEED = 42
BITS = 64
#: Buckets up to this size are compared pair by pair; members of larger ones take another exact way.
PAIRED = 64
CHUNK = 1 << 16
#: Documents in an Arrow batch.
BATCH = 2000


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text (UTF-8); 0 for a text without words.

    A bit is set when it is set in over half of the shingles' XXH64; repeats count.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        count = 1
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        count = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, count, CHUNK):
        octets = hashes[k : k + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, bits) for every row of docs(doc_id, text, …); whole texts, null text as empty.

    Words are runs without ASCII white space, A-Z lower-cased. Rows with equal ids stay apart;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            bits = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"]
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.mapInArrow(lean(run), "doc_id long, bits long")


def segment_masks(max_bits: int) -> list[int]:
    """For every bit, the mask of its segment without that bit.

    max_bits // 2 + 1 segments: of two fingerprints with max_bits differences at most, some
    segment differs by at most one bit, so both have the same variant with that bit deleted.
    """
    count = max_bits // 2 + 1
    bounds = [BITS * k // count for k in range(count + 1)]
    return [
        ((1 << high) - (1 << low)) & ~(1 << bit)
        for low, high in zip(bounds, bounds[1:])
        for bit in range(low, high)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _variants(frame: DataFrame, masks: list[int]) -> DataFrame:
    """(slot, part, bits): one row per fingerprint and mask, slot being the mask's number."""
    table = F.expr(f"array({', '.join(f'{_signed(m)}L' for m in masks)})")
    return frame.select("bits", F.posexplode(table).alias("slot", "mask")).select(
        "slot", F.col("bits").bitwiseAND(F.col("mask")).alias("part"), "bits"
    )


def links(distinct_bits: DataFrame, max_bits: int = 2, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that connect all fingerprints with at most max_bits differing bits.

    Input: distinct values `bits`. Buckets of up to `paired` members are joined with themselves and
    verified. Fingerprints of larger buckets are indexed instead by all variants with max_bits bits
    deleted: members of such a bucket (2**max_bits at most) are all linked, so each is linked with
    the smallest one. Two fingerprints that share large buckets only are both indexed that way, so
    no connection is lost, and the work stays linear in the group.
    """
    bucket = Window.partitionBy("slot", "part")
    met = stage(
        _variants(distinct_bits, segment_masks(max_bits))
        .withColumn("members", F.count("*").over(bucket))
        .where("members > 1"),
        "variants",
    )
    few = met.where(F.col("members") <= paired).drop("members")
    left = few.withColumnRenamed("bits", "a")
    right = few.withColumnRenamed("bits", "b")
    close = (
        left.join(right, ["slot", "part"])
        .where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    crowded = met.where(F.col("members") > paired).select("bits").distinct()
    every = (1 << BITS) - 1
    deleted = [
        every & ~sum(1 << bit for bit in bits) for bits in combinations(range(BITS), max_bits)
    ]
    starred = (
        _variants(crowded, deleted)
        .withColumn("a", F.min("bits").over(bucket))
        .select("a", F.col("bits").alias("b"))
        .where("a < b")
    )
    return close.union(starred).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, bits, component_id) for every row of docs(doc_id, text, …).

    component_id is the smallest doc_id reachable over links of at most max_bits differing bits,
    the row's own included. Equal fingerprints are one node, so copies cost one row. A null text
    counts as empty; a row with a null id takes part, its group's smallest id is taken over the
    others (null if there is none). An empty table gives no rows; other columns are ignored.
    """
    with arrow_rows(docs.sparkSession, BATCH):
        marked = stage(fingerprints(docs, shingle), "simhash")
    nodes = marked.groupBy("bits").agg(F.min("doc_id").alias("smallest"))
    roots = components(links(nodes.select("bits"), max_bits))
    release(docs.sparkSession)
    grouped = nodes.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "root", F.coalesce("root", "bits")
    )
    least = grouped.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = grouped.select("bits", "root").join(least, "root").select("bits", "component_id")
    return marked.join(named, "bits").select("doc_id", "bits", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of docs whose id is the smallest of its near-duplicate group; columns unchanged.

    Of several rows with that id the one with the least hash of all its columns stays. Rows with a
    null id cannot be named by a group and stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits)
    heads = found.where("doc_id = component_id").select("doc_id").distinct()
    columns = [f"`{name}`" for name in docs.columns]
    row = F.xxhash64(*columns)
    least = docs.select("doc_id", row.alias("__row")).groupBy("doc_id").agg(
        F.min("__row").alias("__row"), F.count("*").alias("__rows")
    )
    kept = stage(heads.join(least, "doc_id"), "heads")
    # joined the same way at every size: the texts are shuffled once, and no list is broadcast
    joined = docs.withColumn("__row", row).join(kept.hint("merge"), ["doc_id", "__row"])
    # rows that are equal in all columns still stand side by side
    once = joined.where("__rows > 1").dropDuplicates(["doc_id"])
    nameless = docs.where(F.col("doc_id").isNull())
    return (
        joined.where("__rows = 1").select(columns).union(once.select(columns)).union(nameless)
    )
