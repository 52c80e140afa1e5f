"""MinHash fingerprints of whole texts, and of each text edited with the next document's beginning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.llm.common import (
    arrow_rows,
    components,
    release,
    remove,
    shuffle_width,
    slices,
    stage,
    write_staged,
)

SHINGLE = 5
PERMUTATIONS = 128
SEED = 3
AT_ONCE = 512
ROWS_AT_ONCE = 500
#: Bands of so many permutations; texts of similarity 0.8 share one with probability 1 - 5e-8.
ROWS = 4
SIMILAR = 0.8
#: Shingles in one frame.
SHINGLES_AT_ONCE = 1 << 18
#: Buckets up to this size are compared pair by pair.
PAIRED = 64
#: Longs of an odd sketch.
SKETCH = 16
#: Ids of candidate texts that are sent to the tasks at once.
WANTED_AT_ONCE = 1 << 20

_RNG = np.random.default_rng(SEED)
#: Multiply-add-shift hashing: odd factors and offsets of 64 bits, of which the high 32 count.
_FACTOR = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_PLACE = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
NOTHING = np.full(PERMUTATIONS, 0xFFFF, dtype="<u2")


def shingle_hashes(text: str) -> np.ndarray:
    """32-bit hashes of the five-word shingles of a text, repeats included; words are lower-cased
    runs without white space. Fewer words make one shingle, none makes none."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        mixed += ids[k : k + count] * _PLACE[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return mixed >> np.uint64(32)


def signature(text: str) -> np.ndarray:
    """The minimum of each permutation, 16 bits of it; all ones for a text without words."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return NOTHING
    low = None
    for k in range(0, len(hashes), AT_ONCE):
        part = np.multiply.outer(_FACTOR, hashes[k : k + AT_ONCE])
        part += _OFFSET[:, None]
        least = part.min(axis=1)
        low = least if low is None else np.minimum(low, least)
    return (low >> np.uint64(32)).astype("<u2")


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Share of equal minima, an estimate of the Jaccard similarity of the shingle sets."""
    return float((left == right).mean())


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many first ones of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


KINDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_EDGE = ", part int, first_id long, first_text string, last_id long, last_text string"
_TYPES = [
    pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
    pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(),
]
_NAMES = [part.split()[0] for part in (KINDS + _EDGE).split(", ")]


def compared(
    doc_id: int | None, text: str, own: np.ndarray, following: str, next_own: np.ndarray
) -> tuple:
    """One result row, of a document and the one after it."""
    changed = edited(text, following)
    other = signature(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(text),
        digest,
        own.tobytes(),
        other.tobytes(),
        likeness(own, other),
        likeness(own, next_own),
    )


def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * width
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, _TYPES)], names=_NAMES[:width]
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of (doc_id, tie, text) compressed one by one, with their size; a null one is empty."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        cells = [t.as_buffer() or b"" for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array(map(len, cells), pa.int64()),
                pa.array([codec.compress(c, asbytes=True) if len(c) else b"" for c in cells], pa.binary()),
            ],
            names=["doc_id", "tie", "size", "packed"],
        )


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    """(doc_id, text) of a batch of what _packed made."""
    codec = pa.Codec("zstd")
    for doc_id, size, cell in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
        text = codec.decompress(cell.as_buffer(), size, asbytes=True) if size else b""
        yield doc_id, text.decode("utf-8")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of a sorted partition with the next; the partition's two ends come last."""
    first = before = None
    for batch in batches:
        rows = []
        for doc_id, text in _texts(batch):
            own = signature(text)
            if before is None:
                first = (doc_id, text)
            else:
                rows.append((*compared(*before, text, own), *[None] * 5))
            before = (doc_id, text, own)
        yield _batch(rows, len(_NAMES))
    if before is not None:
        part = TaskContext.get().partitionId()
        yield _batch([(*[None] * 7, part, *first, *before[:2])], len(_NAMES))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            compared(doc_id, text, signature(text), following, signature(following))
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns))
        ]
        yield _batch(rows, 7)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for every row of docs(doc_id, text, …), compared with the row after it.

    The order is by descending doc_id, null ids last, equal ids by a hash of the text; the last row
    is followed by the first, a single row by itself. Null texts are empty; the fingerprint of a text
    without words has all bits set. Extra columns are ignored; an empty table gives no rows.

    Texts are compressed, dealt into ranges of ids and sorted there, once. Every task compares neighbours as they
    stream by, and hands on its first and last row; those meet in a join of one row for each task.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
        F.col("text").cast("string").alias("text"),
    )
    order = [F.desc_nulls_last("doc_id"), "tie"]
    packed = narrow.mapInArrow(_packed, "doc_id long, tie long, size long, packed binary")
    ranged = packed.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    with arrow_rows(spark, ROWS_AT_ONCE):
        found = stage(ranged.mapInArrow(_neighbours, KINDS + _EDGE), "fingerprints")
    del packed, ranged
    release(spark)  # the shuffled texts are not needed again
    edges = found.where("part is not null")
    parts = sorted(r["part"] for r in edges.select("part").collect())  # one for each task at most
    follows = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int"
    )
    last = edges.select("part", "last_id", "last_text").join(follows, "part")
    heads = edges.select(F.col("part").alias("next_part"), "first_text")
    pairs = last.join(heads, "next_part").select("last_id", "last_text", "first_text")
    inner = found.where("part is null").select(_NAMES[:7])
    return inner.union(pairs.mapInArrow(_ends, KINDS))


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles, odd): the sorted different shingle hashes of each text, 32 bits each, and
    their odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py() or "")).astype("<u4") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([odd_sketch(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "shingles", "odd"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, shingles binary, odd array<long>"
    )


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """SKETCH longs, a bit of which is set if an odd number of the different hashes falls on it.

    A hash that only one of two sets has flips one bit, so the sketches differ in as many bits at most
    as the sets do in hashes.
    """
    bits = np.bincount(hashes % np.uint32(64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _may_reach(threshold: float) -> Column:
    """Can x and y, as of _sketched, have the similarity? No pair that has it is left out.

    Sets of s shingles together, d of them in one set only, have the similarity (s - d) / (s + d). The
    little that is added keeps pairs at the threshold, however its quotient is rounded.
    """
    apart = reduce(
        Column.__add__,
        (F.bit_count(F.col(f"x.odd{k}").bitwiseXOR(F.col(f"y.odd{k}"))) for k in range(SKETCH)),
    )
    return apart <= (F.col("x.size") + F.col("y.size")) * ((1 - threshold) / (1 + threshold)) + 0.001


def _sketched(members: DataFrame, sets: DataFrame) -> DataFrame:
    """members(node, …) with the size of its set and the longs of its odd sketch."""
    known = sets.select(
        F.col("doc_id").alias("node"),
        F.expr("octet_length(shingles) div 4").alias("size"),
        *(F.col("odd")[k].alias(f"odd{k}") for k in range(SKETCH)),
    )
    return members.join(known, "node")


def jaccard(left: bytes, right: bytes) -> float:
    """Jaccard similarity of two sorted sets of 32-bit hashes; two empty sets are alike."""
    a, b = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """pairs(a, b) whose texts reach the similarity, and the similarity itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [
                jaccard(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(alike, pa.float64())],
                names=["a", "b", "alike"],
            )

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    held = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return held.mapInArrow(run, "a long, b long, alike double").where(F.col("alike") >= threshold)


def _buckets(members: DataFrame) -> DataFrame:
    """members(bucket, node) that are not alone in their bucket, with the bucket's size and least."""
    sizes = (
        members.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("node").alias("least"))
        .where("size > 1")
    )
    return members.join(sizes, "bucket").select("bucket", "node", "size", "least")


def _across(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: nodes of sketched members(bucket, node, root) in one bucket, of different roots,
    whose sketches allow the similarity."""
    x, y = members.alias("x"), members.alias("y")
    return (
        x.join(y, F.col("x.bucket") == F.col("y.bucket"))
        .where((F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")))
        .where(_may_reach(threshold))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    )


def _mixed(members: DataFrame) -> DataFrame:
    """members(bucket, node, root) of buckets with several roots, and the bucket's least node and its root."""
    several = (
        members.groupBy("bucket")
        .agg(
            F.min(F.struct("node", "root")).alias("first"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .where("low <> high")
        .select("bucket", F.col("first.node").alias("least"), F.col("first.root").alias("head"))
    )
    return members.select("bucket", "node", "root").join(several, "bucket")


def _linkable(nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, size, held) of nodes(node) that may reach the similarity with another of them.

    size: the node's shingles; held: those that another node has as well. No text is more alike than
    held / size, so one with many shingles of its own is alike to none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.frombuffer(cell.as_buffer(), "<i4") for cell in batch.column(1)]
            for begin, end in slices(map(len, cells), SHINGLES_AT_ONCE):
                part = cells[begin:end]
                node = np.repeat(batch.column(0)[begin:end].to_numpy(), [len(c) for c in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(np.concatenate(part), pa.int32())],
                    names=["node", "shingle"],
                )

    known = sets.withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi")
    sizes = known.select("node", F.expr("octet_length(shingles) div 4").alias("size"))
    shared = (
        known.select("node", "shingles")
        .mapInArrow(run, "node long, shingle int")
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"))
        .where("n = 1")
        .groupBy("node")
        .agg(F.count("*").alias("own"))
    )
    held = F.col("size") - F.coalesce("own", F.lit(0))
    return (
        sizes.where("size > 0")
        .join(shared, "node", "left")
        .select("node", "size", held.alias("held"))
        .where(F.try_divide(F.col("held"), F.col("size")) >= threshold)
    )


def _crowded_links(
    crowded: DataFrame, sets: DataFrame, threshold: float
) -> tuple[DataFrame, DataFrame, list[str]]:
    """What connects nodes of large buckets, crowded(bucket, node, root): the links found on the way,
    and the pairs (a, b) that are left to compare, with the paths of staged tables.

    Buckets of one root need no look. Nodes that can be alike to no other are dropped, the rest is
    compared with the least node of its bucket, and both again as long as that leaves half of the rows
    at most, so the rounds together are in proportion to the nodes. What is connected by none of it is
    compared where two buckets agree.
    """
    spark = crowded.sparkSession
    paths: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        frame, path = write_staged(df, name)
        paths.append(path)
        return frame

    live = written(_mixed(crowded), "crowded")
    left = live.count()
    none = spark.createDataFrame([], "a long, b long")
    links, able = none, None
    while left:
        before = left
        able = written(_linkable(live.select("node").distinct(), sets, threshold), "able")
        live = written(_mixed(live.join(able.select("node"), "node", "left_semi")), "crowded")
        stars = live.where("root <> head").select(
            F.col("least").alias("a"), F.col("node").alias("b"), "head", "root"
        )
        found = written(_verified(stars.select("a", "b").distinct(), sets, threshold).select("a", "b"), "links")
        links = links.union(found)
        met = found.join(stars, ["a", "b"]).select(F.col("head").alias("a"), F.col("root").alias("b"))
        known = written(components(met).select(F.col("node").alias("old"), F.col("root").alias("new")), "roots")
        moved = live.withColumnRenamed("root", "old").join(known, "old", "left")
        live = written(_mixed(moved.withColumn("root", F.coalesce("new", "old"))), "crowded")
        left = live.count()
        release(spark)
        if 2 * left > before:
            break
    if not left:
        return links, none, paths
    live = _sketched(live.join(able.select("node", "held"), "node"), sets)
    ours = live.withColumn("other_root", F.col("root") != F.col("head")).drop("least", "head")
    # two nodes left here share no small bucket and no bucket of one root
    both = ours.join(live.select("node", F.col("bucket").alias("other")), "node").where("other > bucket")
    second = written(both.withColumn("bucket", F.xxhash64("bucket", "other")).drop("other"), "second")
    x, y = second.where("other_root").alias("x"), second.alias("y")
    most = F.least("x.held", "y.held")
    rest = (
        x.join(y, F.col("x.bucket") == F.col("y.bucket"))
        .where(F.col("x.root") != F.col("y.root"))
        .where(F.try_divide(most, F.col("x.size") + F.col("y.size") - most) >= threshold)
        .where(_may_reach(threshold))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    )
    return links, rest, paths


def _wanted_sets(docs: DataFrame, wanted: DataFrame) -> list[tuple[DataFrame, str]]:
    """The shingle sets of the texts of wanted(doc_id), staged. The ids travel to the texts, in
    blocks of about WANTED_AT_ONCE, so the texts are read where they are and never shuffled."""
    blocks = max(1, -(-wanted.count() // WANTED_AT_ONCE))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return [
        write_staged(
            _sets(narrow.join(F.broadcast(wanted.where(block == k)), "doc_id", "left_semi"))
            .groupBy("doc_id")
            .agg(F.min(F.struct("shingles", "odd")).alias("set"))
            .select("doc_id", "set.*"),
            "sets",
        )
        for k in range(blocks)
    ]


def classes(prints: DataFrame, docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """(fingerprint, class_id) for every fingerprint of prints(doc_id, fingerprint).

    Fingerprints with a band in common are candidates; candidates whose texts have the Jaccard
    similarity are linked, and class_id is the smallest doc_id reachable. Equal fingerprints are one
    node. Each node of a bucket is compared with the least one, which connects those alike in one
    pass; only nodes that are not connected by then are compared further, in buckets of up to PAIRED
    nodes pair by pair, in larger ones as _crowded_links does, so no connection is lost. Pairs whose odd
    sketches rule the similarity out are not compared. Fingerprints whose rows
    all have a null id are left out. Staged tables are deleted once read.
    """
    spark = prints.sparkSession
    nodes = stage(
        prints.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("node")),
        "nodes",
    )
    release(spark)
    width = 2 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(PERMUTATIONS // ROWS - 1)),
        lambda k: F.xxhash64(k, F.substring("fingerprint", k * width + 1, F.lit(width))),
    )
    banded = nodes.select("node", bands.alias("bands"))
    met, met_path = write_staged(
        _buckets(banded.select(F.explode("bands").alias("bucket"), "node")), "buckets"
    )
    release(spark)
    stars, stars_path = write_staged(
        met.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(),
        "stars",
    )
    wanted, wanted_path = write_staged(met.select(F.col("node").alias("doc_id")).distinct(), "wanted")
    with arrow_rows(spark, ROWS_AT_ONCE):
        parts = _wanted_sets(docs, wanted)
        sets = reduce(DataFrame.union, [part for part, _ in parts])
        starred, starred_path = write_staged(_verified(stars, sets, threshold).select("a", "b"), "links")
    remove(spark, [stars_path, wanted_path])
    release(spark)
    # what is connected by now needs no further look
    known, known_path = write_staged(components(starred), "roots")
    members, members_path = write_staged(
        met.join(known, "node", "left").withColumn("root", F.coalesce("root", "node")), "members"
    )
    remove(spark, [met_path, known_path])
    few, many = members.where(F.col("size") <= PAIRED), members.where(F.col("size") > PAIRED)
    with arrow_rows(spark, ROWS_AT_ONCE):
        extra, left, paths = _crowded_links(many, sets, threshold)
    near = _across(_sketched(_mixed(few), sets), threshold)
    rest, rest_path = write_staged(near.union(left).distinct(), "pairs")
    remove(spark, [members_path])
    with arrow_rows(spark, ROWS_AT_ONCE):
        last, last_path = write_staged(_verified(rest, sets, threshold).select("a", "b"), "links")
    remove(spark, [rest_path, *(path for _, path in parts)])
    release(spark)
    roots = components(starred.union(extra).union(last))
    remove(spark, [starred_path, last_path, *paths])
    return nodes.join(roots, "node", "left").select(
        "fingerprint", F.coalesce("root", "node").alias("class_id")
    )


def near_duplicates(docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """The rows of fingerprints(docs) with class_id, the smallest doc_id of texts alike.

    A row with a null id has the class of an equal fingerprint that has an id, else null.
    """
    found = fingerprints(docs)
    grouped = classes(found.select("doc_id", "fingerprint"), docs, threshold)
    return found.join(grouped, "fingerprint", "left").select(*found.columns, "class_id")
