"""Benchmark leaks by latent semantic retrieval: randomised SVD of TF-IDF passages, cosine search and
counts of an item's words for candidates, then longest common subsequences and answer checks.

Words are kept as 16-bit hashes. The latent space is fitted on every passage of the corpus, by way of
their random sums, together with the benchmark's own; document frequencies count every document, and
every passage of every document is searched. The benchmark is the stated query set; it is taken in blocks.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auricle.llm.common import lean, release, slices, stage

FEATURES = 1 << 13
RANK, OVERSAMPLE, POWERS = 192, 16, 2
#: Random sums that the space is fitted on, each of about as many passages, and the tasks that read them.
SUMS = 2048
TASKS = 3
#: Bytes of word hashes whose passages one task adds up, the words in a step of it, and the sums of a frame.
SUMMED_BYTES = 64 << 20
SUMMED_AT_ONCE = 1 << 20
SENT_AT_ONCE = 64
#: Passages are two blocks long and start at every block.
BLOCK = 16
QUERY_WORDS = 48
QUERIES_AT_ONCE = 2048
#: A passage is a candidate from this cosine on, times the share of the query's squared length that
#: the latent space keeps: a passage that holds the query cannot be more alike than that share.
COSINE = 0.4
#: Share of an item's words, in order, that proves a leak; with the whole answer, the lower one does.
SAME, SIMILAR = 0.8, 0.6
LEAST_WORDS = 5
_BLANKS = bytes(
    32 if chr(k) in string.punctuation or k < 32 else k for k in range(256)
)
WORDS_AT_ONCE = 1 << 16
#: Passages multiplied at once, each with up to QUERY_WORDS rows of the basis.
PASSAGES_AT_ONCE = 128


def word_ids(text: str | None) -> np.ndarray:
    """16-bit hashes of a text's lower-cased words; ASCII punctuation parts words."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANKS).split()
    return np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words)).astype(np.uint16)


def encoded(docs: DataFrame) -> DataFrame:
    """(doc_id, words binary): the word hashes of every row of docs, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [word_ids(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "words"]
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return stage(narrow.mapInArrow(lean(run), "doc_id long, words binary"), "words")


def _ids(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), dtype="<u2")


def inverse_frequency(words: DataFrame, documents: int) -> np.ndarray:
    """log((1 + N) / (1 + documents with the feature)) + 1 for each feature, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, dtype=np.int64)
        held = np.zeros(FEATURES, dtype=bool)
        for batch in batches:
            for cell in batch.column(0):
                held[_ids(cell) % FEATURES] = True
                total += held
                held[:] = False
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen])], names=["feature", "n"]
        )

    counted = (
        words.select("words")
        .mapInArrow(run, "feature int, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most FEATURES rows
    )
    seen = np.zeros(FEATURES)
    seen[counted["feature"].to_numpy()] = counted["n"].to_numpy()
    return np.log((1 + documents) / (1 + seen)) + 1


def _gram(passages: list[np.ndarray], weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """AᵀA·basis for the TF-IDF rows A of the passages, each of length one."""
    out = np.zeros_like(basis)
    for begin in range(0, len(passages), PASSAGES_AT_ONCE):
        part = passages[begin : begin + PASSAGES_AT_ONCE]
        flat = np.concatenate(part)
        starts = np.cumsum([0, *map(len, part[:-1])])
        value = weight[flat]
        length = np.sqrt(np.add.reduceat(value**2, starts))
        value = value / np.repeat(length, [len(p) for p in part])
        image = np.add.reduceat(basis[flat] * value[:, None], starts, axis=0)
        back = np.repeat(image, [len(p) for p in part], axis=0) * value[:, None]
        order = np.argsort(flat, kind="stable")
        features, first = np.unique(flat[order], return_index=True)
        out[features] += np.add.reduceat(back[order], first, axis=0)
    return out


def _places(doc_id: int | None, cell: pa.Scalar, count: int) -> np.ndarray:
    """64 random bits for each of a document's passages, the same in every run."""
    seed = crc32(cell.as_buffer(), crc32(str(doc_id).encode()))
    mixed = (np.arange(count, dtype=np.uint64) << np.uint64(32)) + np.uint64(seed)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(factor)
    return mixed ^ mixed >> np.uint64(29)


def _add_passages(total: np.ndarray, rows: list[tuple], weight: np.ndarray) -> None:
    """Adds each passage of rows(doc_id, words) to its row of total, or takes it away."""
    size = 2 * BLOCK
    held = [(doc_id, cell, _ids(cell)) for doc_id, cell in rows]
    held = [row for row in held if len(row[2])]
    if not held:
        return
    counts = [-(-len(ids) // size) for _, _, ids in held]
    lengths = np.full(sum(counts), size)
    lengths[np.cumsum(counts) - 1] = [len(ids) - (n - 1) * size for (_, _, ids), n in zip(held, counts)]
    flat = np.concatenate([ids for _, _, ids in held]).astype(np.int64) % FEATURES
    value = weight[flat]
    norm = np.sqrt(np.add.reduceat(value**2, np.cumsum(lengths) - lengths))
    place = np.concatenate([_places(doc_id, cell, n) for (doc_id, cell, _), n in zip(held, counts)])
    signed = np.where(place >> np.uint64(63), -1, 1) / norm
    row = (place % np.uint64(SUMS)).astype(np.int64) * FEATURES
    np.add.at(total, np.repeat(row, lengths) + flat, value * np.repeat(signed, lengths).astype("f4"))


def random_sums(words: DataFrame, weight: np.ndarray, tasks: int) -> DataFrame:
    """(row, sums binary), written: SUMS random sums of the TF-IDF rows A of all passages of words.

    A passage is added to or taken from one sum (Clarkson and Woodruff), so for the sums S the
    expected SᵀS is AᵀA; no passage is left out. A task sends at most SUMS rows.
    """
    weight32 = weight.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SUMS * FEATURES, dtype=np.float32)
        for batch in batches:
            cells = list(zip(batch.column(0).to_pylist(), batch.column(1)))
            sizes = [len(cell.as_buffer()) // 2 for _, cell in cells]
            for begin, end in slices(sizes, SUMMED_AT_ONCE):
                _add_passages(total, cells[begin:end], weight32)
        total = total.reshape(SUMS, FEATURES)
        used = np.flatnonzero(total.any(axis=1))
        for begin in range(0, len(used), SENT_AT_ONCE):
            rows = used[begin : begin + SENT_AT_ONCE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array([total[k].tobytes() for k in rows], pa.binary())],
                names=["row", "sums"],
            )

    def add(parts: pa.Table) -> pa.Table:
        total = np.zeros(FEATURES)
        for cell in parts["sums"]:
            total += np.frombuffer(cell.as_buffer(), dtype="<f4")
        sums = pa.array([total.astype("<f4").tobytes()], pa.binary())
        return pa.table({"row": parts["row"].slice(0, 1), "sums": sums})

    kinds = "row int, sums binary"
    parts = words.select("doc_id", "words").coalesce(tasks).mapInArrow(lean(run), kinds)
    return stage(parts.groupBy("row").applyInArrow(add, kinds), "sums")


@dataclass
class Space:
    """vectors: TF-IDF weight times latent coordinates of each feature; weight: its TF-IDF weight."""

    vectors: np.ndarray
    weight: np.ndarray


def fit(
    sums: DataFrame, passages: int, queries: list[np.ndarray], weight: np.ndarray, seed: int = 5
) -> Space:
    """Randomised SVD of all passages, given as random sums, and the queries, both sides counting alike.

    Each power step adds up AᵀA·Q in tasks; the driver holds FEATURES x rank numbers. Columns are
    ordered by singular value and cut at RANK.
    """
    rank = RANK + OVERSAMPLE
    own = [q.astype(np.int64) % FEATURES for q in queries]
    basis = np.random.default_rng(seed).normal(size=(FEATURES, rank)).astype(np.float32)
    weight32 = weight.astype(np.float32)
    spark = sums.sparkSession

    def product(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(basis)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(sent.value)
            for batch in batches:
                for begin in range(0, batch.num_rows, SENT_AT_ONCE):
                    cells = batch.column(0).slice(begin, SENT_AT_ONCE)
                    part = np.stack([np.frombuffer(cell.as_buffer(), dtype="<f4") for cell in cells])
                    total += part.T @ (part @ sent.value)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

        rows = sums.select("sums").coalesce(TASKS).mapInArrow(run, "s binary").collect()
        sent.destroy()
        total = np.zeros_like(basis)
        for row in rows:
            total += np.frombuffer(row["s"], dtype=basis.dtype).reshape(basis.shape)
        del rows
        release(spark)  # a few copies of these arrays are left in the JVM by every product
        if passages:
            total *= len(own) / passages
        return total + _gram(own, weight32, basis)

    for _ in range(POWERS):
        basis = np.linalg.qr(product(basis))[0].astype(np.float32)
    values, turn = np.linalg.eigh(basis.T @ product(basis))
    latent = basis @ turn[:, np.argsort(-values)[:RANK]].astype(np.float32)
    return Space(latent * weight32[:, None], weight32)


def common_length(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one whole number."""
    masks: dict[int, int] = {}
    for k, word in enumerate(left.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(left)) - 1
    rest = full
    for word in right.tolist():
        met = rest & masks.get(word, 0)
        rest = (rest + met | rest - met) & full
    return len(left) - rest.bit_count()


def answer_of(item: np.ndarray) -> np.ndarray:
    """The last quarter of an item, three words at least: what a paraphrase has to keep."""
    return item[-max(3, -(-len(item) // 4)) :]


def _holds(region: np.ndarray, run: np.ndarray) -> bool:
    return run.tobytes() in _aligned(region, run)


def _aligned(region: np.ndarray, run: np.ndarray) -> set[bytes]:
    size = len(run)
    raw = region.tobytes()
    return {raw[2 * k : 2 * (k + size)] for k in range(len(region) - size + 1)}


class Search:
    """Finds the items of one block of queries in documents."""

    def __init__(self, space: Space, items: list[tuple[int | None, np.ndarray]]):
        self.space, self.items = space, items
        parts = [(k, q) for k, (_, ids) in enumerate(items) for q in split_query(ids)]
        self.of_part = np.array([k for k, _ in parts], dtype=np.int64)
        vectors = np.array([space.vectors[q % FEATURES].sum(axis=0) for _, q in parts])
        length = [np.sqrt((space.weight[q % FEATURES] ** 2).sum()) for _, q in parts]
        scaled = vectors / np.array(length)[:, None]
        self.queries = scaled.astype(np.float32).T.copy()
        self.least = (COSINE * (scaled**2).sum(axis=1)).astype(np.float32)
        self.sizes = np.array([len(ids) for _, ids in items])
        self.answers = [answer_of(ids) for _, ids in items]
        # the items that hold a word, once for each of its places in them
        words = np.concatenate([ids for _, ids in items])
        self.holders = np.repeat(np.arange(len(items)), self.sizes)[np.argsort(words, kind="stable")]
        self.first = np.searchsorted(np.sort(words), np.arange((1 << 16) + 1))

    def shares(self, ids: np.ndarray) -> np.ndarray:
        """The share of each item's words that the document holds, in any order."""
        seen = np.unique(ids).astype(np.int64)
        begin, count = self.first[seen], self.first[seen + 1] - self.first[seen]
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.bincount(self.holders[at], minlength=len(self.items)) / self.sizes

    def present(self, ids: np.ndarray, share: np.ndarray) -> list[int]:
        """Items that the document holds enough words of to be leaked anywhere."""
        return [
            k
            for k in np.flatnonzero(share >= SIMILAR).tolist()
            if share[k] >= SAME or self.answers[k].tobytes() in ids.tobytes()
        ]

    def passages(self, ids: np.ndarray, item: int) -> np.ndarray:
        """Passages whose surroundings hold enough words of the item to leak it."""
        wanted, answer, size = self.items[item][1], self.answers[item], self.sizes[item]
        rows = np.arange(max(1, -(-len(ids) // BLOCK) - 1))
        begin = np.maximum(0, rows * BLOCK - size)
        end = np.minimum(len(ids), (rows + 2) * BLOCK + size)
        own = np.zeros(1 << 16, dtype=bool)
        own[wanted] = True
        share = np.diff(np.append(0, np.cumsum(own[ids]))[np.stack([begin, end])], axis=0)[0] / size
        starts = np.ones(max(0, len(ids) - len(answer) + 1), dtype=bool)
        for k, word in enumerate(answer):
            starts &= ids[k : k + len(starts)] == word
        places = np.flatnonzero(starts)
        kept = np.searchsorted(places, begin) < np.searchsorted(places, end - len(answer), "right")
        return np.flatnonzero((share >= SAME) | kept & (share >= SIMILAR))

    def cosine(self, ids: np.ndarray, item: int, row: int) -> float:
        """The largest cosine of one passage and the item's parts."""
        part = ids[row * BLOCK : (row + 2) * BLOCK].astype(np.int64) % FEATURES
        alike = self.space.vectors[part].sum(axis=0) @ self.queries[:, self.of_part == item]
        return min(1.0, float(alike.max() / np.sqrt((self.space.weight[part] ** 2).sum())))

    def candidates(self, ids: np.ndarray) -> dict[tuple[int, int], float]:
        """(item, passage) -> cosine, for passages whose cosine reaches the threshold."""
        out: dict[tuple[int, int], float] = {}
        for begin in range(0, len(ids), WORDS_AT_ONCE):
            part = ids[begin : begin + WORDS_AT_ONCE + BLOCK].astype(np.int64) % FEATURES
            starts = np.arange(0, len(part), BLOCK)
            full = len(part) // BLOCK * BLOCK
            blocks = self.space.vectors[part[:full]].reshape(-1, BLOCK, RANK).sum(axis=1)
            if full < len(part):
                rest = self.space.vectors[part[full:]].sum(axis=0, keepdims=True)
                blocks = np.concatenate([blocks, rest])
            mass = np.add.reduceat(self.space.weight[part] ** 2, starts)
            if len(blocks) > 1:
                blocks = blocks[:-1] + blocks[1:]
                mass = mass[:-1] + mass[1:]
            alike = blocks @ self.queries
            alike /= np.sqrt(mass)[:, None]
            rows, columns = np.nonzero(alike >= self.least)
            for row, column in zip(rows.tolist(), columns.tolist()):
                key = (int(self.of_part[column]), begin // BLOCK + row)
                cosine = min(1.0, float(alike[row, column]))
                out[key] = max(out.get(key, 0.0), cosine)
        return out

    def leaks(self, ids: np.ndarray) -> list[tuple[int | None, float, float, bool]]:
        """(item_id, cosine, share, answer kept) of each item found in the document.

        A passage of fixed length is not near a short item it holds, nor near one of common words,
        so passages that hold enough of an item's words are candidates at any cosine.
        """
        best: dict[int, tuple[float, float, bool]] = {}
        present = self.shares(ids)
        # a passage has no more of an item's words than its document
        enough = (present >= SIMILAR).tolist()
        found: dict[tuple[int, int], float | None] = {
            key: cosine for key, cosine in self.candidates(ids).items() if enough[key[0]]
        }
        for item in self.present(ids, present):
            for row in self.passages(ids, item).tolist():
                found.setdefault((item, row), None)
        for (item, row), cosine in found.items():
            wanted = self.items[item][1]
            reach = len(wanted)
            region = ids[max(0, row * BLOCK - reach) : (row + 2) * BLOCK + reach]
            # a common subsequence is no longer than the item's words that the region has at all
            held = set(region.tolist())
            if sum(map(held.__contains__, wanted.tolist())) / len(wanted) < SIMILAR:
                continue
            share = common_length(wanted, region) / len(wanted)
            if share < SIMILAR:
                continue
            kept = _holds(region, answer_of(wanted))
            if share >= SAME or kept:
                if cosine is None:
                    cosine = self.cosine(ids, item, row)
                best[item] = max(best.get(item, (0.0, 0.0, False)), (share, cosine, kept))
        return [(self.items[k][0], c, s, a) for k, (s, c, a) in sorted(best.items())]


def split_query(ids: np.ndarray) -> list[np.ndarray]:
    """An item as query passages of even length, QUERY_WORDS at most."""
    return np.array_split(ids, -(-len(ids) // QUERY_WORDS))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer_kept): a row for each benchmark item in a document.

    docs(doc_id, text, …), benchmark(item_id, text, …). An item is leaked where at least SAME of its
    words occur in their order within a passage and an item's length around it, or SIMILAR of them
    with the answer unbroken. Null and blank texts hold nothing; items of under LEAST_WORDS words
    prove nothing and are never reported; equal rows are reported for each of them; a null id stays
    null. Extra columns are ignored. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    words = encoded(docs)
    size = F.octet_length("words")
    total = words.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.ceil(size / F.lit(4 * BLOCK))), F.lit(0)).alias("passages"),
    ).first()
    weight = inverse_frequency(words, total["documents"])
    sums = random_sums(words, weight, 1 + total["bytes"] // SUMMED_BYTES)
    count = benchmark.count()
    blocks = max(1, -(-count // QUERIES_AT_ONCE))
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    schema = "doc_id long, item_id long, cosine double, share double, answer_kept boolean"
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = items.where(F.col("block") == block).orderBy("item_id", "text").collect()
        known = [(r["item_id"], word_ids(r["text"])) for r in rows]
        known = [(k, ids) for k, ids in known if len(ids) >= LEAST_WORDS]
        if not known:
            continue
        queries = [q for _, ids in known for q in split_query(ids)]
        sent = spark.sparkContext.broadcast((fit(sums, total["passages"], queries, weight), known))
        release(spark)

        def run(
            batches: Iterator[pa.RecordBatch], sent=sent
        ) -> Iterator[pa.RecordBatch]:
            search = Search(*sent.value)
            for batch in batches:
                found = [
                    (doc_id, *leak)
                    for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1))
                    for leak in search.leaks(_ids(cell))
                ]
                columns = zip(*found) if found else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "cosine", "share", "answer_kept"],
                )

        out = out.union(words.mapInArrow(lean(run), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a leak; columns unchanged. Rows with a null id cannot be named by a
    leak and stay."""
    found = leaks(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct()
    return docs.join(stage(found, "leaks"), "doc_id", "left_anti").select(docs.columns)
