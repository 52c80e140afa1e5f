"""Language-model scores: corpus word counts, and a causal self-attention model of subword ids.

Counts of words, ids and contexts cover every training document. The attention weights start from a bounded
sample and then learn from every window of every training document once, by rounds of local steps in several
tasks whose weights are averaged.
"""

from __future__ import annotations

import base64
import pickle
import struct
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auricle.llm import attention
from auricle.llm.common import fold, per_worker, slices, stage

FOLDS = 7
HELD_OUT = 2
#: Words whose counts every task gets; the counts of all others are joined.
HEAD_WORDS = 200_000
CACHE = 300_000
FLUSH = 300_000
#: The sample that the attention weights start from, and its bound for texts of any length.
SAMPLE_DOCS = 1500
WINDOWS_PER_TASK = 30_000
TASKS = 6
ROUNDS, STEPS = 3, 700
#: The rate of the pass over all documents, before it falls from round to round.
PASS_RATE = 4e-3
SLICE = 1 << 21
END = b""  # no word is empty, so this stands for the end of a text


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, parted by ASCII white space."""
    return (text or b"").lower().split()


class Subwords:
    """Ids of words by a public byte-level BPE, each word encoded with a blank before it."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.end = len(ranks)
        self.size = len(ranks) + 1

    def ids(self, word: bytes) -> bytes:
        if word == END:
            found = [self.end]
        else:
            found = self._encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))
        return struct.pack(f"<{len(found)}H", *found)


def subwords(ranks_path: str, pattern: str) -> Subwords:
    """One encoder per Python worker and file."""
    return per_worker(("subwords", ranks_path), lambda: Subwords(ranks_path, pattern))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n): how often each word, and the end of a text, occurs in docs(text, …).

    Every task sums before the shuffle and holds at most FLUSH different words and one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return out

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.update(words_of(text.as_py()))
                held[END] += 1
                if len(held) > FLUSH:
                    yield flush()
        yield flush()

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(counts: DataFrame, ranks_path: str, pattern: str) -> np.ndarray:
    """Occurrences of each subword id over all counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(ranks_path, pattern)
        total = np.zeros(encode.size, dtype=np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k in np.frombuffer(encode.ids(word), dtype="<u2").tolist():
                    total[k] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen])], names=["id", "n"]
        )

    rows = (
        counts.select("word", "n")
        .mapInArrow(run, "id int, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most one row per id of the vocabulary
    )
    out = np.zeros(subwords(ranks_path, pattern).size)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


def head_limit(counts: DataFrame, most: int = HEAD_WORDS) -> int:
    """The least count such that at most `most` words occur as often; from a histogram of counts."""
    bins = (
        counts.groupBy(F.floor(8 * F.log2("n")).alias("b"))
        .agg(F.count("*").alias("words"), F.min("n").alias("least"))
        .orderBy(F.desc("b"))
        .collect()  # a few hundred rows
    )
    total, limit = 0, None
    for row in bins:
        total += row["words"]
        if total > most:
            break
        limit = row["least"]
    return limit if limit is not None else (bins[0]["least"] * 2 if bins else 1)


def _encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(ids binary): the subword ids of each of docs(text, …) with the end, two bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(ranks_path, pattern).ids
        cache: dict[bytes, bytes] = per_worker(("ids", ranks_path), dict)

        def ids(text: bytes | None) -> bytes:
            found = []
            for word in [*words_of(text), END]:
                known = cache.get(word)
                if known is None:
                    known = encode(word)
                    if len(cache) < CACHE:  # the words that come first are the frequent ones
                        cache[word] = known
                found.append(known)
            return b"".join(found)

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
            for low, high in slices(sizes, SLICE):
                rows = [ids(t.as_py()) for t in texts[low:high]]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "ids binary")


def _context_counts(encoded: DataFrame, rows_of: np.ndarray) -> np.ndarray:
    """How often each input row follows each of the first CONTEXTS rows, over all of encoded(ids).

    Every task sums its own table, which has a fixed size, and sends the cells that occur.
    """
    size = attention.FIRST + attention.FREQUENT + attention.SHARED
    width = attention.CONTEXTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * width, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                row = rows_of[np.frombuffer(ids.as_buffer(), dtype="<u2")]
                before = np.minimum(np.concatenate([[attention.BEGIN], row[:-1]]), width - 1)
                np.add.at(total, row * width + before, 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen])], names=["cell", "n"]
        )

    counted = (
        encoded.mapInArrow(run, "cell int, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most one row per cell of the table
    )
    total = np.zeros(size * width)
    total[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return total.reshape(size, width)


#: What a task has learned: its weights, and how often they count.
PART = "w binary, n long"


def _windows(ids: pa.BinaryScalar, vocab: attention.Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Windows of one text and the classes of their targets, -1 for none."""
    own, goal, _ = attention.layout([np.frombuffer(ids.as_buffer(), dtype="<u2")], vocab)
    return own, np.where(goal >= 0, vocab.kind[np.maximum(goal, 0)], -1)


def _averaged(parts: DataFrame, tasks: int) -> attention.Weights | None:
    """The mean of the weights that so many tasks give as PART; None without any.

    Added up in fewer tasks first, so the driver gets few of them however many tasks there were.
    """

    def read(rows: Iterator[tuple[bytes, int]]) -> Iterator[tuple[list[np.ndarray], int]]:
        return ((pickle.loads(w), n) for w, n in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["w"], r["n"]) for batch in batches for r in batch.to_pylist())
        first = next(rows, None)
        if first is not None:
            arrays, n = attention.averaged(read(chain([first], rows)))
            yield _weights(arrays, n)

    few = parts.repartition(max(1, round(tasks**0.5))).mapInArrow(run, PART).collect()
    if not few:
        return None
    arrays, _ = attention.averaged(read((r["w"], r["n"]) for r in few))
    return attention.Weights(*[a.astype(np.float32) for a in arrays])


def _weights(arrays: list[np.ndarray], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([pickle.dumps(arrays)], pa.binary()), pa.array([n], pa.int64())], names=["w", "n"]
    )


def fit(docs: DataFrame, counts: DataFrame, ranks_path: str, pattern: str) -> attention.Scorer:
    """The model for docs(text, …), all of them training documents, and their word counts.

    Tasks first learn from a sample, so that they start alike, then from every window of every
    document once, a share of the documents in each round.
    """
    spark = docs.sparkSession
    encoded = stage(_encoded(docs, ranks_path, pattern), "ids")
    limit = int((1 << 40) * min(1.0, SAMPLE_DOCS / max(1, encoded.count())))
    drawn = encoded.where(F.pmod(F.xxhash64("ids"), F.lit(1 << 40)) < limit)
    sample = stage(drawn.dropDuplicates(["ids"]), "sample")
    by_id = id_counts(counts, ranks_path, pattern)
    rows_of = attention.input_rows(by_id)
    vocab = attention.vocabulary(by_id, _context_counts(encoded, rows_of))
    weights = attention.initial(vocab.rows)

    def learned(rows: DataFrame, tasks: int, steps: Callable) -> attention.Weights:
        sent = spark.sparkContext.broadcast((weights, vocab))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, n = steps(*sent.value, (ids for batch in batches for ids in batch.column(0)))
            if n:
                yield _weights(out.arrays(), n)

        found = _averaged(rows.mapInArrow(run, PART), tasks)
        sent.destroy()
        return found or weights

    for turn in range(ROUNDS):

        def from_sample(start, vocab, texts, turn=turn):
            inputs, kinds, held = [], [], 0
            for text in texts:
                if held < WINDOWS_PER_TASK:
                    own, kind = _windows(text, vocab)
                    inputs.append(own)
                    kinds.append(kind)
                    held += len(own)
            if not held:
                return start, 0
            out, _ = attention.train(start, np.vstack(inputs), np.vstack(kinds), STEPS, seed=turn)
            return out, 1

        weights = learned(sample.repartition(TASKS), TASKS, from_sample)
    tasks = encoded.rdd.getNumPartitions()
    for turn in range(ROUNDS):

        def from_all(start, vocab, texts, turn=turn):
            own = (_windows(text, vocab) for text in islice(texts, turn, None, ROUNDS))
            rate = PASS_RATE * (1 - 0.8 * (turn + 1) / ROUNDS)
            return attention.train_once(start, own, rate, seed=turn)

        weights = learned(encoded, tasks, from_all)
    return attention.Scorer(weights, vocab)


def scores(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs.

    docs(doc_id, text, …). A null text is empty and has the end alone. Rows with equal ids are scored
    apart; a null id is never held out. base_score: smoothed unigram log10 probability of words and
    end; score: log10 probability of the text's subword ids by the model. Extra columns are ignored;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    training = docs.where(~held).select("text")
    counts = stage(word_counts(training), "words")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    limit = head_limit(counts)
    head = counts.where(F.col("n") >= limit).toPandas()  # at most HEAD_WORDS rows
    model = fit(training, counts, ranks_path, pattern)
    known = dict(zip(head["word"].map(bytes), np.log10(head["n"].to_numpy() + 1.0).tolist()))
    sent = spark.sparkContext.broadcast((known, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, model = sent.value
        encode = subwords(ranks_path, pattern).ids
        per_worker(("ids", ranks_path), dict).clear()  # the cache below takes its place
        # values are this run's, so the cache is kept for tasks of the same run only
        cache: dict[bytes, tuple[bytes, float]] = per_worker(("scored", sent._path), dict)

        def entry(word: bytes) -> tuple[bytes, float]:
            found = (encode(word), values.get(word, -1.0))
            if len(cache) < CACHE:  # the words that come first are the frequent ones
                cache[word] = found
            return found

        def one(text: bytes | None) -> tuple[np.ndarray, int, int, float, list]:
            words = [*words_of(text), END]
            entries = [cache.get(w) or entry(w) for w in words]
            ids = np.frombuffer(b"".join(map(itemgetter(0), entries)), dtype="<u2")
            value = np.fromiter(map(itemgetter(1), entries), dtype=np.float64, count=len(words))
            rare = np.flatnonzero(value < 0).tolist()
            tail = Counter([words[k] for k in rare])
            base = float(value.sum()) + len(rare)
            return ids, len(words), len(words) - len(rare), base, list(tail.items())

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
            for low, high in slices(sizes, SLICE):
                rows = [one(t.as_py()) for t in texts[low:high]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        batch.column(1)[low:high],
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.float64()),
                        pa.array(model.texts([r[0] for r in rows]), pa.float64()),
                        pa.array(
                            [[{"word": w, "k": k} for w, k in r[4]] for r in rows],
                            pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())])),
                        ),
                    ],
                    names=["row", "doc_id", "n_tokens", "n_head", "head", "score", "tail"],
                )

    scored = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        ).mapInArrow(
            run,
            "row long, doc_id long, n_tokens long, n_head long, head double, score double, "
            "tail array<struct<word: binary, k: bigint>>",
        ),
        "scored",
    )
    rare = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.k")
    met = rare.join(counts.where(F.col("n") < limit), "word")
    extra = met.groupBy("row").agg(
        F.sum("k").alias("n_tail"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("rest")
    )
    size = whole["n"] + whole["v"] + 1
    return (
        scored.drop("tail")
        .join(extra, "row", "left")
        .select(
            "doc_id",
            F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
            "n_tokens",
            (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
            F.lit(whole["n"]).cast("long").alias("train_tokens"),
            (
                F.col("head")
                + F.coalesce("rest", F.lit(0.0))
                - F.col("n_tokens") * F.log10(F.lit(float(size)))
            ).alias("base_score"),
            "score",
        )
    )
