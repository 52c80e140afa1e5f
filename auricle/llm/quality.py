"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.llm.common import fold, lean, shuffle_width, stage

FOLDS = 4
HELD_OUT = 2
ACCEPT = 0.7
RANDOM_FEATURES = 256
RIDGE = 1e-3
SEED = 6
#: Tasks that sum the normal equations, or as many as a shuffle has if that is more; each sends one
#: matrix of RANDOM_FEATURES squared, in chunks of so many numbers.
TASKS = 32
CHUNK = 1 << 13
WINDOW_BYTES = 256
WINDOW_WORDS = 32
CALIBRATION_BINS = 4096
RAW_LOW, RAW_HIGH = -1.0, 2.0

UPPER, LOWER, DIGIT, WHITE, MARK, SYMBOL, HIGH = range(7)
_CLASS = np.full(256, SYMBOL, dtype=np.uint8)
_CLASS[list(range(65, 91))] = UPPER
_CLASS[list(range(97, 123))] = LOWER
_CLASS[list(range(48, 58))] = DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = WHITE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = MARK
_CLASS[128:] = HIGH
STATISTICS = 20


def statistics(text: bytes | None) -> np.ndarray:
    """Numbers that describe one whole text (UTF-8): shares of character classes, repetition, and
    the extremes of both over windows. All zero for a text without characters."""
    out = np.zeros(STATISTICS)
    if not text:
        return out
    size = len(text)
    kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    count = -(-size // WINDOW_BYTES)
    padded = np.full(count * WINDOW_BYTES, 255, dtype=np.uint8)
    padded[:size] = kinds
    grid = padded.reshape(count, WINDOW_BYTES)
    each = np.stack([(grid == k).sum(axis=1) for k in range(7)])
    filled = np.full(count, WINDOW_BYTES)
    filled[-1] = size - (count - 1) * WINDOW_BYTES
    share = each / filled
    words = text.split()
    total = each.sum(axis=1) / size
    out[:2] = np.log1p(size), np.log1p(len(words))
    out[2:9] = total
    letters = share[UPPER] + share[LOWER] + share[HIGH]
    out[9] = share[UPPER].max()
    out[10] = share[SYMBOL].max()
    out[11] = (share[UPPER] > 0.4).mean()
    out[12] = (share[SYMBOL] > 0.04).mean()
    out[13] = letters.min()
    if words:
        out[14] = size / len(words)
        out[15] = len(set(words)) / len(words)
    if len(words) > 1:
        same = np.fromiter(map(eq, words, words[1:]), dtype=np.float64, count=len(words) - 1)
        out[16] = same.mean()
        run = np.add.reduceat(same, np.arange(0, len(same), WINDOW_WORDS))
        long = np.diff(np.append(np.arange(0, len(same), WINDOW_WORDS), len(same)))
        out[17] = (run / long).max()
        out[18] = (run / long > 0.4).mean()
    out[19] = np.log1p(share[SYMBOL].max() * 100)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) for every row of docs(doc_id, text, …)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = [statistics(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.mapInArrow(lean(run), "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _summed(frame: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of part(X, y) over all batches of frame(x, y).

    Every task sends its sum in chunks; each chunk is added up over the tasks in their order, so the
    driver receives one array, however many tasks there are, and a repeated task changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                value = part(_matrix(batch.column(0)), np.asarray(batch.column(1))).ravel()
                total = value if total is None else total + value
        if total is not None:
            chunks = [total[k : k + CHUNK].tobytes() for k in range(0, len(total), CHUNK)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(chunks)), pa.int32()),
                    pa.array([task] * len(chunks), pa.int32()),
                    pa.array(chunks, pa.binary()),
                ],
                names=["chunk", "task", "s"],
            )

    def add(sums: pa.Table) -> pa.Table:
        rows = sums.sort_by("task")
        total = np.sum([np.frombuffer(s, np.float64) for s in rows["s"].to_pylist()], axis=0)
        return pa.table({"chunk": rows["chunk"][:1], "s": pa.array([total.tobytes()], pa.binary())})

    width = max(TASKS, shuffle_width(frame.sparkSession))
    rows = (
        frame.select("x", "y")
        .coalesce(width)
        .mapInArrow(run, "chunk int, task int, s binary")
        .groupBy("chunk")
        .applyInArrow(add, "chunk int, s binary")
        .collect()  # one array in all
    )
    parts = [np.frombuffer(r["s"], np.float64) for r in sorted(rows, key=lambda r: r["chunk"])]
    return np.concatenate(parts) if parts else np.zeros(0)


@dataclass
class Model:
    """score(X): a value from 0 to 1 for each row of statistics."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    level_at: np.ndarray
    level: np.ndarray

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, whose inner products approximate a Gaussian kernel."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.waves + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.mapped(x) @ self.weight, RAW_LOW, RAW_HIGH)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.interp(self.raw(x), self.level_at, self.level)


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their never falling means, `at` ascending."""
    blocks: list[list[float]] = []  # weight, weighted value, weighted position
    for a, v, w in zip(at, value, weight):
        blocks.append([w, w * v, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 2] / table[:, 0], np.clip(table[:, 1] / table[:, 0], 0, 1)


def labelled(stats: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> DataFrame:
    """(x, y) of the rows to learn from: a 0/1 label and an id outside the held-out fold.

    Several labels of one id count as their rounded mean; null labels and ids are left out.
    """
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.when(F.avg("quality") >= 0.5, 1.0).otherwise(0.0).alias("y"))
    )
    if held_out is not None:
        known = known.where(fold(F.col("doc_id"), FOLDS) != held_out)
    return stats.join(known, "doc_id").select("x", "y")


def fit(train: DataFrame, seed: int = SEED) -> Model:
    """Fits on train(x, y), every row of it; without rows every score is 1 (nothing to reject)."""
    train = stage(train, "train")
    rows = train.count()
    if not rows:
        flat = np.zeros(STATISTICS)
        return Model(
            flat, flat + 1, np.zeros((STATISTICS, 1)), np.zeros(1), np.zeros(2),
            np.array([0.0]), np.array([1.0]),
        )
    moments = _summed(train, lambda x, y: np.vstack([x.sum(0), (x * x).sum(0)]))
    first, second = moments.reshape(2, STATISTICS)
    mean = first / rows
    scale = np.sqrt(np.maximum(second / rows - mean**2, 1e-12))
    rng = np.random.default_rng(seed)
    width = np.sqrt(STATISTICS)
    model = Model(
        mean,
        np.where(scale > 1e-5, scale, 1.0),
        rng.normal(size=(STATISTICS, RANDOM_FEATURES)) / width,
        rng.uniform(0, 2 * np.pi, RANDOM_FEATURES),
        np.zeros(RANDOM_FEATURES + 1),
        np.array([0.0]),
        np.array([0.0]),
    )

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.mapped(x)
        return z.T @ np.column_stack([z, y])

    side = RANDOM_FEATURES + 1
    both = _summed(train, equations).reshape(side, side + 1)
    penalty = RIDGE * rows / RANDOM_FEATURES * np.eye(side)
    penalty[-1, -1] = 1e-9
    model.weight = np.linalg.solve(both[:, :side] + penalty, both[:, side])

    step = (RAW_HIGH - RAW_LOW) / CALIBRATION_BINS

    def raw_bins(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            bins = ((model.raw(_matrix(batch.column(0))) - RAW_LOW) / step).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["b", "y"])

    held = (
        train.mapInArrow(raw_bins, "b int, y double")
        .groupBy("b")
        .agg(F.count("*").alias("n"), F.avg("y").alias("y"))
        .orderBy("b")
        .toPandas()  # at most one row per bin
    )
    centre = RAW_LOW + (held["b"].to_numpy() + 0.5) * step
    model.level_at, model.level = isotonic(centre, held["y"].to_numpy(), held["n"].to_numpy())
    return model


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function: the score of a text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        raw = [None if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        return pd.Series(model.score(np.array([statistics(t) for t in raw]).reshape(-1, STATISTICS)))

    return score


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text, …).

    Learns from labels(doc_id, quality) outside the held-out fold. Null and empty texts are scored
    like any other, by statistics of zero. A null id is scored and never held out. Rows with equal
    ids are scored apart. Extra columns are ignored.
    """
    stats = stage(document_statistics(docs), "statistics")
    model = fit(labelled(stats, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value, pa.float64())], names=["doc_id", "score"]
            )

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score of at least ACCEPT; columns unchanged, no text is shuffled."""
    model = fit(labelled(document_statistics(docs), labels))
    return docs.where(scorer(model)(F.col("text").cast("string")) >= ACCEPT)
