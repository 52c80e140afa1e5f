"""Language by compression: the language whose raw-content dictionary compresses a text best."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auricle.llm.common import fold

FOLDS = 3
HELD_OUT = 1
UNKNOWN = "und"
#: The sample a dictionary is made of: the beginnings of at most so many distinct texts of a language.
SAMPLE_TEXTS = 192
SAMPLE_CHARS = 512
DICTIONARY_BYTES = 96 << 10
#: Texts are compressed in parts of this size, so that the dictionary and not the text's own
#: repetition decides; short texts with more effort.
PART = 2048
LEVEL, SHORT_LEVEL, SHORT = 6, 19, 512
#: Rejected when the second best is within this share of the best size.
MARGIN = 0.01


def learn(docs: DataFrame, held_out: int | None = HELD_OUT) -> dict[str, bytes]:
    """A dictionary text for each value of lang, the most frequent first, from docs(doc_id, text, lang, …).

    The sample is drawn by a hash of the text from all rows outside the held-out fold, copies
    counting once: rows below a threshold hash that passes about twice SAMPLE_TEXTS of a language,
    of which the lowest hashes stay. Rows with a null or blank text or lang teach nothing.
    """
    usable = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(
        "lang is not null and trim(text) <> ''"
    )
    if held_out is not None:
        usable = usable.where(F.coalesce(fold(F.col("doc_id"), FOLDS), F.lit(-1)) != held_out)
    spread = 1 << 40
    drawn = usable.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(spread)))
    sizes = drawn.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    near = (
        drawn.join(F.broadcast(sizes), "lang")  # one row per language
        .where(F.col("h") < F.lit(2.5 * SAMPLE_TEXTS * spread) / F.col("n"))
        .groupBy("lang", "h")
        .agg(F.first("text").alias("text"), F.first("n").alias("n"))
    )
    lowest = Window.partitionBy("lang").orderBy("h")
    rows = (
        near.withColumn("k", F.row_number().over(lowest))
        .where(F.col("k") <= SAMPLE_TEXTS)
        .select("lang", "k", F.substring("text", 1, SAMPLE_CHARS).alias("text"), "n")
        .orderBy(F.desc("n"), "lang", "k")
        .collect()  # at most SAMPLE_TEXTS short rows for each language
    )
    out: dict[str, bytes] = {}
    for row in rows:
        held = out.get(row["lang"], b"")
        if len(held) < DICTIONARY_BYTES:
            out[row["lang"]] = held + b" " + spoken(row["text"])
    return {k: v[-DICTIONARY_BYTES:] for k, v in out.items()}


#: Bytes that tell no language: ASCII but for letters and white space.
_SILENT = bytes(
    k for k in range(128) if not chr(k).isalpha() and chr(k) not in " \t\n\r"
)


def spoken(text: str) -> bytes:
    """What is compressed of a text: lower-cased, without ASCII digits and marks."""
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _SILENT)


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, texts: dict[str, bytes]):
        self.names = list(texts)
        self._by_level = {}
        for level in (LEVEL, SHORT_LEVEL):
            made = []
            for raw in texts.values():
                data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                made.append(
                    zstandard.ZstdCompressor(
                        dict_data=data,
                        level=level,
                        write_content_size=False,
                        write_checksum=False,
                    )
                )
            self._by_level[level] = made

    def sizes(self, text: str) -> np.ndarray:
        raw = spoken(text)
        made = self._by_level[SHORT_LEVEL if len(raw) <= SHORT else LEVEL]
        parts = [raw[k : k + PART] for k in range(0, len(raw), PART)]
        return np.array([sum(len(c.compress(p)) for p in parts) for c in made], dtype=np.float64)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected) of one whole text.

        The score is the share of the best language when each gets exp(-size / scale), the scale
        being a hundredth of the best size. Ties go to the more frequent language. Without a letter in the text, or
        without languages: und, 0, rejected.
        """
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        share = 1 / np.exp((sizes[best] - sizes) / max(1.0, 0.01 * sizes[best])).sum()
        rest = np.delete(sizes, best)
        narrow = bool(len(rest)) and rest.min() - sizes[best] < MARGIN * sizes[best]
        return self.names[best], float(share), narrow


def languages(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of docs(doc_id, text, …).

    rejected marks rows whose margin between the two best languages is narrow; the best one is named
    all the same. Null, empty and letterless texts are `und` with score 0, rejected. Rows with equal
    ids are judged apart; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for batch in batches:
            found = [judge.decide(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )
