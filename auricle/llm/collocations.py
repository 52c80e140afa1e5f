"""Mines phrases that occur far more often than their parts would let expect.

Every word of a piece of text starts a suffix, the words from there on up to the longest phrase's
length. Suffixes are dealt to tasks by ranges of their leading words, so all that begin alike lie
side by side, and a multikey three-way quicksort of pointers groups them word by word: the part that
equals the pivot is a phrase and its size a count. Parts too small to hold a candidate are left
unsorted. Only phrases that reach over the edge of a range are counted by more than one task, and
their counts are added up.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auricle.llm.common import arrow_rows, slices, stage

#: What parts pieces, phrase lengths, least count, factor of the score, phrases kept.
BREAKS = re.compile(rb"[.,;:!?\x0a-\x0d]+")
LONGEST = 5
LEAST_COUNT = 100
FACTOR = 1000
TOP = 2000
UNKNOWN = "und"
#: Text that a task holds at a time, suffixes of one sorting task, documents in an Arrow batch.
SLICE = 4 << 20
SUFFIXES = 1_000_000
BATCH = 2000
#: Bits of the filter of frequent words, and the most that the filter of frequent pairs has; their
#: false positives cost sorting, not results.
FILTER_BITS = 1 << 24
PAIR_BITS = 1 << 27
#: Pair occurrences for each of its bits, below that size; far fewer than make a phrase.
LOAD = 8
#: No word holds a tab, so it ends each word of a suffix: what begins with the same words begins
#: with the same characters.
END = "\t"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where("text is not null and text <> ''")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a batch as lower-cased bytes, language by language, a bounded amount a time."""
    # only A-Z have another case in bytes
    sizes = pc.binary_length(batch.column(1)).to_pylist()
    for low, high in slices(sizes, SLICE):
        part = batch.slice(low, high - low)
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
            groups.setdefault(lang, []).append(text.lower())
        yield from groups.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): all occurrences of every word of docs(lang, text, …); a null language is `und`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_lang(batch):
                # bytes.split() parts at blanks and tabs, and at breaks of lines, which are none
                # of a piece; so do the other marks once they are blanks
                counts = Counter(BREAKS.sub(b" ", b"\n".join(texts)).split())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(counts), pa.string()),
                        pa.array([*counts], pa.binary()).cast(pa.string()),
                        pa.array([*counts.values()], pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    found = _texts(docs).mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = zlib.crc32(f"{lang}{END}".encode())
    hashes = (zlib.crc32(word, seed) for word in words)
    return np.fromiter(hashes, dtype=np.int64, count=len(words))


def _filter(places: DataFrame, bits: int) -> np.ndarray:
    """A bitmap with the given places(at) set, however many. Spark sets the bits; the driver receives
    bits / 64 numbers at most."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    rows = (
        places.groupBy(F.floor(F.col("at") / 64).cast("int").alias("place"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    out = np.zeros(-(-bits // 64), dtype="<i8")
    out[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8)


def _held(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7)) & 1 == 1


class _Coded:
    """Texts of one language as numbers of their distinct words, pieces apart."""

    def __init__(self, lang: str, texts: list[bytes], frequent: np.ndarray):
        joined = b"\n".join(texts).replace(b"\t", b" ")
        words = BREAKS.sub(b" \n ", joined).split(b" ")
        coded = pa.array(words, pa.binary()).dictionary_encode()
        del words
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.hashes = _hashes(self.words, lang)
        marks = np.array([word in (b"", b"\n") for word in self.words])
        good = _held(frequent, self.hashes % FILTER_BITS) & ~marks
        blank = np.array([word == b"" for word in self.words])
        ids = coded.indices.to_numpy()
        self.ids = ids[~blank[ids]] if blank.any() else ids
        self.good = good[self.ids]

    def pairs(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a frequent word follows another, and the place in the filter of each such pair."""
        at = np.flatnonzero(self.good[:-1] & self.good[1:])
        mixed = self.hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        first, second = mixed[self.ids[at]], self.hashes[self.ids[at + 1]].astype(np.uint64)
        mixed = (first ^ (first >> np.uint64(29)) ^ second) * np.uint64(0xBF58476D1CE4E5B9)
        return at, ((mixed >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def _pair_filter(docs: DataFrame, frequent: np.ndarray, bits: int, least: int) -> np.ndarray:
    """A bitmap of the places at which pairs of frequent words fall that occur `least` times together
    with all others of the same place."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # FILTER_BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_lang(batch):
                _, places = _Coded(lang, texts, shared.value).pairs(bits)
                at, n = np.unique(places, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["at", "n"]
                )

    counted = _texts(docs).mapInArrow(run, "at int, n int").groupBy("at").agg(F.sum("n").alias("n"))
    return _filter(counted.where(F.col("n") >= least), bits)


def suffixes(docs: DataFrame, frequent: np.ndarray, pairs: np.ndarray, bits: int) -> DataFrame:
    """(lang, suffix, n): the up to LONGEST words from each word of each piece on, END after each,
    cut before the first word that is not frequent or makes no frequent pair; those of two words at
    least. Suffixes that occur again in the texts a task holds are one row with their count."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, pairs))  # two bitmaps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, together = shared.value
        for batch in batches:
            for lang, texts in _by_lang(batch):
                coded = _Coded(lang, texts, words)
                at, places = coded.pairs(bits)
                linked = np.zeros(len(coded.ids), dtype=bool)
                linked[at[_held(together, places)]] = True
                yield from emit(lang, coded, linked)

    def emit(lang: str, coded: _Coded, linked: np.ndarray) -> Iterator[pa.RecordBatch]:
        reach = _runs(linked) + 1
        starts = np.flatnonzero(linked)
        if not len(starts):
            return
        # words are numbered from one on; nought stands for none
        padded = np.append(coded.ids + 1, np.zeros(LONGEST, dtype=coded.ids.dtype))
        rows = padded[starts[:, None] + np.arange(LONGEST)]
        rows[np.arange(LONGEST) >= reach[starts][:, None]] = 0
        rows, counts = _distinct_rows(rows)
        ended = pa.array([b"", *(word + END.encode() for word in coded.words)], pa.binary())
        columns = [ended.take(pa.array(rows[:, k])) for k in range(LONGEST)]
        joined = pc.binary_join_element_wise(*columns, pa.scalar(b"", pa.binary()))
        for low in range(0, len(rows), 50_000):
            part = joined.slice(low, 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()),
                    part.cast(pa.string()),
                    pa.array(counts[low : low + len(part)]),
                ],
                names=["lang", "suffix", "n"],
            )

    return _texts(docs).mapInArrow(run, "lang string, suffix string, n long")


def _runs(linked: np.ndarray) -> np.ndarray:
    """How many links follow from each place on, itself included, LONGEST - 1 at most."""
    reach = np.zeros(len(linked) + 1, dtype=np.int64)
    for _ in range(LONGEST - 1):
        reach[:-1] = np.where(linked, reach[1:] + 1, 0)
    return reach[:-1]


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    at = np.flatnonzero(first)
    return rows[at], np.diff(np.append(at, len(rows)))


def sort_phrases(
    words: np.ndarray, weight: np.ndarray, least: int
) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to suffixes, rows of word numbers with nought as end.

    Yields (pointer, depth, count) for each phrase of `depth` words, 2 or more, that begins suffixes
    of weight `least` together; pointer is one of them. Parts of less weight are not sorted.
    """
    stack = [(np.arange(len(words)), 0)]
    while stack:
        rows, depth = stack.pop()
        column = words[rows, depth]
        pivot = int(column[len(column) // 2])
        for part, here in (
            (rows[column < pivot], False),
            (rows[column > pivot], False),
            (rows[column == pivot], True),
        ):
            count = int(weight[part].sum())
            if count < least:
                continue
            if not here:
                stack.append((part, depth))
            elif pivot:
                if depth:
                    yield int(part[0]), depth + 1, count
                if depth + 1 < words.shape[1]:
                    stack.append((part, depth + 1))


def _ends(langs: pa.Array, suffixes: pa.Array) -> tuple[int, int]:
    """The rows of the first and the last suffix by language and bytes."""
    found = []
    for end in ("min", "max"):
        rows = np.flatnonzero(pc.equal(langs, pc.min_max(langs)[end]).to_numpy(zero_copy_only=False))
        some = suffixes.take(pa.array(rows))
        found.append(int(rows[pc.index(some, pc.min_max(some)[end]).as_py()]))
    return found[0], found[1]


def _count_sorted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Phrase counts of one range of suffixes: those of at least `least`, and of any size where the
    phrase may go on in the range before or after."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    langs = table.column("lang").combine_chunks()
    weights = table.column("n").to_numpy()
    names = langs.dictionary_encode()
    split = pc.split_pattern(table.column("suffix").combine_chunks(), END)
    coded = split.flatten().dictionary_encode()
    known = coded.dictionary
    ends = split.offsets.to_numpy().astype(np.int64)
    # the last part of a suffix is empty, after its last END
    sizes = np.diff(ends) - 1
    words = np.zeros((len(sizes), LONGEST), dtype=np.int32)
    column = np.arange(LONGEST)
    inside = column < sizes[:, None]
    ids = coded.indices.to_numpy() + 1
    words[inside] = ids[(ends[:-1][:, None] + column)[inside]]
    which = names.indices.to_numpy()
    low, high = _ends(langs, table.column("suffix").combine_chunks())
    out: list[tuple[int, int, int]] = []
    edges: set[tuple[int, bytes]] = set()
    for row in (low, high):
        same = which == which[row]
        for depth in range(1, int(sizes[row]) + 1):
            same &= words[:, depth - 1] == words[row, depth - 1]
            mark = (int(which[row]), words[row, :depth].tobytes())
            if depth > 1 and mark not in edges:
                edges.add(mark)
                out.append((row, depth, int(weights[same].sum())))
    for lang in range(len(names.dictionary)):
        rows = np.flatnonzero(which == lang)
        for at, depth, count in sort_phrases(words[rows], weights[rows], least):
            row = int(rows[at])
            if (lang, words[row, :depth].tobytes()) not in edges:
                out.append((row, depth, count))
    text = known.to_pylist()
    for begin in range(0, len(out), 10_000):
        part = out[begin : begin + 10_000]
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array([row for row, _, _ in part])),
                pa.array([[text[k - 1] for k in words[row, :depth]] for row, depth, _ in part]),
                pa.array([count for _, _, count in part], pa.int64()),
            ],
            names=["lang", "words", "a"],
        )


def phrase_counts(
    docs: DataFrame, singles: DataFrame, least: int = LEAST_COUNT, per_task: int = SUFFIXES
) -> DataFrame:
    """(lang, words, a): the phrases of 2 to LONGEST words that occur `least` times, by language.

    singles: the counts of all words. A phrase is no more frequent than its words and pairs, so
    suffixes end before the first rarer one.
    """
    spark = docs.sparkSession
    total = singles.agg(F.sum("n")).first()[0] or 0
    at = F.crc32(F.encode(F.concat("lang", F.lit(END), "word"), "UTF-8")) % FILTER_BITS
    frequent = _filter(singles.where(F.col("n") >= least).select(at.alias("at")), FILTER_BITS)
    bits = min(PAIR_BITS, max(1 << 16, 1 << (total // LOAD).bit_length()))
    with arrow_rows(spark, BATCH):
        pairs = _pair_filter(docs, frequent, bits, least)
        ranges = max(spark.sparkContext.defaultParallelism, -(-total // per_task))
        dealt = suffixes(docs, frequent, pairs, bits).repartitionByRange(ranges, "lang", "suffix")
        counted = dealt.mapInArrow(
            lambda batches: _count_sorted(batches, least),
            "lang string, words array<string>, a long",
        )
        # a phrase at the edge of a range is here once for each range
        return stage(
            counted.groupBy("lang", "words")
            .agg(F.sum("a").alias("a"))
            .where(F.col("a") >= least),
            "phrases",
        )


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, per_task: int = SUFFIXES
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    docs(lang, text, …): texts are lower-cased in A-Z, parted into pieces at marks and line breaks,
    and pieces into words at blanks and tabs. a: occurrences of the phrase, n: of all words of the
    language; l, r: of the two parts at the cut where floor(FACTOR * a * n / (l * r)), the score, is
    least (of several, the first cut). A phrase within a longer one as frequent is left out. Ties in
    the score go by a, then by the phrase's bytes. A null or empty text has no words, a null language
    is `und`, rows that repeat count again, other columns are ignored; an empty table gives no rows.
    """
    singles = stage(word_counts(docs), "words")
    counted = phrase_counts(docs, singles, least, per_task)
    size = F.size("words")
    shorter = counted.where(size > 2).select("lang", "a", "words")
    # a phrase within any longer one as frequent is within one that is longer by a word
    inner = shorter.select(
        "lang",
        F.explode(
            F.array(F.slice("words", 1, size - 1), F.slice("words", F.lit(2), size - 1))
        ).alias("words"),
        F.col("a").alias("outer"),
    )
    most = inner.groupBy("lang", "words").agg(F.max("outer").alias("outer"))
    kept = counted.join(most, ["lang", "words"], "left").where(
        "outer is null or outer < a"
    )
    parts = counted.unionByName(
        singles.where(F.col("n") >= least).select(
            "lang", F.array("word").alias("words"), F.col("n").alias("a")
        )
    )
    cuts = kept.select(
        "lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).select(
        "*",
        F.slice("words", F.lit(1), F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"),
    )
    heads = parts.select("lang", F.col("words").alias("head"), F.col("a").alias("l"))
    tails = parts.select("lang", F.col("words").alias("tail"), F.col("a").alias("r"))
    totals = singles.groupBy("lang").agg(F.sum("n").alias("n"))
    wide = F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)") * FACTOR
    under = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("wide", wide.cast("decimal(38,0)"))
        .withColumn("under", under.cast("decimal(38,0)"))
        .withColumn("score", F.expr("wide div under"))
    )
    chosen = scored.groupBy("lang", "words").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    )
    ranked = chosen.select("lang", F.array_join("words", " ").alias("phrase"), "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        ranked.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


#: The query for DuckDB, over documents.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
    FROM pieces
), started AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM worded
), grams AS (
    SELECT lang, list_slice(words, p, p + m - 1) AS words
    FROM started, (SELECT unnest(range(1, 6)) AS m) WHERE p + m - 1 <= len(words)
), counted AS (
    SELECT lang, words, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(a) AS n FROM counted WHERE len(words) = 1 GROUP BY lang
), many AS (
    SELECT * FROM counted WHERE a >= 100
), inside AS (
    SELECT lang, list_slice(words, s, s + m - 1) AS words, max(a) AS outer_a
    FROM many, (SELECT unnest(range(1, 5)) AS s), (SELECT unnest(range(2, 5)) AS m)
    WHERE m < len(words) AND s + m - 1 <= len(words) GROUP BY ALL
), kept AS (
    SELECT many.* FROM many LEFT JOIN inside USING (lang, words)
    WHERE len(words) > 1 AND (outer_a IS NULL OR 100 * outer_a < 100 * a)
), cuts AS (
    SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM kept
), scored AS (
    SELECT c.lang, c.words, c.k, c.a, h.a AS l, t.a AS r, n,
        (1000::HUGEINT * c.a * n) // (h.a * t.a) AS score
    FROM cuts c
    JOIN counted h ON h.lang = c.lang AND h.words = list_slice(c.words, 1, k)
    JOIN counted t ON t.lang = c.lang AND t.words = list_slice(c.words, k + 1, len(c.words))
    JOIN totals ON totals.lang = c.lang
), lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), ranked AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score,
        row_number() OVER (PARTITION BY lang
            ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank
    FROM lowest
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
    CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
