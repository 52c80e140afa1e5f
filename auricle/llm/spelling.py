"""Groups spelling variants: words one edit apart, and the frequent form that each word stands for.

Two words are one edit apart when their common prefix and suffix together reach the length of the
longer one less one. Padded matrices of code points compare blocks of words with each other; which
blocks meet is settled by segments: an edit lies in one segment of the shorter word, and all before
and after it is equal, so only words that share the rest are laid side by side. Where too many do,
the segment is cut again, down to single code points, which bounds every group by the alphabet.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auricle.llm.common import remove, shuffle_width, stage, write_staged

#: What a word is made of, every DAMAGED-th run loses a code point, and from how many
#: code points and occurrences on a word counts.
RUN = r"([A-Za-zÀ-ÿ]+)"
DAMAGED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is this many times as frequent as the word.
RATIO = 10
#: Segments that a word or a crowded segment is cut into, and members from which a group is crowded.
SEGMENTS = 3
CROWD = 512
#: Rows of one comparing task's table, and bytes of one block pair.
TABLE_ROWS = 100_000
TILE = 1 << 16


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of docs(doc_id, text, …): the words of all texts and their occurrences.

    A run of letters is lower-cased in A-Z; where 31 divides the crc32 h of `<doc_id>:<run>`, the
    code point h % length is cut out of it, so that variants of known origin exist. A null text has
    no words, a null id counts as empty text. Texts are read whole; rows that repeat count again.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(
            F.filter(
                F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(1)),
                lambda run: F.length(run) >= LEAST_LENGTH,
            )
        ).alias("run"),
    )
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    hashed = runs.select("id", lower.alias("run")).withColumn(
        "h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    )
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(
        F.substring(F.col("run"), F.lit(1), at),
        F.substring(F.col("run"), at + 2, F.length("run")),
    )
    word = F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _bounds(low: Column, high: Column) -> Column:
    """The segments of [low, high) as an array of (low, high), at most SEGMENTS, none empty."""
    size = high - low
    parts = F.least(size, F.lit(SEGMENTS))
    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda k: F.struct(
            (low + F.floor(k * size / parts)).cast("int").alias("low"),
            (low + F.floor((k + 1) * size / parts)).cast("int").alias("high"),
        ),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """rows(word, n, base, low, high) cut into their next segments, each with the hash of what lies
    outside of it. base: length of the shorter word of the pairs that are looked for."""
    cut = rows.select("word", "n", "base", F.explode(_bounds(F.col("low"), F.col("high"))).alias("s"))
    after = F.col("base") - F.col("s.high")
    outside = F.xxhash64(
        "base",
        "s.low",
        "s.high",
        F.substring(F.col("word"), F.lit(1), F.col("s.low")),
        F.substring(F.col("word"), F.length("word") - after + 1, after),
    )
    return cut.select(
        "word", "n", "base", F.col("s.low").alias("low"), F.col("s.high").alias("high"),
        outside.alias("key"),
    )


def _ranges(size: np.ndarray) -> np.ndarray:
    """0, 1, … size[0] - 1, 0, 1, … size[1] - 1, …"""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


def _matrices(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int):
    """The words as rows of code points, once flush left and once mirrored, padded with nought."""
    left = np.zeros((len(size), width), dtype=np.uint8)
    mirrored = np.zeros((len(size), width), dtype=np.uint8)
    row, column = np.repeat(np.arange(len(size)), size), _ranges(size)
    points = flat[np.repeat(begin, size) + column]
    left[row, column] = points
    mirrored[row, np.repeat(size, size) - 1 - column] = points
    return left, mirrored


def _shared(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Leading columns in which each pair of rows agrees, over a batch of block pairs."""
    differ = one[:, :, None, :] != other[:, None, :, :]
    first = differ.argmax(axis=3)
    return np.where(differ.any(axis=3), first, one.shape[-1])


class _Group:
    """The words of one table, sorted by group, and their single edits."""

    def __init__(self, table: pa.Table):
        words = table.column("word").combine_chunks()
        numbers = {
            name: table.column(name).to_numpy() for name in ("n", "base", "low", "high", "key")
        }
        size = pc.binary_length(words).to_numpy().astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.lexsort(
            (size, numbers["key"], numbers["high"], numbers["low"], numbers["base"])
        )
        self.flat = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
        self.begin, self.size = begin[order], size[order]
        for name, value in numbers.items():
            setattr(self, name, value[order])
        self.words = words.take(pa.array(order))

    def edits(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs, each once: the shorter word, and one as long or one longer."""
        same = (
            (self.key[1:] == self.key[:-1])
            & (self.low[1:] == self.low[:-1])
            & (self.high[1:] == self.high[:-1])
            & (self.base[1:] == self.base[:-1])
        )
        start = np.flatnonzero(np.append(True, ~same))
        group = np.cumsum(np.append(True, ~same)) - 1
        last = np.append(start[1:], len(self.size))[group]
        # rows of like length form a run; within it, blocks of a size that fits the length
        at = 0
        while at < len(self.size):
            # most words of a run are of one length, so little is padded
            width = int(self.base[at]) + 1
            end = int(np.searchsorted(self.base, self.base[at], side="right"))
            block = max(4, min(64, int((TILE / width) ** 0.5)))
            yield from self._run(at, end, last, group, width, block)
            at = end

    def _run(self, begin: int, end: int, last: np.ndarray, group: np.ndarray, width: int, block: int):
        blocks = np.arange(begin, end, block)
        # a block meets itself and the later ones that its last row's group reaches
        final = np.minimum(blocks + block, end) - 1
        reach = (last[final] - 1 - begin) // block
        own = np.arange(len(blocks))
        count = reach - own + 1
        first = np.repeat(own, count)
        second = first + _ranges(count)
        step = max(1, (16 * TILE) // (block * block * width))
        for low in range(0, len(first), step):
            one, two = first[low : low + step], second[low : low + step]
            rows_one = begin + one[:, None] * block + np.arange(block)
            rows_two = begin + two[:, None] * block + np.arange(block)
            valid = (rows_one < end)[:, :, None] & (rows_two < end)[:, None, :]
            a, b = np.minimum(rows_one, end - 1), np.minimum(rows_two, end - 1)
            valid &= group[a][:, :, None] == group[b][:, None, :]
            valid &= rows_one[:, :, None] < rows_two[:, None, :]
            # sorted by length, so the first one is the shorter; two of the longer kind have a
            # group of their own
            valid &= (self.size[a] == self.base[a])[:, :, None]
            some = valid.any(axis=(1, 2))
            if not some.any():
                continue
            a, b, valid = a[some], b[some], valid[some]
            used, place = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
            left, mirrored = _matrices(self.flat, self.begin[used], self.size[used], width)
            pa_, pb = place[: a.size].reshape(a.shape), place[a.size :].reshape(b.shape)
            shorter, longer = self.size[a][:, :, None], self.size[b][:, None, :]
            prefix = np.minimum(_shared(left[pa_], left[pb]), shorter)
            suffix = np.minimum(_shared(mirrored[pa_], mirrored[pb]), shorter)
            near = valid & (prefix + suffix >= longer - 1)
            # one pair may lie in neighbouring segments: the first that holds the edit counts
            edit = shorter - suffix
            low_, high_ = self.low[a][:, :, None], self.high[a][:, :, None]
            near &= (low_ <= prefix) & (high_ >= edit) & ((low_ < edit) | (low_ == 0))
            k, i, j = np.nonzero(near)
            if len(k):
                yield a[k, i], b[k, j]


def _compare(table: pa.Table) -> pa.Table:
    """(word, near, near_n): both directions of every edit found in a table of whole groups."""
    group = _Group(table)
    found = [*group.edits()] if len(table) else []
    none = np.zeros(0, dtype=np.int64)
    one = np.concatenate([a for a, _ in found]) if found else none
    two = np.concatenate([b for _, b in found]) if found else none
    left, right = np.append(one, two), np.append(two, one)
    return pa.table(
        {
            "word": group.words.take(pa.array(left)),
            "near": group.words.take(pa.array(right)),
            "near_n": pa.array(group.n[right]) if len(right) else pa.array([], pa.int64()),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for every two words of words(word, n) that are one edit apart, both ways.

    Words are distinct and of letters up to U+00FF. Compared in tables of whole groups, about
    TABLE_ROWS rows each; no group is larger than CROWD unless all but one code point is shared.
    """
    spark = words.sparkSession
    wanted = words.select(
        "word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("base")
    ).where(F.col("base") >= F.least(F.length("word"), F.lit(LEAST_LENGTH)))
    rows = _keyed(wanted.select("*", F.lit(0).alias("low"), F.col("base").alias("high")))
    groups, parts, paths = ["base", "low", "high", "key"], [], []
    while True:
        sizes = rows.groupBy(*groups).agg(F.count("*").alias("members"))
        crowded, path = write_staged(
            sizes.where((F.col("members") > CROWD) & (F.col("high") - F.col("low") > 1)), "crowded"
        )
        paths.append(path)
        if crowded.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(crowded, groups, "left_anti"))
        held, path = write_staged(rows.join(crowded, groups, "left_semi"), "crowded")
        paths.append(path)
        rows = _keyed(held)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    tables = max(shuffle_width(spark), 6 * words.count() // TABLE_ROWS)
    dealt = rows.select(
        F.encode("word", "ISO-8859-1").alias("word"),
        F.col("n").cast("long").alias("n"),
        F.col("base").cast("int").alias("base"),
        F.col("low").cast("int").alias("low"),
        F.col("high").cast("int").alias("high"),
        "key",
        F.pmod("key", F.lit(tables)).cast("int").alias("table"),
    )
    found = dealt.groupBy("table").applyInArrow(_compare, "word binary, near binary, near_n long")
    pairs, _ = write_staged(
        found.select(
            F.decode("word", "ISO-8859-1").alias("word"),
            F.decode("near", "ISO-8859-1").alias("near"),
            "near_n",
        ),
        "near",
    )
    remove(spark, paths)
    return pairs


def with_roots(forms: DataFrame) -> DataFrame:
    """forms(word, form) with root: the last form that is reached from a word. Forms are followed by
    doubling, one join a round."""
    spark = forms.sparkSession
    current, path = write_staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = current.join(further, "root", "left")
        after, after_path = write_staged(
            joined.select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        remove(spark, [path])
        path = after_path
        current = after.select("word", "root")
        if after.where("moved").isEmpty():
            return forms.join(current, "word")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of docs(doc_id, text, …).

    form: the most frequent word one edit away (of several the first in code-point order), if it
    occurs RATIO times as often, else null; form_n how often; root: the last form reached by going
    from form to form, the word itself if there is none; n_near: words one edit away. An empty table
    gives no rows; see word_counts for null and repeated rows.
    """
    words = stage(word_counts(docs), "words")
    pairs = near_words(words)
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best")
    )
    near = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.col("best.near").alias("near"),
        (-F.col("best.col1")).alias("near_n"),
    )
    is_form = F.col("near_n") >= RATIO * F.col("n")
    chosen = stage(
        near.select(
            "word",
            "n",
            "n_near",
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = with_roots(chosen.where("form is not null").select("word", "form")).drop("form")
    return chosen.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
