"""URL verdicts by host and path rules, and by exact membership in a Bloom filter cascade."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.llm.common import stage

#: (verdict, host, path), fixed by the contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Hash functions and bits for each key of a level; about one in sixteen other keys passes.
HASHES, BITS_PER_KEY = 4, 6
KEYS_PER_SHARD = 1 << 20
#: Filter bytes that are sent to the executors at once; larger cascades go in blocks of shards.
BYTES_AT_ONCE = 64 << 20
LEVEL_LIMIT = 60


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """pages(url, …) with host and path added; both empty for a null url or one without `://`."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return pages.withColumn(
        "host", F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    ).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def ruled(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits columns host and path; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = (
            (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        ) & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def _hashed(keys: DataFrame, key: str) -> DataFrame:
    """Two independent 64-bit hashes of the key, so different keys stay apart."""
    return keys.withColumn("h1", F.xxhash64(key)).withColumn(
        "h2", F.xxhash64(F.concat(F.lit("~"), F.col(key)))
    )


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit places (HASHES, n) of the keys in a level's filter of so many bits per shard."""
    out = np.empty((HASHES, len(h1)), dtype=np.uint64)
    for k in range(HASHES):
        salt = np.uint64((0x9E3779B97F4A7C15 * (level * HASHES + k + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (h1.view(np.uint64) + salt) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= (x >> np.uint64(31)) ^ h2.view(np.uint64)
        x *= np.uint64(0x94D049BB133111EB)
        out[k] = (x ^ (x >> np.uint64(29))) % np.uint64(bits)
    return out


def _shards(h1: np.ndarray, h2: np.ndarray, count: int) -> np.ndarray:
    return (((h1 ^ (h2 >> 17)).view(np.uint64) >> np.uint64(20)) % np.uint64(count)).astype(np.int64)


@dataclass
class Cascade:
    """Levels of Bloom filters, sharded by key; words: (level, shard, word, bits) in a table."""

    spark: SparkSession
    shards: int
    bits: list[int]
    words: DataFrame | None

    def _blocks(self) -> Iterator[tuple[int, int]]:
        per_shard = sum(b // 8 for b in self.bits) or 1
        step = max(1, BYTES_AT_ONCE // per_shard)
        for low in range(0, self.shards, step):
            yield low, min(self.shards, low + step)

    def _filters(self, low: int, high: int) -> list[np.ndarray]:
        """The levels' words for a range of shards, at most about BYTES_AT_ONCE."""
        out = [np.zeros((high - low, b // 64), dtype=np.uint64) for b in self.bits]
        if self.words is not None:
            rows = self.words.where(F.col("shard").between(low, high - 1)).toPandas()
            for level, part in rows.groupby("level"):
                at = (part["shard"].to_numpy() - low, part["word"].to_numpy())
                out[level][at] = part["bits"].to_numpy().view(np.uint64)
        return out

    def first_miss(self) -> Column:
        """The first level, from 0, that lacks the key with hashes h1 and h2; their number if none."""
        total = None
        for low, high in self._blocks():
            sent = self.spark.sparkContext.broadcast(self._filters(low, high))
            test = _tester(sent, self.bits, self.shards, low, high)(F.col("h1"), F.col("h2"))
            total = test if total is None else F.greatest(total, test)
        return total

    def listed(self) -> Column:
        """Whether the key is listed; exact for every key of the universe."""
        return self.first_miss() % 2 == 1


def _tester(sent, bits: list[int], shards: int, low: int, high: int):
    @F.pandas_udf("int")
    def test(h1: pd.Series, h2: pd.Series) -> pd.Series:
        a, b = h1.to_numpy(np.int64), h2.to_numpy(np.int64)
        shard = _shards(a, b, shards)
        here = (shard >= low) & (shard < high)
        out = np.where(here, len(bits), -1).astype(np.int32)
        left = np.flatnonzero(here)
        for level, size in enumerate(bits):
            places = _places(a[left], b[left], level, size)
            words = sent.value[level][shard[left] - low, (places >> np.uint64(6)).astype(np.int64)]
            inside = ((words >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)
            out[left[~inside]] = level
            left = left[inside]
        return pd.Series(out)

    return test


def _level_words(keys: DataFrame, level: int, bits: int, shards: int) -> DataFrame:
    """(level, shard, word, bits): the filter of the keys, bits combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.asarray(c) for c in batch.columns)
            if not len(a):
                continue
            places = _places(a, b, level, bits)
            shard = np.tile(_shards(a, b, shards), HASHES).astype(np.uint64)
            slot = shard * np.uint64(bits // 64) + (places >> np.uint64(6)).ravel()
            mask = np.uint64(1) << (places & np.uint64(63)).ravel()
            order = np.argsort(slot, kind="stable")
            found, first = np.unique(slot[order], return_index=True)
            joint = np.bitwise_or.reduceat(mask[order], first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((found // np.uint64(bits // 64)).astype(np.int32)),
                    pa.array((found % np.uint64(bits // 64)).astype(np.int64)),
                    pa.array(joint.view(np.int64)),
                ],
                names=["shard", "word", "bits"],
            )

    return (
        keys.select("h1", "h2")
        .mapInArrow(run, "shard int, word long, bits long")
        .groupBy("shard", "word")
        .agg(F.bit_or("bits").alias("bits"))
        .select(F.lit(level).alias("level"), "shard", "word", "bits")
    )


def build(universe: DataFrame, key: str) -> Cascade:
    """A cascade over universe(key, listed): every key once, listed or not.

    Level 0 holds the listed keys; each next level holds those keys of the other side that passed all
    levels so far, until none does. A key of the universe is then listed exactly if the first level
    that lacks it is an odd one. Without listed keys there is no level and nothing is listed.
    """
    spark = universe.sparkSession
    keys = stage(_hashed(universe.where(F.col(key).isNotNull()), key).select("h1", "h2", "listed"))
    shards = max(1, -(-keys.count() // KEYS_PER_SHARD))
    sides = [keys.where("not listed"), keys.where("listed")]
    cascade = Cascade(spark, shards, [], None)
    inside = sides[1]
    for level in range(LEVEL_LIMIT):
        count = inside.count()
        if not count:
            return cascade
        bits = 64 * (-(-count * BITS_PER_KEY // (64 * shards)) + 1)
        made = stage(_level_words(inside, level, bits, shards), "filter")
        cascade.bits.append(bits)
        cascade.words = made if cascade.words is None else cascade.words.union(made)
        other = sides[level % 2]
        passed = stage(other.where(cascade.first_miss() == level + 1), "passed")
        sides[level % 2] = passed
        inside = passed
    raise RuntimeError("keys of both sides cannot be told apart by their hashes")


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row of pages(page_id, url, …).

    Where no rule fits, the verdict is block if the host is listed and allow otherwise. Listed are
    the hosts of which rules block more pages than they allow; the cascade is built over all hosts
    that occur. Rows without a host are never listed. Equal rows are judged apart, extra
    columns are ignored, an empty table gives no rows.
    """
    rule, verdict = ruled(rules)
    narrow = with_host_and_path(pages.select("page_id", "url"))
    judged = narrow.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    hosts = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(
            (
                F.count_if(F.col("by_rule") == "block") > F.count_if(F.col("by_rule") == "allow")
            ).alias("listed")
        )
    )
    cascade = build(hosts, "host")
    if not cascade.bits:
        listed = F.lit(False)
    else:
        listed = (F.col("host") != "") & cascade.listed()
    return (
        _hashed(judged, "host")
        .withColumn("listed", listed)
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias(
                "verdict"
            ),
            "listed",
        )
    )


ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), pairs AS (
  SELECT DISTINCT p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
    AND starts_with(p.path, r.rule_path)
), best AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS by_rule
  FROM pairs GROUP BY host, path
), hosts AS (
  SELECT host, count(*) FILTER (by_rule = 'block') > count(*) FILTER (by_rule = 'allow') AS listed
  FROM parts JOIN best USING (host, path) WHERE host <> '' GROUP BY host
)
SELECT p.page_id, p.host, p.path, b.rule,
  coalesce(b.by_rule, CASE WHEN h.listed THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(h.listed, false) AS listed
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
  LEFT JOIN hosts h ON p.host = h.host
"""
