"""The set-based sync against a loop that walks the candidates one by one."""

import random
from datetime import datetime, timedelta

import pytest

from auricle import clock
from auricle.operators import ranking
from auricle.plans import sync
from tests.conftest import values

NOW = datetime(2025, 1, 2, 12)
FILES = (
    "id BIGINT, opus_path STRING, original_filename STRING, status STRING, parquet_lang STRING, "
    "parquet_country STRING, parquet_metadata STRING, synced_to_ra BOOLEAN, created_at TIMESTAMP_NTZ, "
    "synced_at TIMESTAMP_NTZ"
)
TEXTS = "id BIGINT, audio_file_id BIGINT, transcript_text STRING, created_at TIMESTAMP_NTZ"
FLAGS = (
    "id BIGINT, audio_file_id BIGINT, flagged BOOLEAN, flag_score DOUBLE, flag_category STRING, "
    "created_at TIMESTAMP_NTZ"
)


def walk(ranked):
    """Outcomes by a loop: insert, skip or fail one candidate after the other."""
    present, out = set(m for m, _, _, known in ranked if known), []
    for meta_id, rk, valid, _ in sorted(ranked, key=lambda r: r[1]):
        if meta_id in present:
            out.append((rk, "skipped"))
        elif valid:
            present.add(meta_id)
            out.append((rk, "synced"))
        else:
            out.append((rk, "error"))
    return out


def test_outcomes_equal_the_loop_on_random_cases(spark):
    rng = random.Random(7)
    data, expected = [], {}
    for case in range(300):
        known = {f"{case}-m{i}" for i in range(5) if rng.random() < 0.2}
        ranked = []
        for rk in range(1, rng.randint(2, 12)):
            meta = f"{case}-m{rng.randrange(5)}"
            ranked.append((meta, rk, rng.random() < 0.6, meta in known))
        data += [(case, *r) for r in ranked]
        expected[case] = walk(ranked)
    frame = spark.createDataFrame(
        data, "case INT, meta_id STRING, rk INT, valid BOOLEAN, exists_already BOOLEAN"
    )
    got = {}
    for r in ranking.label_outcomes(frame).collect():
        got.setdefault(r.case, []).append((r.rk, r.outcome))
    assert {c: sorted(o) for c, o in got.items()} == {c: sorted(o) for c, o in expected.items()}


def make(rows, items):
    """items: (id, meta, author, country, text, score, synced)"""
    files, texts, flags = [], [], []
    for id_, meta, author, country, text, score, synced in items:
        pairs = [("meta_id", meta), ("author_uniqueid", author)]
        doc = "{" + ",".join(f'"{k}":"{v}"' for k, v in pairs if v is not None) + "}"
        at = NOW - timedelta(hours=id_)
        files.append((id_, f"/o/{id_}", f"{id_}.mp3", "flagged", "en", country, doc, synced, at, None))
        texts.append((id_ * 10, id_, text, at))
        flags.append((id_ * 100, id_, True, score, "reportable_content", at))
    return rows(FILES, files), rows(TEXTS, texts), rows(FLAGS, flags)


REVIEW = "meta_id STRING"
CREATORS = "creator_id BIGINT, author_uniqueid STRING, created_at TIMESTAMP_NTZ"


def plan(rows, items, known=("old",), creators=((5, "ann"),), **options):
    tables = make(rows, items)
    return sync.plan_sync(
        *tables,
        rows(REVIEW, [(m,) for m in known]),
        rows(CREATORS, [(c, a, NOW) for c, a in creators]),
        clock.at(NOW),
        **options,
    )


def test_errors_skips_and_ties(rows):
    items = [
        (1, "a", "ann", "US", None, 0.9, False),  # no text: error, before the valid one
        (2, "a", "bob", "US", "t", 0.8, False),  # synced
        (3, "a", "bob", "US", "t", 0.7, False),  # skipped: came later
        (4, "old", "cid", "US", "t", 0.95, False),  # skipped: there before
        (5, "b", "dan", "x" * 51, "t", 0.9, False),  # error: country too long
        (6, "c", "eve", "US", "t", 10.0, False),  # error: score does not fit
        (7, "d", None, "US", "t", 0.75, False),  # synced without creator
        (8, "e", "ann", "US", "t", 0.69, False),  # below the threshold
        (9, "f", "ann", "US", "t", 0.9, True),  # synced before
        (10, None, "ann", "US", "t", 0.9, False),  # no id
        (11, "g", "y" * 101, "US", "t", 0.9, False),  # error: author too long
    ]
    result = plan(rows, items)
    assert values(result.outcomes, "audio_file_id", "outcome") == sorted(
        [
            (1, "error"), (2, "synced"), (3, "skipped"), (4, "skipped"), (5, "error"),
            (6, "error"), (7, "synced"), (11, "error"),
        ],
        key=repr,
    )
    assert tuple(result.summary.first()) == (2, 2, 4)
    assert values(result.creators, "creator_id", "author_uniqueid") == [(6, "bob")]
    assert values(result.review_rows, "meta_id", "creator_id") == [("a", 6), ("d", None)]
    assert values(result.file_events, "id") == sorted([(2,), (3,), (4,), (7,)], key=repr)


def test_limit_takes_best_scores_then_lowest_ids(rows):
    items = [(i, f"m{i}", "ann", "US", "t", 0.8 + (i % 2) / 10, False) for i in range(1, 8)]
    result = plan(rows, items, limit=5)
    assert values(result.outcomes, "rk", "audio_file_id") == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 2)]


def test_written_runs_replace_themselves(rows, spark, tmp_path):
    result = plan(rows, [(1, "a", "ann", "US", "t", 0.9, False)])
    for _ in range(2):
        sync.write_sync(result, str(tmp_path), "1")
    assert spark.read.parquet(f"{tmp_path}/transcripts").count() == 1


UNIFIED = FILES + ", meta_id STRING"


def by_name(rows, names, known=()):
    at = NOW
    files = [
        (i, f"/o/{i}", n, "classified", "en", "US", "{}", False, at, None, m)
        for i, (n, m) in enumerate(names, 1)
    ]
    texts = rows(
        TEXTS + ", language STRING, confidence DOUBLE",
        [(i, i, "t", at, "en", 0.5) for i in range(1, len(names) + 1)],
    )
    flags = rows(FLAGS, [(i, i, True, 1.0, None, at) for i in range(1, len(names) + 1)])
    return sync.plan_sync_by_name(
        rows(UNIFIED, files), texts, flags, rows(REVIEW, [(m,) for m in known]), 10
    )


def test_name_sync_counts_known_ids_too(rows):
    result = by_name(rows, [("a.mp3", None), ("b.c.mp3", None), (".mp3", None)], known=["a"])
    assert tuple(result.summary.first()) == (3, ["a", "b.c", ""])
    assert values(result.review_rows, "meta_id") == [("",), ("b.c",)]
    assert values(result.file_updates, "id", "meta_id") == [(1, "a"), (2, "b.c"), (3, "")]


@pytest.mark.parametrize(
    "names", [[("a.mp3", None), ("a.opus", None)], [("a.mp3", None), ("z.mp3", "a")]]
)
def test_name_sync_fails_on_a_repeated_id(rows, names):
    with pytest.raises(ValueError):
        by_name(rows, names)
