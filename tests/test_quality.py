from datetime import datetime

from pyspark.sql import functions as F

from auricle.operators import changes, quality as Q
from auricle.operators.ids import assign_ids
from tests.conftest import values


def test_review_rules_one_violation_each(rows):
    schema = (
        "meta_id STRING, year INT, month INT, day INT, transcript STRING, label_1_pred DOUBLE, "
        "country STRING, lang STRING, queue_status STRING, review_status STRING"
    )
    good = ("ok", 2025, 1, 31, "t", 0.5, "US", "en", "queued", "unreviewed")
    names = [c.split()[0] for c in schema.split(", ")]

    def but(key, **change):
        return tuple({**dict(zip(names, good)), "meta_id": key, **change}.values())

    data = [
        good,
        but("status", queue_status="odd"),
        but("month", month=13),
        but("day", day=0),
        but("year", year=None),
        but("text", transcript=None),
        but("score", label_1_pred=10.0),
        but("country", country="x" * 51),
        but("lang", lang="x" * 21),
        but("nulls", queue_status=None, country=None, label_1_pred=None, lang=None),
    ]
    got = values(Q.check_table(rows(schema, data), "transcripts"))
    assert got == sorted(
        [
            ("status", "domain:queue_status"), ("month", "range:month"), ("day", "range:day"),
            ("year", "required:year"), ("text", "required:transcript"),
            ("score", "decimal:label_1_pred"), ("country", "length:country"), ("lang", "length:lang"),
        ],
        key=repr,
    )


def test_config_ranges(rows):
    df = rows(
        "config_id INT, config_name STRING, label_threshold DOUBLE, treatment_split DOUBLE, "
        "queue_size_per_ra INT, min_items_per_stratum INT, is_active BOOLEAN",
        [(1, "a", 0.0, 1.0, 1, 0, True), (2, "b", 1.1, -0.1, 0, -1, True), (3, "c", None, None, None, None, None)],
    )
    got = [r for _, r in values(Q.check_table(df, "experiment_config"))]
    assert got == [
        "range:label_threshold", "range:min_items_per_stratum", "range:queue_size_per_ra",
        "range:treatment_split",
    ]
    assert values(Q.more_than_one(df, F.col("is_active"))) == [(2,)]
    assert Q.more_than_one(df.filter("config_id <> 2"), F.col("is_active")).count() == 0


def test_unique_ignores_nulls(rows):
    df = rows("user_id INT, email STRING, username STRING", [(1, None, "a"), (2, None, "a"), (3, "e", "b")])
    found = [values(d) for d in Q.check_uniques(df, "users")]
    assert found == [[], [], [("a", 2)]]
    assert values(Q.null_keys(df, ["user_id", "email"])) == [(1, None), (2, None)]


def test_delete_effects(rows):
    review = rows("meta_id STRING, creator_id INT", [("a", 1), ("b", 2), ("c", None)])
    gone = rows("creator_id INT", [(1,)])
    assert values(Q.delete_effect(review, "transcripts", "creator_id", gone)) == [
        ("a", None), ("b", 2), ("c", None),
    ]
    backlog = rows("backlog_id INT, meta_id STRING", [(1, "a"), (2, "b"), (3, None)])
    dead = rows("meta_id STRING", [("a",)])
    assert values(Q.delete_effect(backlog, "backlog", "meta_id", dead)) == [(2, "b"), (3, None)]
    tasks = rows("assignment_id INT, user_id INT", [(1, 7)])
    users = rows("user_id INT", [(7,), (8,)])
    assert values(Q.delete_effect(tasks, "queue_assignments", "user_id", users)) == [(7,)]


def test_every_foreign_key_names_known_tables():
    for child, _, parent, key, effect in Q.FOREIGN_KEYS:
        assert child in Q.RULES and parent in Q.RULES
        assert [key] in Q.RULES[parent].unique
        assert effect in ("none", "cascade", "set_null", "restrict")


def test_ids_follow_the_order_over_partitions(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(7)
    got = assign_ids(df, ["k"], 50).orderBy("k").collect()
    assert [r.id for r in got] == list(range(51, 1051))


def test_ids_of_an_empty_frame(spark):
    assert assign_ids(spark.createDataFrame([], "k STRING"), ["k"]).count() == 0


AT = [datetime(2025, 1, d) for d in range(1, 5)]


def test_updates_take_the_newest_event(rows):
    files = rows("id INT, status STRING, processed_at TIMESTAMP_NTZ", [(1, "pending", None), (2, "pending", AT[0])])
    events = rows(
        "id INT, status STRING, at TIMESTAMP_NTZ, seq INT",
        [(1, "failed", AT[1], 2), (1, "flagged", AT[2], 1), (9, "failed", AT[1], 1)],
    )
    assert values(changes.apply_status(files, events)) == [(1, "failed", AT[1]), (2, "pending", AT[0])]
    assert values(changes.matched_updates(events, files)) == [(1, True), (9, False)]


def test_metadata_update_may_clear_columns(rows):
    files = rows(
        "id INT, parquet_lang STRING, parquet_country STRING, parquet_metadata STRING",
        [(1, "en", "US", "{}")],
    )
    events = rows("id INT, metadata STRING, seq INT", [(1, '{"lang":"fr","x":1}', 1)])
    assert values(changes.apply_metadata(files, events)) == [(1, "fr", None, '{"lang":"fr","x":1}')]


def test_delete_batch_keeps_files_without_batch(rows):
    files = rows("id INT, archive_source STRING", [(1, "x"), (2, None), (3, "y")])
    child = rows("id INT, audio_file_id INT", [(1, 1), (2, 2), (3, None)])
    left = changes.delete_batch(files, child, child, "x")
    assert [values(f, "id") for f in left] == [[(2,), (3,)], [(2,), (3,)], [(2,), (3,)]]
