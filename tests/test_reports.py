from pyspark.sql import functions as F
"""Windows, reports and the transfer cycle on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from auricle import clock
from auricle.operators import aggregates, filters, joins, sets
from auricle.plans import queues, reports, retention, transfer
from auricle.sources.tables import read_table, write_table
from tests.conftest import values

NOW = datetime(2025, 3, 10, 10, 30)


def test_window_bounds_are_strict(rows):
    files = rows(
        "id INT, created_at TIMESTAMP_NTZ",
        [(1, NOW - timedelta(days=7)), (2, NOW - timedelta(days=7) + timedelta(microseconds=1)),
         (3, NOW - timedelta(hours=24)), (4, NOW), (5, None)],
    )
    as_of = clock.at(NOW)
    assert values(clock.recent(files, as_of, "7 DAYS"), "id") == [(2,), (3,), (4,)]
    assert values(clock.recent(files, as_of), "id") == [(4,)]


def test_partitioned_table_prunes_days_and_pushes_the_bound(spark, rows, tmp_path):
    schema = "id BIGINT, created_at TIMESTAMP_NTZ, status STRING"
    data = [(i, NOW - timedelta(days=i % 10), "failed") for i in range(50)]
    write_table(rows(schema, data), str(tmp_path))
    files = read_table(spark, f"file:{tmp_path}", "audio_files")
    recent = clock.recent(files, clock.at(NOW), "48 HOURS").select("id")
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan
    assert "GreaterThan(created_at," in plan
    assert "ReadSchema: struct<id:bigint,created_at:timestamp_ntz>" in plan
    assert recent.count() == 10


def test_by_country_merges_null_and_empty(rows):
    found = rows("country STRING, label_1_pred DOUBLE", [(None, 0.9), ("", 0.7), ("US", 0.7), ("US", 0.69)])
    assert values(aggregates.candidates_by_country(found)) == [("US", 1), ("unknown", 2)]
    row = aggregates.candidate_summary(found).first()
    assert tuple(row) == (4, 3, '{"US":1,"unknown":2}')


def test_summary_of_no_candidates(rows):
    row = aggregates.candidate_summary(rows("country STRING, label_1_pred DOUBLE", [])).first()
    assert tuple(row) == (0, 0, "{}")


def test_coverage_counts_joined_rows(rows):
    files = rows("id INT, archive_source STRING", [(1, "b"), (2, "b"), (3, "c")])
    texts = rows("id INT, audio_file_id INT", [(1, 1), (2, 1)])
    got = values(aggregates.transcript_coverage(files, texts))
    assert got == [("b", 3, 2, 1), ("c", 1, 0, 1)]


def test_details_keep_the_fan_out_inside_the_limit(rows):
    files = rows(
        "id INT, original_filename STRING, status STRING, s3_opus_path STRING, archive_source STRING",
        [(i, f"{i}", "x", None, "b") for i in (1, 2, 3)],
    )
    texts = rows("id INT, audio_file_id INT, transcript_text STRING, language STRING",
                 [(1, 1, "t", "en"), (2, 1, None, "en")])
    flags = rows("id INT, audio_file_id INT, flagged BOOLEAN, flag_score DOUBLE, flag_category STRING", [])
    got = queues.file_details(files, texts, flags, "b%", limit=3).collect()
    assert [(r.id, r.has_transcript) for r in got] == [(1, True), (1, False), (2, False)]


def test_null_plays_come_first(rows):
    files = rows("id INT, original_filename STRING, parquet_metadata STRING",
                 [(1, "a", '{"p":5}'), (2, "b", '{"p":"x"}'), (3, "c", None), (4, "d", '{"p":"12"}')])
    got = [(r.id, r.plays) for r in queues.top_by_metadata(files, "p", 3).collect()]
    assert got == [(2, None), (3, None), (4, 12)]


def test_issues_name_each_problem(rows):
    files = rows("id INT, archive_source STRING, status STRING, original_filename STRING, s3_opus_path STRING",
                 [(1, "b", "pending", "f", None)])
    none = rows("id INT, audio_file_id INT, transcript_text STRING, language STRING", [])
    flags = rows("id INT, audio_file_id INT, flagged BOOLEAN, flag_score DOUBLE, flag_category STRING", [(1, 1, False, 0.0, None)])
    assert values(reports.verify_batch(files, none, flags, "b%")["issues"]) == [("Missing transcripts in b",)]
    assert values(reports.verify_batch(files, none, flags, "z%")["issues"]) == [("No audio files found",)]


@pytest.mark.parametrize("hour,alerts", [(9, 3), (10, 4), (11, 4), (12, 3)])
def test_alert_limits_and_hours(rows, hour, alerts):
    metrics = rows(
        "metric STRING, value BIGINT",
        [("queue:unpack", 101), ("queue:transcribe", 1001), ("old_directories", 1), ("flagged", 199), ("failed", 9)],
    )
    assert reports.health_alerts(metrics, clock.at(NOW.replace(hour=hour))).count() == alerts


def test_limits_themselves_raise_no_alert(rows):
    metrics = rows("metric STRING, value BIGINT",
                   [("queue:unpack", 100), ("queue:transcribe", 1000), ("old_directories", 0), ("flagged", 200)])
    assert reports.health_alerts(metrics, clock.at(NOW)).count() == 0


def test_transfer_outcomes(rows):
    listing = rows(
        "key STRING, length BIGINT, modification_time TIMESTAMP_NTZ",
        [(f"s/{n}.tar", 10, NOW - timedelta(hours=1)) for n in "abcde"] + [("s/f.tar", 10, NOW)],
    )
    now = clock.at(NOW)
    sources = transfer.select_sources(listing, now)
    leased = rows("filename STRING, leased_at TIMESTAMP_NTZ",
                  [("a.tar", NOW - timedelta(minutes=59)), ("b.tar", NOW - timedelta(minutes=60))])
    staged = rows("filename STRING, staged_size BIGINT, local_size BIGINT",
                  [("a.tar", 10, 10), ("b.tar", 10, 12), ("c.tar", 9, 9), ("d.tar", 10, 10)])
    uploaded = rows("filename STRING, uploaded_size BIGINT", [("b.tar", 12), ("c.tar", 9), ("d.tar", 11)])
    audio = rows("filename STRING, meta_id STRING", [("b.tar", "m"), ("b.tar", "m"), ("d.tar", "n")])
    result = transfer.transfer(sources, leased, staged, uploaded, now, True, audio)
    assert values(result.manifest, "filename", "outcome") == [
        ("a.tar", "leased"), ("b.tar", "queued"), ("c.tar", "staging_mismatch"),
        ("d.tar", "upload_mismatch"), ("e.tar", "staging_mismatch"),
    ]
    assert values(result.totals) == [(1, 4)]
    assert values(result.deletable) == [("archive", "s/b.tar"), ("metadata", "metadata/m.txt")]
    kept = transfer.transfer(sources, leased, staged, uploaded, now)
    assert kept.deletable.count() == 0 and kept.jobs.count() == 1


def test_plans_of_deletion(rows):
    listing = rows("key STRING, length BIGINT, modification_time TIMESTAMP_NTZ",
                   [("archives/", 0, NOW), ("archives/x.tar", 1, NOW - timedelta(minutes=1441)),
                    ("processed/", 0, NOW), ("y", 2, NOW - timedelta(minutes=1440, seconds=59))])
    assert values(retention.bucket_clear(listing, True)) == [("archives/x.tar", "delete"), ("y", "delete")]
    assert values(retention.expired_scratch(listing, clock.at(NOW)), "key") == [("archives/x.tar",)]


def test_sizes_and_differences(rows):
    manifest = rows("k INT, source_size BIGINT, staged_size BIGINT, uploaded_size BIGINT",
                    [(1, 5, 5, 5), (2, None, None, None), (3, 5, 5, None), (4, 5, 4, 4)])
    assert values(joins.reconcile_sizes(manifest), "k", "size_check") == [
        (1, "verified"), (2, "staging_mismatch"), (3, "upload_mismatch"), (4, "staging_mismatch"),
    ]
    need, have = rows("n STRING", [("a",), ("a",), ("b",)]), rows("n STRING", [("b",)])
    assert values(sets.missing_names(need, have, "n")) == [("a",)]


def test_split_valid(rows):
    good, bad = filters.split_valid(rows("a INT, b INT", [(1, 1), (None, 1), (1, None)]), ["a", "b"])
    assert (good.count(), bad.count()) == (1, 2)


def test_stuck_batches(rows):
    progress = rows("batch_id STRING, processed INT, total INT, first_seen TIMESTAMP_NTZ",
                    [("old", 1, 2, NOW - timedelta(minutes=121)), ("edge", 1, 2, NOW - timedelta(minutes=120)),
                     ("done", 2, 2, NOW - timedelta(days=1)), ("none", 1, None, NOW - timedelta(days=1))])
    assert values(reports.stuck_batches(progress, clock.at(NOW)), "batch_id") == [("old",)]


def test_child_bound_reaches_the_scan(spark, tmp_path):
    from auricle.operators import filters

    rows = spark.range(1_000_000).select(F.col("id").alias("audio_file_id"), F.rand(1).alias("x"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(f"{tmp_path}/c")
    spark.range(990_000, 1_000_000).write.parquet(f"{tmp_path}/f")
    child, files = spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/f")
    bounded = filters.within_ids(child, files)
    assert bounded.count() == 10_000
    scan = bounded._jdf.queryExecution().executedPlan()
    while "Scan" not in scan.nodeName():
        scan = scan.executedPlan() if "Adaptive" in scan.nodeName() else scan.children().apply(0)
    bounded._jdf.collectToPython()
    assert scan.metrics().apply("numOutputRows").value() < 300_000
