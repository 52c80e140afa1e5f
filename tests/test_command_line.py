"""The command line over a small folder of tables."""

import auricle.__main__ as cli
from auricle.sources.tables import write_table
from tests.test_sync import CREATORS, NOW, make


def prepare(rows, root):
    items = [(i, f"m{i}", f"u{i}", "US", "t", 0.6 + i / 10, False) for i in (1, 2, 3)]
    names = ("audio_files", "pipeline_transcripts", "pipeline_classifications")
    for name, frame in zip(names, make(rows, items)):
        write_table(frame, f"{root}/{name}")
    review = rows("meta_id STRING, created_at TIMESTAMP_NTZ", [("m2", NOW)])
    write_table(review, f"{root}/transcripts", order="meta_id")
    write_table(rows(CREATORS, [(4, "u1", NOW)]), f"{root}/creators", order="creator_id")


def call(spark, *words):
    cli.run(spark, cli._parser().parse_args(words))


def test_commands(spark, rows, tmp_path, capsys):
    root = f"file:{tmp_path}"
    prepare(rows, root)
    call(spark, "stats", "--root", root)
    call(spark, "verify-batch", "--root", root, "--pattern", "b%")
    call(spark, "verify-recent", "--root", root, "--hours", "48")
    call(spark, "overall", "--root", root)
    call(spark, "clear-plan", "--root", root)
    call(spark, "transfer-plan", "--root", root)
    call(spark, "sync", "--root", root, "--dry-run")
    text = capsys.readouterr().out
    assert "No audio files found" in text and "dry run" in text and '{"US":3}' in text
    assert not (tmp_path / "sync").exists()
    call(spark, "sync", "--root", root)
    written = spark.read.parquet(f"{root}/sync/transcripts").orderBy("meta_id").collect()
    assert [(r.meta_id, r.creator_id) for r in written] == [("m1", 4), ("m3", 5)]


def test_sync_goes_on_from_earlier_runs(spark, rows, tmp_path):
    root = f"file:{tmp_path}"
    prepare(rows, root)
    for _ in range(4):
        call(spark, "sync", "--root", root, "--limit", "1")
    written = spark.read.parquet(f"{root}/sync/transcripts").orderBy("meta_id").collect()
    assert [(r.meta_id, r.creator_id) for r in written] == [("m1", 4), ("m3", 5)]
    events = spark.read.parquet(f"{root}/sync/sync_events")
    assert sorted(r.id for r in events.collect()) == [1, 2, 3]


def test_whole_results_are_written(spark, rows, tmp_path, capsys):
    root = f"file:{tmp_path}"
    prepare(rows, root)
    call(spark, "clear-plan", "--root", root, "--out", f"{root}-plan")
    shown = capsys.readouterr().out
    count = spark.read.parquet(f"{root}-plan/objects").count()
    assert count and f"objects: {count} rows, written to" in shown
