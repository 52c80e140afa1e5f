import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auricle.operators import scoring
from auricle.plans import score
from tests.conftest import values

SEGMENTS = "audio_file_id BIGINT, idx INT, text STRING, avg_logprob DOUBLE"


def test_assembly_rules(rows):
    segments = rows(
        SEGMENTS,
        [
            (1, 2, " b\n", -1.0), (1, 0, "\na ", -2.0), (1, 1, "", None),
            (2, 0, "x", None), (2, 1, None, None),
            (3, 0, "y", -9.0),
            (4, 0, "z", 3.0),
        ],
    )
    files = rows("audio_file_id BIGINT, language STRING", [(i, "en" if i == 1 else None) for i in range(1, 6)])
    got = values(scoring.assemble_transcripts(segments, files))
    assert got == [
        (1, "a  b", "en", pytest.approx(0.7)),
        (2, "x ", "unknown", 1.0),
        (3, "y", "unknown", 0.0),
        (4, "z", "unknown", 1.0),
        (5, "", "unknown", 0.0),
    ]


def test_array_form_agrees(rows):
    df = rows(
        "k INT, segments ARRAY<STRUCT<text: STRING, avg_logprob: DOUBLE>>",
        [(1, [(" a ", -1.0), ("", None), ("b", -2.0)]), (2, []), (3, None), (4, [("x", None)])],
    )
    got = df.select(
        scoring.transcript_text("segments"), scoring.transcript_confidence("segments")
    ).collect()
    assert [tuple(r) for r in got] == [("a  b", pytest.approx(0.7)), ("", 0.0), (None, 0.0), ("x", 1.0)]


def test_a_file_with_very_many_segments(spark):
    segments = spark.range(5000).select(
        F.lit(1).cast("long").alias("audio_file_id"),
        F.col("id").cast("int").alias("idx"),
        F.col("id").cast("string").alias("text"),
        F.lit(-1.0).alias("avg_logprob"),
    ).repartition(8)
    row = scoring.assemble_transcripts(segments).first()
    assert row.text == " ".join(str(i) for i in range(5000)) and row.confidence == pytest.approx(0.8)


def counting_load():
    """Returns a model that reports its load count and its slice sizes."""
    import sys

    sys.modules["_loads"] = sys.modules.get("_loads") or type("M", (), {"n": 0})
    sys.modules["_loads"].n += 1
    loads = sys.modules["_loads"].n

    def model(pdf):
        if (pdf["id"] == 13).any():
            raise ValueError("unlucky")
        return pd.DataFrame({"size": [len(pdf)] * len(pdf), "loads": loads})

    return model


def test_harness_slices_loads_once_and_isolates_failures(spark):
    df = spark.range(0, 200, 1, 4)
    got = scoring.score_rows(df, counting_load, "size INT, loads INT", "counting", 32).collect()
    assert len(got) == 200 and max(r.size or 0 for r in got) <= 32
    assert all(r.loads == 1 for r in got if r.id != 13)
    bad = [r for r in got if r.error]
    assert [(r.id, r.size, r.error) for r in bad] == [(13, None, "ValueError: unlucky")]


def test_jobs_to_tables(spark, rows, tmp_path):
    jobs = rows(
        "batch_id STRING, opus_path STRING, original_filename STRING, parquet_metadata STRING",
        [
            ("b1", "/s/a.opus", "a.mp3", '{"lang":"en","country":"US"}'),
            ("b1", "/s/b.opus", "b.mp3", "{}"),
            ("b2", "/s/c.opus", "", None),
            ("b2", "/s/bad.opus", "bad.mp3", None),
        ],
    )

    def load_ears():
        def hear(pdf):
            if (pdf["opus_path"] == "/s/bad.opus").any():
                raise RuntimeError("unreadable")
            texts = {"/s/a.opus": "hit", "/s/b.opus": "  ", "/s/c.opus": "miss"}
            return pd.DataFrame(
                {
                    "segments": [[{"text": texts[p], "avg_logprob": -1.0}] for p in pdf["opus_path"]],
                    "language": None,
                }
            )

        return hear

    def load_judge():
        def judge(pdf):
            assert pdf["prompt"].str.strip().str.len().gt(0).all()
            return pd.DataFrame({"response": ["1" if "hit" in p else "0" for p in pdf["prompt"]]})

        return judge

    scored = score.score_jobs(
        jobs, ("ears", load_ears), ("judge", load_judge), F.lit("P {content_text}"), partitions=2
    )
    path = f"{tmp_path}/scored"
    for _ in range(2):  # a rerun replaces its batches
        score.write_scored(scored, path)
    written = score.read_scored(spark, path, scored)
    assert written.count() == 4
    sizes = rows("key STRING, length BIGINT", [("/s/a.opus", 77)])
    now = F.expr("TIMESTAMP_NTZ'2025-01-02 03:04:05'")
    tables = score.result_tables(written, sizes, now, (100, 200, 300))
    assert values(
        tables.files, "id", "opus_path", "s3_opus_path", "file_size_bytes", "status", "parquet_country"
    ) == [
        (101, "/s/a.opus", "processed/2025-01-02/a.opus", 77, "flagged", "US"),
        (102, "/s/b.opus", "processed/2025-01-02/b.opus", 0, "transcribed", None),
        (103, "/s/c.opus", "processed/2025-01-02/103.opus", 0, "transcribed", None),
    ]
    assert values(tables.transcripts, "id", "audio_file_id", "transcript_text", "language") == [
        (201, 101, "hit", "unknown"), (202, 102, "", "unknown"), (203, 103, "miss", "unknown"),
    ]
    assert values(tables.classifications, "id", "flagged", "flag_score", "flag_category") == [
        (301, True, 1.0, "reportable_content"), (302, False, 0.0, None), (303, False, 0.0, None),
    ]
    assert values(tables.progress) == [("b1", 2), ("b2", 2)]
    assert values(written.filter(~F.col("success")), "opus_path", "status") == [("/s/bad.opus", "failed")]


def test_payloads_lie_in_date_folders(spark, rows, tmp_path):
    df = rows("date STRING, key STRING, content BINARY", [("2025-01-02", "k", bytearray(b"x"))])
    score.write_payloads(df, f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p/date=2025-01-02").first().key == "k"


def test_scored_rows_are_sent_on_in_small_frames():
    class Frame:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("need", T.LongType())])

        def mapInPandas(self, run, schema):
            return run

    rows = pd.DataFrame({"id": range(10_000), "need": [None if k % 3 else k for k in range(10_000)]})
    run = scoring.score_rows(
        Frame(), lambda: lambda part: pd.DataFrame({"n": part["id"]}), "n BIGINT", "small frames", needs="need"
    )
    frames = list(run(iter([rows])))
    assert max(map(len, frames)) <= scoring.SEND_ROWS
    got = pd.concat(frames).sort_values("id")
    assert got["id"].tolist() == list(range(10_000))
    assert got["n"].dropna().tolist() == list(range(0, 10_000, 3))
