import math
import re

import pytest
from pyspark.sql import functions as F

from auricle.functions import scalars as S


def infer(cell):
    """The inference rule in plain Python; the value is given within 64 bits."""
    try:
        if "." in cell:
            return "float", float(cell)
        number = int(cell)
        return "int", number if -(2**63) <= number < 2**63 else None
    except ValueError:
        return "text", None


CELLS = [
    "007", "1e5", "1.5e3", ".5", "5.", "nan", "inf", "1_000", "+5", "-3", " 42 ", "\t7\n",
    "12345678901234567890", "9223372036854775807", "", "abc", "1.5.2", "1,5", ".", "-.5", "1_0.2_5",
    "1__0", "_1", "1_", "1.5f", "1.5d", "0x1F", "1.e5", "-1.25E-2", "٣a", "1 2", " 8 ",
]


@pytest.mark.parametrize("cell", CELLS)
def test_cell_inference(spark, cell):
    df = spark.createDataFrame([(cell,)], "cell STRING")
    row = df.select(
        S.cell_kind("cell").alias("kind"),
        S.cell_int("cell").alias("i"),
        S.cell_float("cell").alias("f"),
    ).first()
    kind, value = infer(cell)
    assert row.kind == kind
    if kind == "int":
        assert row.i == value
    if kind == "float":
        assert math.isclose(row.f, value)


def test_strip_and_blank_agree_with_python(spark):
    texts = ["", " ", "\n\t ", " a b\n", " x ", "\x1cx\x1f", "a\n\nb", "　", "x\r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = df.select("t", S.strip("t").alias("s"), S.is_blank("t").alias("b")).collect()
    assert [(r.s, r.b) for r in got] == [(t.strip(), not t.strip()) for t in texts]


def test_stems(spark):
    names = ["a/b.mp3", ".mp3", "x.tar.gz", "plain", "dir.d/plain", "a.", "..x", "a b.MP3"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = df.select(S.path_stem("n").alias("s"), S.strip_extension("n").alias("e")).collect()
    assert [r.s for r in got] == ["b", ".mp3", "x.tar", "plain", "plain", "a.", ".", "a b"]
    assert got[1].e == ""
    assert [r.e for r in got[2:4]] == ["x.tar", "plain"]


def test_verdict_takes_the_first_digit(spark):
    answers = ["1", " 0", "answer 1", "x", "", None, "01", "2 and 1"]
    df = spark.createDataFrame([(a,) for a in answers], "a STRING")
    got = df.select(S.verdict("a").alias("v")).select("v.*").collect()
    assert [r.flagged for r in got] == [True, False, True, False, False, False, False, True]
    assert {(r.flag_score, r.flag_category) for r in got} == {
        (1.0, "reportable_content"),
        (0.0, None),
    }


def test_blank_text_is_never_flagged(spark):
    df = spark.createDataFrame([("1", "\n"), ("1", None), ("1", "x")], "a STRING, t STRING")
    got = df.select(S.verdict("a", "t").alias("v")).select("v.flagged").collect()
    assert [r.flagged for r in got] == [False, False, True]


def test_prompt_matches_format(spark):
    template = "{{x}} {content_text} {{content_text}} {content_text}"
    text = "a {b} {{c}} $1 \\ {content_text}"
    df = spark.createDataFrame([(template, text)], "p STRING, t STRING")
    assert df.select(S.render_prompt("p", "t")).first()[0] == template.format(content_text=text)


def test_processed_key_falls_back_to_the_id(spark):
    df = spark.createDataFrame([(7, "a.b.mp3"), (8, ""), (9, None)], "id INT, n STRING")
    keys = [r[0] for r in df.select(S.processed_key(F.lit("2025-01-02"), "id", "n")).collect()]
    assert keys == [
        "processed/2025-01-02/a.b.opus",
        "processed/2025-01-02/8.opus",
        "processed/2025-01-02/9.opus",
    ]


def test_batch_id_form_and_repeatability(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-06-22 14:30:52' AS at, 'x.tar' AS n")
    first, again = (df.select(S.batch_id("at", "n")).first()[0] for _ in range(2))
    assert first == again and re.fullmatch(r"20250622-143052-[0-9a-f]{6}", first)


def test_rounding_is_half_up_on_the_decimal(spark):
    df = spark.createDataFrame([(0.0005,), (2.6755,), (1.0045,)], "x DOUBLE")
    got = [str(r[0].quantize(r[0].__class__("0.001"))) for r in df.select(S.round_half_up("x", 3)).collect()]
    assert got == ["0.001", "2.676", "1.005"]


def test_score_range(spark):
    df = spark.createDataFrame([(0.7,), (9.9999999991,), (10.0,), (-11.0,)], "x DOUBLE")
    got = [r[0] for r in df.select(S.as_score("x")).collect()]
    assert got[0] is not None and got[1] is not None and got[2:] == [None, None]
