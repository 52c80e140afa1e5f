"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, other columns."""

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, bits string, score string, length string, words string, x string, n string"
)


def full(rows):
    """(doc_id, text, lang) rows with columns whose names the operators use themselves."""
    return [
        (k, t, g, "src", None if t is None else len(t), "r", "b", "s", "l", "w", "x", "n")
        for k, t, g in rows
    ]


ENGLISH = "the house is near the river and the children were playing with their dog in the garden "
FRENCH = "la maison est pres de la riviere et les enfants jouaient avec leur chien dans le jardin "
ODD = [
    (1, ENGLISH * 3, "en"),
    (2, ENGLISH * 3, "en"),
    (3, None, "en"),
    (4, "", None),
    (5, "  \n\t ", "fr"),
    (6, FRENCH * 3, "fr"),
    (6, FRENCH * 3, "fr"),
    (None, "a row without an id but with a text", None),
    (8, "one", "en"),
    (9, "Élan ßtraße 日本語 \U0001f600 ok", "fr"),
    (10, "word " * 30_000, "en"),
    (11, "a" * 60_000, "en"),
    (12, "7 " * 20_000 + "1.2.3." * 5_000 + "a.b" * 5_000 + "@", None),
]


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame(full(rows), SCHEMA)


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def empty(docs):
    return docs([])


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, score string")


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda k: (k is None, k or 0))


ODD_IDS = sorted((k for k, _, _ in ODD), key=lambda k: (k is None, k or 0))
