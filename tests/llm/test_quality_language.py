import random
import zlib

import numpy as np

from auricle.llm import language, quality
from tests.llm.conftest import ENGLISH, FRENCH, ODD_IDS, ids

WORDS = (ENGLISH + FRENCH).split()


def corpus(count, seed=1):
    rng = random.Random(seed)
    rows, marks = [], []
    for k in range(count):
        words = rng.choices(WORDS, k=rng.randint(20, 200))
        good = rng.random() < 0.7
        if not good:
            junk = rng.choice(["!!", "%%%", "|"])
            words = [w.upper() + junk for w in words]
        rows.append((k, " ".join(words), "en"))
        marks.append((k, int(good), 0))
    return rows, marks


def test_isotonic_is_the_least_squares_rising_fit():
    rng = np.random.default_rng(0)
    at, value, weight = np.arange(40.0), rng.random(40), rng.integers(1, 5, 40).astype(float)
    centre, level = quality.isotonic(at, value, weight)
    assert (np.diff(level) > 0).all() and (np.diff(centre) > 0).all()
    best = [
        max(
            min(
                np.average(value[a : b + 1], weights=weight[a : b + 1]) for b in range(k, 40)
            )
            for a in range(k + 1)
        )
        for k in range(40)
    ]
    assert np.allclose(sorted(set(np.round(best, 9))), np.round(level, 9))


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    model = quality.Model(
        np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS),
        rng.normal(size=(quality.STATISTICS, 4096)) / 3, rng.uniform(0, 2 * np.pi, 4096),
        np.zeros(4097), np.zeros(1), np.zeros(1),
    )
    x = rng.normal(size=(12, quality.STATISTICS))
    z = model.mapped(x)[:, :-1]
    gap = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-gap / 18)).max() < 0.1


def test_held_out_quality(docs, labels):
    rows, marks = corpus(400)
    found = quality.scores(docs(rows), labels(marks)).collect()
    truth = {k: q for k, q, _ in marks}
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(docs, labels):
    rows, marks = corpus(120)
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q, t) for k, q, t in marks]
    other = [(k, t, "fr") for k, t, _ in rows]
    a = quality.scores(docs(rows), labels(marks)).select("doc_id", "score").collect()
    b = quality.scores(docs(other), labels(flipped)).select("doc_id", "score").collect()
    assert np.allclose([r[1] for r in sorted(a)], [r[1] for r in sorted(b)], atol=1e-6)


def test_quality_of_odd_rows(odd, empty, labels):
    marks = labels([(1, 1, 0), (6, 0, 0), (6, 1, 0), (8, None, 0), (None, 1, 0), (77, 0, 1)])
    found = quality.scores(odd, marks)
    assert ids(found) == ODD_IDS
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert quality.scores(empty, marks).collect() == []
    assert {r["score"] for r in quality.scores(odd, labels([])).collect()} == {1.0}
    kept = quality.accepted(odd, labels([]))
    assert ids(kept) == ODD_IDS and kept.columns == odd.columns


def test_accepted_drops_what_is_rejected(docs, labels):
    rows, marks = corpus(200)
    kept = set(ids(quality.accepted(docs(rows), labels(marks))))
    good = {k for k, q, _ in marks if q}
    assert len(kept & good) >= 0.97 * len(good)
    assert len(kept - good) <= 0.05 * len(kept)


def lingual(count):
    rng = random.Random(9)
    rows = []
    for k in range(count):
        lang = rng.choice(["en", "fr"])
        words = (ENGLISH if lang == "en" else FRENCH).split()
        rows.append((k, " ".join(rng.choices(words, k=rng.randint(12, 60))), lang))
    return rows


def test_held_out_language(docs):
    frame = docs(lingual(200))
    found = language.languages(frame, language.learn(frame)).collect()
    truth = {k: g for k, _, g in lingual(200)}
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_narrow_margins_are_rejected():
    judge = language.Classifier({"en": (ENGLISH * 20).encode(), "fr": (FRENCH * 20).encode()})
    assert judge.decide("the children were playing in the garden")[0::2] == ("en", False)
    assert judge.decide("les enfants jouaient dans le jardin")[0::2] == ("fr", False)
    assert judge.decide("xq")[2]
    assert judge.decide("12 !? \n")[0] == "und"


def test_language_of_odd_rows(odd, empty, docs):
    found = language.languages(odd, language.learn(odd))
    assert ids(found) == ODD_IDS
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 for k in (3, 4, 5))
    assert all(0 <= r["score"] <= 1 for r in by_id.values())
    assert language.languages(empty, language.learn(empty)).collect() == []
    nothing = docs([(1, "some text", None)])
    assert language.languages(nothing, language.learn(nothing)).first()["lang_pred"] == "und"


def test_normal_equations_are_those_of_one_machine(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, quality.STATISTICS)), rng.integers(0, 2, 500).astype(float)
    rows = [([float(v) for v in a], float(b)) for a, b in zip(x, y)]
    frame = spark.createDataFrame(rows, "x array<double>, y double").repartition(7)

    def equations(a, b):
        wide = np.hstack([np.tile(a, 6), b[:, None]])
        return wide.T @ wide

    got = quality._summed(frame, equations)
    assert len(got) > quality.CHUNK  # more than one chunk
    np.testing.assert_allclose(got, equations(x, y).ravel(), rtol=1e-9, atol=1e-9)
    assert len(quality._summed(frame.where("y > 5"), equations)) == 0
