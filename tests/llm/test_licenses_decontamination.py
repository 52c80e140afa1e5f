import random
import textwrap

import numpy as np

from auricle.llm import decontamination, licenses
from auricle.llm.registry import QUERIES
from tests.llm.conftest import ENGLISH, ODD

SF = "/root/testdata/sf0.01"


def test_known_notices_are_found_and_nothing_else(docs):
    texts = [t for family in licenses.TEMPLATES.values() for t in family]
    rows = [(k, f"{ENGLISH}\n{t}\n{ENGLISH}", "en") for k, t in enumerate(texts)]
    rows += [(1000 + k, t, "en") for k, t in enumerate(licenses.OTHERS)]
    rows += [(2000 + k, ENGLISH * (k + 1) + "\n" + ENGLISH, "en") for k in range(40)]
    found = licenses.licenses(docs(rows)).collect()
    family = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts}
    assert {(r["doc_id"], r["family"]) for r in found} == {(k, family[t]) for k, t in enumerate(texts)}
    assert {r["paragraph"] for r in found} == {1}


def test_wrapped_and_embedded_notices_are_found(docs):
    family = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts}
    texts = list(family)
    rows = []
    for k, t in enumerate(texts):
        for turn, width in enumerate((30, 70)):
            lines = textwrap.wrap(t, width)
            rows.append((10 * k + turn, f"{ENGLISH}\n\n" + "\n".join(f" * {line}" for line in lines) + f"\n\n{ENGLISH}", "en"))
        rows.append((10 * k + 2, f"{ENGLISH * 4}{t} {ENGLISH * 4}", "en"))
        rows.append((10 * k + 3, textwrap.fill(f"{ENGLISH}{t} {ENGLISH * 2}", 72), "en"))
    rows += [(9000 + k, textwrap.fill(f"{ENGLISH}{t} {ENGLISH}", 60), "en") for k, t in enumerate(licenses.OTHERS)]
    rows.append((9500, f"{ENGLISH * 2}{texts[0]} {ENGLISH * 3}{texts[3]} {ENGLISH}", "en"))
    found = licenses.licenses(docs(rows)).collect()
    want = {(10 * k + turn, family[t]) for k, t in enumerate(texts) for turn in range(4)}
    want |= {(9500, family[texts[0]]), (9500, family[texts[3]])}
    assert {(r["doc_id"], r["family"]) for r in found} == want
    assert {r["paragraph"] for r in found if r["doc_id"] < 9000 and r["doc_id"] % 10 < 2} == {2}
    assert {r["paragraph"] for r in found if r["doc_id"] == 9500 or r["doc_id"] % 10 == 2} == {0}


def test_notices_of_the_test_table(spark):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    }
    want = {
        (r["doc_id"], k, lines[line])
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
        for k, line in enumerate(r["text"].split("\n"))
        if line in lines
    }
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in QUERIES["op4_licenses"](spark, SF).collect()}
    assert got == want


def test_licenses_of_odd_rows(odd, empty):
    assert licenses.licenses(odd).collect() == []
    assert licenses.licenses(empty).collect() == []


def common(left, right):
    table = np.zeros((len(left) + 1, len(right) + 1), dtype=int)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_common_length():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(0, 30)), rng.integers(0, 6, rng.integers(0, 40))
        assert decontamination.common_length(a, b) == common(a, b)


def test_leaks_whole_changed_and_absent(docs, benchmark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "rt", "sk", "ll", "m", "x")]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, prose(rng.randint(12, 60)), "s") for k in range(40)]
    rows, want = [], set()
    for k in range(400):
        before, after = prose(rng.randint(0, 300)), prose(rng.randint(0, 300))
        text = f"{before} {after}"
        if k % 4 == 0:
            item = items[k % 40]
            text = f"{before} {item[1].upper() if k % 8 else item[1] + '!'} {after}"
            want.add((k, item[0]))
        elif k % 4 == 1:  # a paraphrase: a tenth of the words changed
            item = items[k % 40]
            words = item[1].split()
            for at in rng.sample(range(len(words)), len(words) // 10):
                words[at] = "other"
            text = f"{before} {' '.join(words)} {after}"
            want.add((k, item[0]))
        rows.append((k, text, "en"))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs(rows), benchmark(items)).collect()}
    assert len(got & want) >= 0.98 * len(want)
    assert got <= want
    clean = decontamination.clean(docs(rows), benchmark(items))
    assert {r["doc_id"] for r in clean.collect()} == set(range(400)) - {k for k, _ in got}


def test_answer_decides_between_the_shares(docs, benchmark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    words = item.split()
    kept = " ".join("zzz" if k in (1, 3, 5, 7, 9) else w for k, w in enumerate(words))
    lost = " ".join("zzz" if k in (1, 3, 5, 7, 15) else w for k, w in enumerate(words))
    found = decontamination.leaks(docs([(1, kept, None), (2, lost, None)]), benchmark([(9, item, "s")])).collect()
    assert [(r["doc_id"], r["item_id"], r["answer_kept"]) for r in found] == [(1, 9, True)]


def test_recall_of_the_candidate_search(spark):
    """Every document that holds an item, by brute force over the whole table, is found."""
    normal = lambda t: " ".join(t.lower().encode().translate(decontamination._BLANKS).decode().split())
    items = {r["item_id"]: f" {normal(r['text'])} " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text = f" {normal(r['text'])} "
        want |= {(r["doc_id"], k) for k, item in items.items() if item in text}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    assert want and len(got & want) >= 0.9 * len(want) and got >= want


def test_decontamination_of_odd_rows(odd, empty, benchmark):
    items = benchmark([(1, ENGLISH, "s"), (None, ENGLISH, "s"), (3, None, "s"), (4, "", "s"), (5, "one", "s")])
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(odd, items).collect()}
    assert got == {(1, 1), (2, 1), (1, None), (2, None)}
    kept = decontamination.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    assert decontamination.leaks(empty, items).collect() == []
    assert decontamination.leaks(odd, benchmark([])).collect() == []


def brute_force(rows, items):
    """The leaks as defined, by trying every passage with every item."""
    out = set()
    for doc_id, text, _ in rows:
        ids = decontamination.word_ids(text)
        for item_id, item, _ in items:
            wanted = decontamination.word_ids(item)
            n, answer = len(wanted), decontamination.answer_of(wanted)
            for row in range(max(1, -(-len(ids) // 16) - 1)):
                region = ids[max(0, row * 16 - n) : (row + 2) * 16 + n]
                share = decontamination.common_length(wanted, region) / n
                if share >= 0.8 or share >= 0.6 and decontamination._holds(region, answer):
                    out.add((doc_id, item_id))
    return out


def test_short_items_and_common_words_as_brute_force(docs, benchmark):
    """Items of 5 to 15 words and longer ones of common words, whole or with 0.6 to 0.8 of the words."""
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(3000)]
    weights = [1 / (k + 1) for k in range(3000)]
    prose = lambda n, top=3000: rng.choices(vocabulary[:top], weights[:top], k=n)
    parts = [prose(5 + k % 11) for k in range(22)] + [prose(16 + k, 150) for k in range(8)]
    parts += [prose(5 + k, 30) for k in range(0, 12, 3)]
    items = [(k, " ".join(words), "s") for k, words in enumerate(parts)]
    rows = []
    for k in range(3 * len(parts)):
        words = list(parts[k // 3])
        free = len(words) - len(decontamination.answer_of(np.array(words)))
        if k % 3:
            lost = min(free, int(len(words) * (0.4 if k % 3 == 1 else 0.2)))
            for at in rng.sample(range(free), lost):
                words[at] = "other"
        text = prose(rng.randint(0, 90)) + words + prose(rng.randint(0, 90))
        rows.append((k, " ".join(text), "en"))
    want = brute_force(rows, items)
    assert {(k, k // 3) for k in range(len(rows))} <= want
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs(rows), benchmark(items)).collect()}
    assert got == want


def test_leaks_of_the_test_table_as_brute_force(spark):
    items = [(r["item_id"], r["text"], None) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [
        (r["doc_id"], r["text"], None)
        for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()
    ]
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    wanted = {k for k, _, _ in rows}
    assert {pair for pair in got if pair[0] in wanted} == brute_force(rows, items)


def test_space_is_fitted_on_every_passage(docs):
    """No document is left out of the sums, however many there are; their squares estimate AᵀA."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(40)]
    rows = [(k, " ".join([f"own{k}", *rng.choices(common, k=rng.randint(0, 70))]), "en") for k in range(2600)]
    words = decontamination.encoded(docs([*rows, (9000, "", "en"), (9001, None, "en"), (None, rows[0][1], "en")]))
    weight = decontamination.inverse_frequency(words, len(rows) + 3)
    want = np.zeros((decontamination.FEATURES, decontamination.FEATURES), dtype=np.float32)
    for _, text, _ in [*rows, rows[0]]:
        ids = decontamination.word_ids(text).astype(np.int64) % decontamination.FEATURES
        for k in range(0, len(ids), 32):
            part = ids[k : k + 32]
            value = weight[part] / np.sqrt((weight[part] ** 2).sum())
            np.add.at(want, (part[:, None], part[None, :]), np.outer(value, value))
    for tasks in (1, 3):
        found = decontamination.random_sums(words.repartition(5), weight, tasks).collect()
        sums = np.stack([np.frombuffer(r["sums"], dtype="<f4") for r in found])
        assert len({r["row"] for r in found}) == len(found) <= decontamination.SUMS
        assert set(np.flatnonzero(sums.any(axis=0))) == set(np.flatnonzero(want.diagonal()))
        square = sums.T @ sums
        assert abs(np.trace(square) / np.trace(want) - 1) < 0.05
        top = np.argsort(-want.diagonal())[:40]
        got, exact = square[np.ix_(top, top)], want[np.ix_(top, top)]
        assert np.linalg.norm(got - exact) < 0.15 * np.linalg.norm(exact)
    assert decontamination.random_sums(words.limit(0), weight, 1).count() == 0
