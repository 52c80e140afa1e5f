import random
import re
import zlib
from collections import Counter

import pytest

from auricle.llm import spelling
from tests.llm.conftest import ODD


def count(rows):
    words = Counter()
    for key, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(words):
    out = {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(w, v)]
        form = min(around)[1] if around and -min(around)[0] >= 10 * n else None
        out[w] = (form, len(around), words[form] if form else None)
    rows = set()
    for w, n in words.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, out[w][0], root, n, out[w][1], out[w][2]))
    return rows


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    out = []
    for k in range(300):
        words = [rng.choice(base[: rng.choice([2, 5, 60])]) for _ in range(40)]
        for j in range(0, 40, 9):
            at = rng.randrange(len(words[j]))
            words[j] = words[j][:at] + rng.choice(["", "a", "bb", "ÿ"]) + words[j][at + 1 :]
        out.append((k, rng.choice(" -7").join(words).title(), None))
    return out


def as_rows(df):
    return {
        (r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()
    }


@pytest.mark.parametrize("crowd", [512, 3])
def test_variants_equal_brute_force(docs, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = texts(512)
    want = brute(count(rows))
    assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
    got = spelling.variants(docs(rows))
    assert as_rows(got) == want
    assert got.count() == len(want)


@pytest.mark.parametrize("size", [1, 40])
def test_segments_find_every_edit_once(spark, monkeypatch, size):
    monkeypatch.setattr(spelling, "CROWD", size)
    rng = random.Random(size)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(500)}
    words |= {"x" * 7, "x" * 8, "x" * 9, "y" * 5000, "y" * 4999, "y" * 2500 + "z" + "y" * 2499}
    words |= {"middle" + chr(c) + chr(d) + "end" for c in range(0xE0, 0xF6) for d in range(97, 107)}
    table = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long")
    got = [(r["word"], r["near"]) for r in spelling.near_words(table).collect()]
    want = {(a, b) for a in words for b in words if near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_odd_and_empty_tables(odd, empty):
    assert as_rows(spelling.variants(odd)) == brute(count(ODD))
    assert spelling.variants(empty).collect() == []


def test_real_texts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    words = count(rows)
    got = as_rows(spelling.variants(docs))
    assert {(r[0], r[3]) for r in got} == set(words.items())
    some = sorted(words)[:150]
    full = {r[0]: r for r in got}
    for w in some:
        assert full[w][4] == sum(near(w, v) for v in words)
