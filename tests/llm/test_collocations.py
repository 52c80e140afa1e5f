import random
import re
from collections import Counter

import numpy as np
import pytest

from auricle.llm import collocations
from tests.llm.conftest import ODD


def brute(rows, least, top):
    counts = {}
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        held = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for m in range(1, 6):
                held.update(tuple(words[p : p + m]) for p in range(len(words) - m + 1))
    out = []
    for lang, held in counts.items():
        n = sum(c for p, c in held.items() if len(p) == 1)
        many = {p: c for p, c in held.items() if len(p) > 1 and c >= least}
        inner = set()
        for p, c in many.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    if 100 * c >= 100 * held[p[s : s + m]]:
                        inner.add(p[s : s + m])
        scored = []
        for p, a in many.items():
            if p not in inner:
                cuts = []
                for k in range(1, len(p)):
                    left, right = held[p[:k]], held[p[k:]]
                    cuts.append((1000 * a * n // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def as_rows(df):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "B", "é", "\U0001f600", "longer", "w0rd", "\x01", "a\x02", "ﬁ"]
    words += [f"v{k}" for k in range(80)]
    out = []
    for k in range(120):
        many = [rng.choice(words[: rng.choice([3, 9, 89])]) for _ in range(60)]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ", "]) for w in many)
        out.append((k, "the same passage again and again here " + text, rng.choice(["en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("per_task", [300, 100_000])
def test_equal_to_brute_force(docs, per_task):
    rows = texts(4)
    got = collocations.collocations(docs(rows), least=6, top=50, per_task=per_task)
    want = brute(rows, 6, 50)
    assert len(want) > 100 and as_rows(got) == want


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_filter_of_any_size_changes_no_row(docs, monkeypatch, bits):
    monkeypatch.setattr(collocations, "FILTER_BITS", bits)
    monkeypatch.setattr(collocations, "PAIR_BITS", bits)
    rows = texts(5)[:60]
    assert as_rows(collocations.collocations(docs(rows), 5, 1000)) == brute(rows, 5, 1000)


def test_quicksort_counts_phrases():
    rng = np.random.default_rng(0)
    words = rng.integers(1, 5, (3000, 5)).astype(np.int32)
    words[np.arange(5) >= rng.integers(1, 6, (3000, 1))] = 0
    weight = rng.integers(1, 4, 3000)
    got = {tuple(words[r, :d]): c for r, d, c in collocations.sort_phrases(words, weight, 20)}
    want = Counter()
    for row, w in zip(words.tolist(), weight.tolist()):
        for d in range(2, 6):
            if row[d - 1]:
                want[tuple(row[:d])] += w
    assert got == {p: c for p, c in want.items() if c >= 20}


def test_odd_and_empty_tables(docs, odd, empty):
    assert as_rows(collocations.collocations(odd, 2, 100)) == brute(ODD, 2, 100)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(docs([(1, None, None), (2, "", "en")])).collect() == []


def test_ties_go_by_bytes(docs):
    rows = [(1, "b c. " * 4 + "a d. " * 4 + "Z y. " * 4 + "é ß. " * 4, "en")]
    got = [r[2] for r in as_rows(collocations.collocations(docs(rows), 4))]
    assert got == ["a d", "b c", "z y", "é ß"]
