import hashlib
import random

import numpy as np
import pyarrow as pa

from auricle.llm import minhash
from auricle.llm.registry import QUERIES
from tests.llm.conftest import ODD, ODD_IDS, ids


def shingles(text):
    words = text.lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_likeness_estimates_jaccard():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(5000)]
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for _ in range(5):
            left = rng.choices(words, k=600)
            cut = int(600 * share)
            a, b = " ".join(left), " ".join(left[:cut] + rng.choices(words, k=600 - cut))
            x, y = shingles(a), shingles(b)
            got = minhash.likeness(minhash.signature(a), minhash.signature(b))
            errors.append(got - len(x & y) / len(x | y))
    assert np.abs(errors).max() < 0.15 and abs(np.mean(errors)) < 0.02


def test_neighbours(docs):
    rng = random.Random(4)
    texts = {k: "".join(rng.choices("ab é\U0001f600\n", k=rng.randint(0, 80))) for k in rng.sample(range(999), 90)}
    texts[1000] = None
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in minhash.fingerprints(docs([(k, t, None) for k, t in texts.items()])).collect()}
    assert sorted(got, reverse=True) == order
    for k, after in zip(order, order[1:] + order[:1]):
        own, following = texts[k] or "", texts[after] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        assert got[k]["n_chars"] == len(own)
        assert got[k]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert bytes(got[k]["fingerprint"]) == minhash.signature(own).tobytes()
        assert bytes(got[k]["edited_fingerprint"]) == minhash.signature(changed).tobytes()
        assert got[k]["near_next"] == minhash.likeness(minhash.signature(own), minhash.signature(following))


def test_odd_rows(odd):
    found = minhash.fingerprints(odd)
    assert ids(found) == ODD_IDS
    rows = found.collect()
    prints = {}
    for r in rows:
        prints.setdefault(dict((k, t) for k, t, _ in ODD)[r["doc_id"]] or "", set()).add(bytes(r["fingerprint"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())  # equal texts, equal fingerprints


def test_one_row_and_none(docs, empty):
    (row,) = minhash.fingerprints(docs([(5, "abcd", None)])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
    assert minhash.fingerprints(empty).collect() == []


def test_classes_are_those_of_brute_force(docs, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    rows, k = [], 0
    for _ in range(6):
        first = rng.choices(words, k=rng.randint(20, 120))
        for _ in range(rng.randint(1, 14)):
            text = list(first)
            for at in rng.sample(range(len(text)), rng.choice([0, 0, 1, 1, 2, len(text) // 8])):
                text[at] = "changed"
            rows.append((k, " ".join(text), None))
            k += 1
    rows += [(k, "", None), (k + 1, None, None), (k + 2, "one two", None), (k + 3, "one two", None)]
    root = {key: key for key, _, _ in rows}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, s, _ in rows:
        for b, t, _ in rows:
            x, y = shingles(s or ""), shingles(t or "")
            if a < b and (x == y or (x and y and len(x & y) / len(x | y) >= 0.8)):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    truth = {key: find(key) for key in root}
    for paired in (64, 3):
        monkeypatch.setattr(minhash, "PAIRED", paired)
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs(rows)).collect()}
        assert got == truth


def test_classes_of_odd_rows(odd, empty):
    found = minhash.near_duplicates(odd)
    assert ids(found) == ODD_IDS
    part = {r["doc_id"]: r["class_id"] for r in found.collect()}
    assert part[1] == part[2] == 1 and part[3] == part[4] == part[5] == 3 and part[None] is None
    assert minhash.near_duplicates(empty).collect() == []


def test_query_gives_the_classes_of_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sets = {k: shingles(t or "") for k, t in texts.items()}
    holders, root = {}, {k: k for k in sets}
    for k, held in sets.items():
        for shingle in held:
            holders.setdefault(shingle, []).append(k)

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    met = {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}
    for a, b in met:
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op3_fingerprints"](spark, folder).collect()}
    assert got == {k: find(k) for k in texts}
    assert len(set(got.values())) < len(got)


def test_classes_with_ids_sent_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(minhash, "WANTED_AT_ONCE", 3)
    rows = [(k, " ".join(f"w{k // 2}x{j}" for j in range(60)) + " end" * (k % 2), None) for k in range(24)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs(rows)).collect()}
    assert got == {k: k - k % 2 for k in range(24)}


def test_large_group_of_texts_alike_in_bands_only(docs, monkeypatch):
    """Variants of one text, most of them under the similarity: none is compared in pairs for that,
    and the few that are alike are found."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(240):
        text = list(base)
        for at in rng.sample(range(200), 10):
            text[at] = f"own{k}x{at}"
        rows.append((2 * k, " ".join(text), None))
        if k % 40 == 7:
            rows.append((2 * k + 1, " ".join([*text[:-1], "end"]), None))
    root = {k: k for k, _, _ in rows}
    sets = [(k, shingles(t)) for k, t, _ in rows]

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if len(x & y) / len(x | y) >= 0.8:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    compared = []
    verified = minhash._verified
    monkeypatch.setattr(
        minhash, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more)
    )
    monkeypatch.setattr(minhash, "PAIRED", 8)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs(rows)).collect()}
    assert got == {k: find(k) for k in root} and len(set(got.values())) < len(rows)
    assert sum(compared) < 20 * len(rows)


def test_near_copies_below_the_similarity_are_ruled_out_by_sketches(docs, monkeypatch):
    """Texts that share most of their shingles with each other, but not enough: nearly no pair is compared."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(160):
        text = list(base)
        for at in (rng.randrange(5, 70), rng.randrange(80, 145)):
            text[at] = f"own{k}x{at}"
        rows.append((k, " ".join(text), None))
    root = {k: k for k, _, _ in rows}
    sets = [(k, shingles(t)) for k, t, _ in rows]

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if len(x & y) / len(x | y) >= 0.8:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    verified = minhash._verified
    for paired in (1000, 8):
        compared = []
        monkeypatch.setattr(
            minhash, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more)
        )
        monkeypatch.setattr(minhash, "PAIRED", paired)
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs(rows)).collect()}
        assert got == {k: find(k) for k in root}
        assert compared[-1] < 5 * len(rows)


def test_sketches_differ_in_no_more_bits_than_sets_in_hashes():
    rng = np.random.default_rng(2)
    for size in (0, 1, 40, 3000):
        a = np.unique(rng.integers(0, 1 << 32, size, dtype=np.uint32))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 32, size // 3, dtype=np.uint32)]))
        x, y = minhash.odd_sketch(a), minhash.odd_sketch(b)
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert len(x) == minhash.SKETCH and bits <= len(np.setxor1d(a, b))
        assert (minhash.odd_sketch(a) == x).all()


def test_texts_travel_compressed():
    texts = ["", "a b", None, "ä日\U0001f600 " * 50, "one and the other " * 400]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5), pa.int64()), pa.array([7] * 5, pa.int64()), pa.array(texts, pa.string())],
        names=["doc_id", "tie", "text"],
    )
    (sent,) = minhash._packed(iter([batch]))
    assert sum(len(c.as_py()) for c in sent.column(3)) < sum(len((t or "").encode()) for t in texts) / 10
    assert list(minhash._texts(sent)) == [(k, t or "") for k, t in enumerate(texts)]
