import random

import xxhash

from auricle.llm import simhash
from tests.llm.conftest import ODD, ODD_IDS, ids


def plain(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, most):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprint_is_the_majority_of_the_shingles():
    for text in ("", "One", "two Words", "a b c d e f g h", "the cat THE cat the cat", "é ß 日 x y"):
        assert simhash.fingerprint(text.encode(), 3) % (1 << 64) == plain(text)


def test_odd_rows(odd):
    found = simhash.near_duplicates(odd).collect()
    assert sorted((r["doc_id"] for r in found), key=lambda k: (k is None, k or 0)) == ODD_IDS
    bits = {k: plain(t) for k, t, _ in ODD}
    for r in found:
        assert r["bits"] % (1 << 64) == bits[r["doc_id"]]
    part = {r["doc_id"]: r["component_id"] for r in found}
    assert part[2] == part[1] == 1
    assert part[3] == part[4] == part[5] == 3  # no words: fingerprint zero, linked like any other


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_per_group(empty).collect() == []


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(20)]
    values = set(centres)
    for centre in centres:
        for _ in range(12):
            near = centre
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << bit
            values.add(near)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "bits long")
    by_value = {v: v % (1 << 64) for (v,) in signed}
    truth = groups(sorted(by_value.values()), 2)
    for paired in (64, 2):  # the second sends nearly all buckets the other way
        edges = simhash.links(frame, 2, paired).collect()
        for a, b in edges:
            assert (by_value[a] ^ by_value[b]).bit_count() <= 2
        root = {v: v for v in by_value.values()}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in edges:
            x, y = find(by_value[a]), find(by_value[b])
            root[max(x, y)] = min(x, y)
        assert {v: find(v) for v in root} == truth


def test_one_document_of_each_group_stays(odd):
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns
    assert ids(kept) == [1, 3, 6, 8, 9, 10, 11, 12, None]


def test_the_row_kept_of_one_id_does_not_depend_on_order(docs):
    rows = [(1, f"text number {k} of one id that differs from all the others", "en") for k in range(20)]
    rows += [(2, "a b c d e f", "en"), (2, "a b c d e f", "en"), (3, "a b c d e f", "fr"), (None, "x", None)]
    kept = []
    for order in (rows, rows[::-1]):
        found = simhash.one_per_group(docs(order))
        assert found.columns == docs(order).columns
        kept.append(sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str))
    assert kept[0] == kept[1]
    assert [k for k, _ in kept[0]] == [1, 2, None]
