import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auricle.llm import packing, subwords
from auricle.llm.registry import tokenizer_path
from auricle.llm.subwords import Chunked, Spaced
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts(whole):
    chunked = Chunked(tokenizer_path())
    rng = random.Random(0)
    parts = ["word", "Word,", "it's", "12.5", " ", "  ", "\n", "\t", "é,", "ß.", "日本", "　", "\x1c",
             " ", "\x85", "᠎", "!!", "a.", ",", "<|endoftext|>", "\U0001f600", "x" * 90, "'ll", "don't"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(40)) for _ in range(400)]
    texts += ["", " ", " a", "a ", "a  b", "hello <|endoftext|> world", "a<|endoftext|>", "x\n\n"]
    for text, ids in zip(texts, chunked.encode_all(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)
    assert np.frombuffer(chunked.encode_all(pa.array([texts[-3]]))[0], "<u4").tolist() == [31373, 220, 50256, 995]
    assert chunked.encode_all(pa.array([None, ""], pa.string())) == [b"", b""]
    assert chunked.encode_all(pa.array([], pa.string())) == []


def test_spaced_chunks_give_the_ids_of_whole_texts():
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    spaced = Spaced(path)
    rng = random.Random(1)
    parts = ["word", "Word,", "IT'S", "12.5", " ", "\n", "\t", "É,", "e\u0301", "ß.", "日本", "\u3000",
             "\x1c", "\x85", "!!", "a.", "<|endoftext|>", "<|ENDOFTEXT|>", "\U0001f600", "x" * 90, "'LL,", "ΟΔΟΣ",
             "\u0958", "İ", "don't", "q'", "(a-b)", "ǅ"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(40)) for _ in range(400)]
    texts += ["", " ", " a", "a ", "a  b", "A", "\n"]
    for text, ids in zip(texts, spaced.encode_all(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert spaced.encode_all(pa.array([None, ""], pa.string())) == [b"", b""]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(3000):
        size = rng.choice([rng.randint(1, 1023), rng.randint(300, 700), rng.randint(1, 60)])
        counts[size] = counts.get(size, 0) + rng.choice([1, 1, 40])
    plan = packing.make_plan(counts)
    used = {}
    for size, runs in plan.runs.items():
        covered = 0
        for k, (low, first, each, at) in enumerate(runs):
            high = runs[k + 1][0] if k + 1 < len(runs) else counts[size]
            assert low == covered
            for rank in range(low, high):
                b, slot = first + (rank - low) // each, (rank - low) % each
                used.setdefault(b, []).append((at + slot * size, size))
            covered = high
        assert covered == counts[size]
    for places in used.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= packing.CAPACITY
    total = sum(s * n for s, n in counts.items())
    assert len(used) == plan.bins
    assert plan.bins <= 1.02 * max(total / 1024, sum(n for s, n in counts.items() if s > 512)) + 2


def test_large_items_are_matched_two_to_a_bin():
    plan = packing.make_plan({600: 3, 424: 2, 400: 2, 350: 1})
    assert plan.bins == 4


def test_digests_of_odd_rows(odd, whole):
    rows = packing.digests(odd, tokenizer_path()).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 1024
    got = sorted(
        ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str
    )
    want = []
    for key, text, _ in ODD:
        ids = np.array([*whole(text or ""), 2], dtype="<u4")
        size = (len(ids) - 1) % 1024 + 1
        at = piece = 0
        while at < len(ids):
            part = ids[at : at + size]
            want.append((key, piece, at, len(part), zlib.crc32(part.tobytes())))
            at, piece, size = at + size, piece + 1, 1024
    assert got == sorted(want, key=str)


def test_sequences_hold_the_ids(docs, whole):
    rows = [(k, "some words here " * k, None) for k in range(1, 30)]
    pieces = packing.token_pieces(docs(rows), tokenizer_path(), capacity=64)
    packed = packing.pack(pieces, capacity=64)
    sequences = packing.sequences(packed).collect()
    total = sum(len(whole(t)) + 1 for _, t, _ in rows)
    held = [np.frombuffer(bytes(r["ids"]), "<u4") for r in sequences]
    assert sum(map(len, held)) == total and max(map(len, held)) <= 64
    places = {(r["sequence_id"]): [] for r in packed.collect()}
    for r in packed.collect():
        places[r["sequence_id"]].append((r["offset"], bytes(r["ids"])))
    for r in sequences:
        assert bytes(r["ids"]) == b"".join(i for _, i in sorted(places[r["sequence_id"]]))


def test_empty_table(empty):
    assert packing.digests(empty, tokenizer_path()).collect() == []


def test_large_ids_beside_a_null_id_and_columns_of_any_name(docs, spark):
    big = [9007199254740993, 1152921504606846983, None]
    pieces = packing.token_pieces(docs([(k, "a b c", None) for k in big]), tokenizer_path())
    named = pieces.withColumns({n: F.lit("x") for n in ("salt", "base", "rank", "n", "size", "row", "offset")})
    rows = packing.pack(named).collect()
    assert {r["doc_id"] for r in rows} == set(big)
    assert sorted(r["offset"] for r in rows) == [0, 4, 8]
    assert all(r["salt"] == r["size"] == r["row"] == "x" for r in rows)


def test_ids_are_put_together_for_some_texts_at_a_time(whole, monkeypatch):
    texts = [f"first{k} " + "and more words, " * (k % 5) + f"end{k}" for k in range(60)] + ["one " * 90 + "x"]
    put, sizes = subwords._gather, []
    monkeypatch.setattr(subwords, "GATHERED", 40)
    monkeypatch.setattr(subwords, "_gather", lambda *a: sizes.append(len(a[3]) - 1) or put(*a))
    made = Chunked(tokenizer_path()).encode_all(pa.array(texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in made] == [whole(t) for t in texts]
    assert len(sizes) > 5 and sum(sizes[1:]) == len(texts) and max(sizes[1:]) <= 40
