import math
import zlib
from collections import Counter

import numpy as np
import pytest

from auricle.llm import attention, lm
from auricle.llm.registry import RANKS, tokenizer_path, tokenizer_pattern
from tests.llm.conftest import ODD, ODD_IDS, ids


@pytest.fixture(autouse=True)
def short(monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 5)
    monkeypatch.setattr(lm, "ROUNDS", 1)


def words(text):
    return [*(text or "").encode().lower().split(), b""]


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = attention.initial(12)
    w = attention.Weights(*[p.astype(np.float64) for p in w.arrays()])
    inputs = rng.integers(1, 12, (3, 2 * attention.STRIDE))
    inputs[0, : attention.STRIDE] = attention.PAD
    kinds = rng.integers(-1, 5, (3, attention.STRIDE))
    _, slope = attention.gradients(w, inputs, kinds)
    for p, g in zip(w.arrays(), slope):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in p.shape)
            before = p[at]
            p[at] = before + 1e-5
            up = attention.gradients(w, inputs, kinds)[0]
            p[at] = before - 1e-5
            down = attention.gradients(w, inputs, kinds)[0]
            p[at] = before
            assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-6)


@pytest.fixture
def model():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 6000).astype(float)
    contexts = rng.random((attention.FIRST + attention.FREQUENT + attention.SHARED, attention.CONTEXTS))
    vocab = attention.vocabulary(counts, contexts)
    return attention.Scorer(attention.initial(vocab.rows), vocab), attention.initial(vocab.rows), vocab


def test_probabilities_sum_to_one(model):
    scorer, _, vocab = model
    prefix = np.array([5, 77, 4000], dtype=np.int64)
    total = 0.0
    for begin in range(0, 6000, 500):
        texts = [np.append(prefix, k) for k in range(begin, begin + 500)]
        total += (10 ** (scorer.texts(texts) - scorer.texts([prefix]))).sum()
    assert abs(total - 1) < 1e-3


def test_tables_score_as_the_model_does_and_windows_are_causal(model):
    scorer, weights, vocab = model
    rng = np.random.default_rng(4)
    text = rng.integers(0, 6000, 50)
    inputs, targets, counts = attention.layout([text], vocab)
    assert counts.tolist() == [4] and (targets >= 0).sum() == 50
    each = scorer.tokens(inputs, targets)
    loss, _ = attention.gradients(weights, inputs, np.where(targets >= 0, vocab.kind[np.maximum(targets, 0)], -1))
    shares = vocab.share[text].sum()
    assert math.isclose((each.sum() - shares) * math.log(10) / -50, loss, rel_tol=1e-4)
    changed = text.copy()
    changed[30:] = 1
    other = scorer.tokens(*attention.layout([changed], vocab)[:2])
    assert np.allclose(each.ravel()[:30], other.ravel()[:30])
    assert np.allclose(scorer.texts([text, changed]), [each.sum(), other.sum()])


def test_large_logits_are_bounded_and_others_need_no_bound(model):
    scorer, weights, vocab = model
    assert not scorer.tall
    text = np.random.default_rng(5).integers(0, 6000, 100)
    bounded = attention.Scorer(weights, vocab)
    bounded.tall = True
    assert np.array_equal(bounded.texts([text]), scorer.texts([text]))
    steep = attention.Weights(*[p * 1000 if p is weights.second else p for p in weights.arrays()])
    large = attention.Scorer(steep, vocab)
    assert large.tall and np.isfinite(large.texts([text])).all()


def test_padding_has_no_weight(model):
    scorer, _, vocab = model
    text = np.arange(3)
    inputs, targets, _ = attention.layout([text], vocab)
    assert (scorer.seen[attention.PAD, attention.WIDTH :] == 0).all()
    alone = scorer.tokens(inputs, targets)
    assert np.allclose(alone.sum(), scorer.texts([text])[0]) and (alone[targets < 0] == 0).all()


def test_training_lowers_the_loss():
    kinds = np.tile(np.arange(16) % 4, (200, 1))
    inputs = np.concatenate([kinds, kinds], axis=1) + 2
    inputs[:, 1:] = inputs[:, :-1].copy()
    _, losses = attention.train(attention.initial(10), inputs, kinds, 120)
    assert losses[-1] < 0.2 < losses[0]


def scored(frame):
    return lm.scores(frame, tokenizer_path(RANKS), tokenizer_pattern())


def test_base_scores_and_counts(docs, monkeypatch):
    rows = [(k, t, g) for k, t, g in ODD if k not in (None, 6)]
    rows += [(k, f"Common words and w{k} w{k % 7}\x0bend", "en") for k in range(100, 160)]
    training = [t for k, t, _ in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    count = Counter(w for t in training for w in words(t))
    total, kinds = sum(count.values()), len(count)
    for head in (200_000, 5):  # the second leaves nearly all words to the join
        monkeypatch.setattr(lm.head_limit, "__defaults__", (head,))
        got = {r["doc_id"]: r for r in scored(docs(rows)).collect()}
        assert len(got) == len(rows)
        for k, t, _ in rows:
            r = got[k]
            own = words(t)
            want = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in own)
            assert math.isclose(r["base_score"], want, rel_tol=1e-9)
            assert r["n_tokens"] == len(own) and r["train_tokens"] == total
            assert r["n_known"] == sum(count[w] > 0 for w in own)
            assert r["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2)
            assert r["score"] < 0 and math.isfinite(r["score"])


def test_odd_rows_and_empty_table(odd, empty):
    assert ids(scored(odd)) == ODD_IDS
    assert scored(empty).collect() == []


def test_contexts_are_counted_in_every_training_document(spark, monkeypatch):
    """More documents than the sample holds, equal ones included."""
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 1)
    met = {}
    plain = attention.vocabulary
    monkeypatch.setattr(
        attention, "vocabulary", lambda counts, contexts: met.update(n=contexts.sum()) or plain(counts, contexts)
    )
    docs = spark.createDataFrame([(f"one two {k % 7}",) for k in range(50)] + [(None,)], "text STRING")
    ranks, pattern = tokenizer_path(RANKS), tokenizer_pattern()
    counts = lm.word_counts(docs)
    lm.fit(docs, counts, ranks, pattern)
    assert met["n"] == lm.id_counts(counts, ranks, pattern).sum()


def test_weights_learn_from_every_window_of_every_training_document(spark, monkeypatch):
    """Far more documents and windows than the sample holds."""
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 1)
    monkeypatch.setattr(lm, "WINDOWS_PER_TASK", 1)
    monkeypatch.setattr(lm, "ROUNDS", 3)
    met = {}
    plain = attention.Scorer
    monkeypatch.setattr(attention, "Scorer", lambda w, vocab: met.update(w=w, vocab=vocab) or plain(w, vocab))
    texts = [" ".join(str(100 * k + i) for i in range(100)) for k in range(40)]
    docs = spark.createDataFrame([(t,) for t in [*texts, "", None]], "text STRING").repartition(5)
    ranks, pattern = tokenizer_path(RANKS), tokenizer_pattern()
    lm.fit(docs, lm.word_counts(docs), ranks, pattern)
    encode = lm.subwords(ranks, pattern).ids
    seen = np.unique(np.concatenate([np.frombuffer(encode(w), "<u2") for t in texts for w in words(t)[:-2]]))
    changed = (met["w"].emb != attention.initial(met["vocab"].rows).emb).any(axis=1)
    assert len(seen) > 500 and changed[met["vocab"].row[seen]].all()


def test_one_pass_takes_every_window_once(monkeypatch):
    rng = np.random.default_rng(2)
    taken = []
    monkeypatch.setattr(attention, "POOL", 300)
    monkeypatch.setattr(
        attention.Learner, "step", lambda self, inputs, kinds, rate: taken.extend(zip(inputs[:, 0], kinds[:, 0]))
    )
    windows, begin = [], 0
    for n in rng.integers(1, 250, 12).tolist():
        own = np.arange(begin, begin + n)[:, None].repeat(2 * attention.STRIDE, axis=1)
        windows.append((own, -own[:, : attention.STRIDE]))
        begin += n
    _, total = attention.train_once(attention.initial(4), iter(windows), 1e-3)
    assert total == begin and sorted(taken) == [(k, -k) for k in range(begin)]
    assert attention.train_once(attention.initial(4), iter([]), 1e-3)[1] == 0


def test_weights_are_averaged_by_their_windows():
    parts = [([np.full((2, 2), v, dtype=np.float32), np.array([v])], n) for v, n in [(1.0, 1), (4.0, 2)]]
    arrays, n = attention.averaged(parts)
    assert n == 3 and np.allclose(arrays[0], 3) and np.allclose(arrays[1], 3)
