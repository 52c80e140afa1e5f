"""A causal self-attention model of subword ids in numpy: one layer, classes of ids as outputs.

P(id | context) = P(class of id | context) * P(id | class). The first factor is the attention model;
the second comes from counts over the whole training corpus. Queries, keys and values of one layer
depend on the id alone, so scoring looks them up in tables made once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Windows are two strides long: a stride is scored once, with it and the one before as context.
STRIDE = 16
WIDTH = 16
HIDDEN = 32
CLASSES = 128
OWN_CLASS = 96
#: Ids with an embedding of their own; the others share SHARED rows.
FREQUENT, SHARED = 4096, 128
CONTEXTS = 256
#: Windows of a training step, windows they are drawn from, and the rate of the first steps.
BATCH, POOL, RATE = 96, 1 << 15, 4e-3
#: Windows whose gradients are found at once.
FEW = 48
#: Input rows: padding, begin of text, then ids.
PAD, BEGIN, FIRST = 0, 1, 2
_HIDE = np.float32(-1e9)


@dataclass
class Vocabulary:
    """row: input row of each id; kind: its class; share: log10 P(id | class)."""

    row: np.ndarray
    kind: np.ndarray
    share: np.ndarray

    @property
    def rows(self) -> int:
        return FIRST + FREQUENT + SHARED


def input_rows(counts: np.ndarray) -> np.ndarray:
    order = np.argsort(-counts, kind="stable")
    rows = FIRST + FREQUENT + np.arange(len(counts)) % SHARED
    rows[order[:FREQUENT]] = FIRST + np.arange(min(FREQUENT, len(counts)))
    return rows


def vocabulary(counts: np.ndarray, contexts: np.ndarray) -> Vocabulary:
    """From corpus counts of all ids and of (row, row before it).

    The most frequent ids are classes of their own, the other frequent ones are clustered by what
    comes before them, and the rest is one class. Within a class an id has its smoothed share.
    """
    rows = input_rows(counts)
    profile = np.sqrt(contexts[FIRST : FIRST + FREQUENT].astype(np.float64))
    profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
    weight = contexts[FIRST : FIRST + FREQUENT].sum(axis=1)
    group = np.zeros(FREQUENT, dtype=np.int64)
    rest = np.arange(OWN_CLASS, FREQUENT)
    many = CLASSES - OWN_CLASS - 1
    centre = profile[rest[np.linspace(0, min(len(rest), 8 * many) - 1, many).astype(int)]]
    for _ in range(12):
        group[rest] = (profile[rest] @ centre.T).argmax(axis=1)
        for k in range(many):
            own = rest[group[rest] == k]
            if len(own) and weight[own].sum():
                centre[k] = (profile[own] * weight[own, None]).sum(axis=0)
                centre[k] /= max(np.linalg.norm(centre[k]), 1e-9)
    kind_of_row = np.full(FIRST + FREQUENT + SHARED, CLASSES - 1)
    kind_of_row[FIRST : FIRST + FREQUENT] = OWN_CLASS + group
    kind_of_row[FIRST : FIRST + OWN_CLASS] = np.arange(OWN_CLASS)
    kind = kind_of_row[rows]
    smooth = counts + 0.5
    total = np.bincount(kind, weights=smooth, minlength=CLASSES)
    return Vocabulary(rows.astype(np.int32), kind.astype(np.int32), np.log10(smooth / total[kind]))


@dataclass
class Weights:
    emb: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    near: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return list(self.__dict__.values())


def initial(rows: int, seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    return Weights(
        (rng.normal(size=(rows, WIDTH)) * 0.5).astype(np.float32),
        draw(WIDTH, WIDTH),
        draw(WIDTH, WIDTH),
        draw(WIDTH, WIDTH),
        np.zeros((STRIDE, 2 * STRIDE), dtype=np.float32),
        draw(2 * WIDTH, HIDDEN),
        np.zeros(HIDDEN, dtype=np.float32),
        draw(HIDDEN, CLASSES),
        np.zeros(CLASSES, dtype=np.float32),
    )


def causal_mask() -> np.ndarray:
    """Position q of a stride sees keys 0 to STRIDE + q of its window."""
    q, k = np.mgrid[0:STRIDE, 0 : 2 * STRIDE]
    return np.where(k <= q + STRIDE, np.float32(0), _HIDE)


def layout(texts: list[np.ndarray], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of several texts: inputs (n, 2*STRIDE) as rows, targets (n, STRIDE) as ids with -1
    for none, and the number of windows of each text."""
    inputs, targets, counts = [], [], []
    for ids in texts:
        size = -(-len(ids) // STRIDE) * STRIDE
        rows = np.zeros(STRIDE + size, dtype=np.int32)
        rows[STRIDE] = BEGIN
        rows[STRIDE + 1 : STRIDE + len(ids)] = vocab.row[ids[:-1]]
        goal = np.full(size, -1, dtype=np.int32)
        goal[: len(ids)] = ids
        blocks = rows.reshape(-1, STRIDE)
        inputs.append(np.hstack([blocks[:-1], blocks[1:]]))
        targets.append(goal.reshape(-1, STRIDE))
        counts.append(len(blocks) - 1)
    return np.vstack(inputs), np.vstack(targets), np.array(counts)


def _gathered(rows: np.ndarray, parts: np.ndarray, size: int) -> np.ndarray:
    """(size, …): the sum of parts by row; rows that do not occur are zero."""
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    begin = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
    out = np.zeros((size, parts.shape[1]), dtype=parts.dtype)
    out[sorted_rows[begin]] = np.add.reduceat(parts.take(order, axis=0), begin, axis=0)
    return out


def gradients(
    w: Weights, inputs: np.ndarray, kinds: np.ndarray
) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of the targets' classes (-1: none), and its gradient for every weight.

    Windows are gone through a few at a time, so that what is made of them stays in the cache.
    """
    total = max(1, int((kinds >= 0).sum()))
    parts = [
        _slopes(w, inputs[k : k + FEW], kinds[k : k + FEW], total) for k in range(0, len(inputs), FEW)
    ]
    dx = np.concatenate([slope[0] for _, slope in parts])
    rest = [sum(same[1:], start=same[0]) for same in zip(*(slope[1:] for _, slope in parts))]
    return sum(loss for loss, _ in parts), [_gathered(inputs.ravel(), dx, len(w.emb)), *rest]


def _slopes(
    w: Weights, inputs: np.ndarray, kinds: np.ndarray, total: int
) -> tuple[float, list[np.ndarray]]:
    """The share of some windows in the loss, a mean over `total` targets, and in its gradient; that
    of the embeddings for every place of the windows."""
    n = len(inputs)
    x = w.emb.take(inputs, axis=0)
    own = np.ascontiguousarray(x[:, STRIDE:])
    x_flat, own_flat = x.reshape(-1, WIDTH), own.reshape(-1, WIDTH)
    q = (own_flat @ w.query).reshape(own.shape)
    k, v = (x_flat @ w.key).reshape(x.shape), (x_flat @ w.value).reshape(x.shape)
    scale = np.float32(1 / np.sqrt(WIDTH))
    a = q @ k.transpose(0, 2, 1)
    a *= scale
    a += w.near + causal_mask()
    a += np.where(inputs == PAD, _HIDE, np.float32(0))[:, None, :]
    a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(axis=2, keepdims=True)
    z = np.concatenate([a @ v, own], axis=2).reshape(n * STRIDE, -1)
    h = z @ w.first
    h += w.first_bias
    np.maximum(h, 0, out=h)
    logits = h @ w.second
    logits += w.second_bias
    logits -= logits.max(axis=1, keepdims=True)
    flat = kinds.ravel()
    there = flat >= 0
    at = np.flatnonzero(there)
    chosen = logits[at, flat[at]]
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    loss = float((np.log(sums[at]) - chosen).sum() / total)
    dl = logits
    dl *= (there / (sums * sums.dtype.type(total)))[:, None].astype(sums.dtype)
    dl[at, flat[at]] -= dl.dtype.type(1 / total)
    d_second, d_second_bias = h.T @ dl, dl.sum(axis=0)
    du = dl @ w.second.T
    du *= h > 0
    d_first, d_first_bias = z.T @ du, du.sum(axis=0)
    dz = (du @ w.first.T).reshape(n, STRIDE, -1)
    do, d_own = np.ascontiguousarray(dz[:, :, :WIDTH]), dz[:, :, WIDTH:]
    dv = (a.transpose(0, 2, 1) @ do).reshape(-1, WIDTH)
    ds = do @ v.transpose(0, 2, 1)
    ds -= (ds * a).sum(axis=2, keepdims=True)
    ds *= a
    d_near = ds.sum(axis=0)
    ds *= scale
    dq = (ds @ k).reshape(-1, WIDTH)
    dk = (ds.transpose(0, 2, 1) @ q).reshape(-1, WIDTH)
    dx = dk @ w.key.T
    dx += dv @ w.value.T
    dx.reshape(x.shape)[:, STRIDE:] += d_own + (dq @ w.query.T).reshape(own.shape)
    return loss, [
        dx, own_flat.T @ dq, x_flat.T @ dk, x_flat.T @ dv,
        d_near, d_first, d_first_bias, d_second, d_second_bias,
    ]


class Learner:
    """Adam from given weights, which are left as they are."""

    def __init__(self, w: Weights):
        self.weights = Weights(*[p.copy() for p in w.arrays()])
        self._first = [np.zeros_like(p) for p in w.arrays()]
        self._second = [np.zeros_like(p) for p in w.arrays()]
        self._steps = 0

    def step(self, inputs: np.ndarray, kinds: np.ndarray, rate: float) -> float:
        """One step by a batch of windows; the loss before it."""
        self._steps += 1
        loss, slope = gradients(self.weights, inputs, kinds)
        pace = rate * (1 - 0.99**self._steps) ** 0.5 / (1 - 0.9**self._steps)
        for p, g, m, r in zip(self.weights.arrays(), slope, self._first, self._second):
            m += 0.1 * (g - m)
            r += 0.01 * (g * g - r)
            p -= pace * m / (np.sqrt(r) + 1e-7)
        return loss


def train(
    w: Weights, inputs: np.ndarray, kinds: np.ndarray, steps: int, batch: int = BATCH,
    rate: float = RATE, seed: int = 1,
) -> tuple[Weights, list[float]]:
    """Adam over random batches of windows, with a falling rate."""
    rng = np.random.default_rng(seed)
    learner = Learner(w)
    losses = []
    for t in range(1, steps + 1):
        pick = rng.integers(0, len(inputs), min(batch, len(inputs)))
        losses.append(learner.step(inputs[pick], kinds[pick], rate * (1 - 0.8 * t / steps)))
    return learner.weights, losses


def train_once(
    w: Weights, windows: Iterator[tuple[np.ndarray, np.ndarray]], rate: float, seed: int = 1
) -> tuple[Weights, int]:
    """Adam over every window of (inputs, kinds) once, in batches drawn from POOL windows at a time;
    and how many there were."""
    rng = np.random.default_rng(seed)
    learner = Learner(w)
    inputs, kinds, held, total = [], [], 0, 0

    def learn() -> None:
        all_inputs, all_kinds = np.vstack(inputs), np.vstack(kinds)
        for pick in np.array_split(rng.permutation(held), -(-held // BATCH)):
            learner.step(all_inputs[pick], all_kinds[pick], rate)

    for own, kind in windows:
        inputs.append(own)
        kinds.append(kind)
        held += len(own)
        if held >= POOL:
            learn()
            inputs, kinds, total, held = [], [], total + held, 0
    if held:
        learn()
    return learner.weights, total + held


class Scorer:
    """log10 probabilities of whole texts."""

    AT_ONCE = 128

    def __init__(self, w: Weights, vocab: Vocabulary):
        self.vocab = vocab
        scale = np.float32(1 / np.sqrt(WIDTH))
        self.query = w.emb @ w.query * scale
        self.key = w.emb @ w.key
        # exp stays finite without a maximum: scores are bounded by the lengths of the vectors
        reach = np.linalg.norm(self.query, axis=1).max() * np.linalg.norm(self.key, axis=1).max()
        self.query *= min(1.0, 40.0 / max(reach, 1e-9))
        # the value's and the own embedding's parts of the hidden layer are looked up as well; a last
        # column of ones, none for padding, adds up the weights and then carries the bias
        value = np.hstack([w.emb @ w.value @ w.first[:WIDTH], np.ones((len(w.emb), 1))])
        value[PAD] = 0
        own = np.hstack([w.emb @ w.first[WIDTH:] + w.first_bias, np.zeros((len(w.emb), 1))])
        self.asks = np.hstack([self.query, own]).astype(np.float32)
        self.seen = np.hstack([self.key, value]).astype(np.float32)
        self.near = np.exp(np.clip(w.near, -40, 40)) * (causal_mask() == 0)
        self.second = np.vstack([w.second, w.second_bias]).astype(np.float32)
        self.ones = np.ones(CLASSES, dtype=np.float32)
        # attention averages values, so this is the most that a hidden unit and a logit can be
        most = np.maximum(value.max(axis=0) + own.max(axis=0), 0)
        most[-1] = 1
        self.tall = bool((np.maximum(self.second, 0).T @ most).max() > 80)

    def tokens(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """log10 P of every target, 0 where there is none: batched masked attention."""
        there = targets >= 0
        goal = np.where(there, targets, 0)
        asks = self.asks.take(inputs[:, STRIDE:], axis=0)
        seen = self.seen.take(inputs, axis=0)
        a = asks[:, :, :WIDTH] @ seen[:, :, :WIDTH].transpose(0, 2, 1)
        np.exp(a, out=a)
        a *= self.near
        h = a @ seen[:, :, WIDTH:]
        h /= np.maximum(h[:, :, -1:], 1e-30)
        h[:, :, -1] = 1
        h += asks[:, :, WIDTH:]
        np.maximum(h, 0, out=h)
        logits = h.reshape(-1, HIDDEN + 1) @ self.second
        if self.tall:
            np.minimum(logits, 80, out=logits)  # exp stays finite
        kind = self.vocab.kind[goal].ravel()
        chosen = logits[np.arange(len(kind)), kind]
        np.exp(logits, out=logits)
        out = (chosen - np.log(logits @ self.ones)) / np.float32(np.log(10))
        return np.where(there, out.reshape(goal.shape) + self.vocab.share[goal], 0.0)

    def texts(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text: the sum over its tokens, each scored once."""
        if not texts:
            return np.zeros(0)
        inputs, targets, counts = layout(texts, self.vocab)
        each = np.concatenate(
            [
                self.tokens(inputs[k : k + self.AT_ONCE], targets[k : k + self.AT_ONCE]).sum(axis=1)
                for k in range(0, len(inputs), self.AT_ONCE)
            ]
        )
        return np.add.reduceat(each, np.cumsum([0, *counts[:-1]]))


def averaged(parts: list[tuple[list[np.ndarray], int]]) -> tuple[list[np.ndarray], int]:
    """Mean of the arrays of weights, in double precision, each set counted as often as it says."""
    total, counted = None, 0
    for arrays, n in parts:
        more = [n * p.astype(np.float64) for p in arrays]
        total = more if total is None else [a + b for a, b in zip(total, more)]
        counted += n
    return [p / counted for p in total], counted
