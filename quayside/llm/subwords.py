"""Subword units of words: hashed character n-grams, and a linear softmax over their averages."""

from __future__ import annotations

import numpy as np

from quayside.llm.common import MULT, U, Words, mixed

#: Hashed unit buckets, bytes per n-gram, size of the vectors.
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSION = 4
#: The average is scaled by this before the softmax: single words count among hundreds.
SCALE = 30.0
#: Units of fewer training texts keep a zero vector.
MIN_TEXTS = 5


def word_units(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(units, first): bucket numbers of each word's units, and where a word's begin.

    The units are the whole word and the n-grams of ``<word>``, in UTF-8 bytes.
    """
    data = np.frombuffer(b"".join(b"<%s>" % w for w in words) + b"\0" * 8, np.uint8).astype(U)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    begin = np.cumsum(size) - size
    total = int(size.sum())
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(begin + size, size) - np.arange(total)
    h = np.zeros(total, U)
    owners, units = [], []
    for n in range(1, max(GRAMS) + 1):
        h = mixed((h + data[n - 1:n - 1 + total]) * MULT + U(n))
        if n in GRAMS:
            at = left >= n
            owners.append(owner[at])
            units.append(h[at])
    whole = Words(words, bytes(range(256)))
    owners.append(np.arange(len(words)))
    units.append(whole.hashes() if len(whole.start) == len(words)
                 else np.fromiter((hash_bytes(w) for w in words), U, len(words)))
    owners, units = np.concatenate(owners), np.concatenate(units)
    order = np.argsort(owners, kind="stable")
    first = np.searchsorted(owners[order], np.arange(len(words) + 1))
    return (units[order] & U(BUCKETS - 1)).astype(np.int32), first


def hash_bytes(w: bytes) -> int:
    from zlib import crc32

    return crc32(w)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; ranges may be empty."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float32)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out


def _ranges(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ranges ``first[i]:first[i + 1]`` for i in ``at``, and their bounds."""
    size = first[at + 1] - first[at]
    bound = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(first[at] - bound[:-1], size) + np.arange(bound[-1]), bound


def fit_softmax(texts: list[tuple[np.ndarray, np.ndarray]], words: list[bytes],
                label: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.1,
                seed: int = 3) -> tuple[np.ndarray, float]:
    """Train unit vectors and softmax weights together (Adagrad on small batches).

    ``texts`` are (word numbers, counts).  A text's vector is the average over its words
    of the average over a word's units.  Returns one logit per unit bucket and a bias:
    with two classes, the difference of the two softmax rows applied to a unit's vector
    is all that scoring needs.
    """
    units, first = word_units(words)
    seen = np.zeros(BUCKETS, np.int32)
    for w, _ in texts:
        seen[np.unique(units[_ranges(first, w)[0]])] += 1
    known = seen >= MIN_TEXTS
    share = 1.0 / np.maximum(1, np.diff(first))
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.05, (BUCKETS, DIMENSION)).astype(np.float32)
    e[~known] = 0
    w = rng.normal(0, 0.5, (DIMENSION, 2)).astype(np.float32)
    b = np.zeros(2, np.float32)
    past_e, past_w, past_b = (np.full(x.shape, 1e-6, np.float32) for x in (e, w, b))
    target = np.eye(2, dtype=np.float32)[label]
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), batch):
            rows = order[begin:begin + batch]
            numbers = np.concatenate([texts[i][0] for i in rows])
            counts = np.concatenate([texts[i][1] / max(1, texts[i][1].sum()) for i in rows])
            bound = np.concatenate([[0], np.cumsum([len(texts[i][0]) for i in rows])])
            at, word_bound = _ranges(first, numbers)
            u = units[at]
            part = (SCALE * counts * share[numbers]).astype(np.float32)
            part = np.repeat(part, np.diff(word_bound))
            keep = known[u]
            hidden = _sums(e[u] * part[:, None], word_bound[bound])
            logits = hidden @ w + b
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            d = ((p - target[rows]) / len(rows)).astype(np.float32)
            above = d @ w.T
            row = np.repeat(np.arange(len(rows)), np.diff(word_bound[bound]))[keep]
            used, slot = np.unique(u[keep], return_inverse=True)
            grad = np.stack([np.bincount(slot, above[row, j] * part[keep], len(used))
                             for j in range(DIMENSION)], axis=1).astype(np.float32)
            past_e[used] += grad * grad
            e[used] -= rate * grad / np.sqrt(past_e[used])
            for x, g, past in ((w, hidden.T @ d, past_w), (b, d.sum(axis=0), past_b)):
                past += g * g
                x -= rate * g / np.sqrt(past)
    return e @ (w[:, 1] - w[:, 0]), float(b[1] - b[0])
