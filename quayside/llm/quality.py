"""Quality of texts: ordinal regression with cumulative links on graded ratings.

One weight vector over hashed text features gives a text's value f; ordered thresholds
t_1 < ... < t_m cut it into grades: P(grade >= k) = 1 / (1 + exp(t_k - f)).  Selection uses
the expected grade or a tail probability.

Features: hashed words, hashed word shapes (runs of capitals, small letters, digits and
single signs) and pairs of neighbouring shapes, each averaged over the text, and the
hashed logarithms of its length, of its distinct words and of its distinct lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import (
    MULT, U, Words, byte_table, encoded, give_back, hash_ranges, mixed, prepare, slices,
    text_column,
)
from quayside.llm.labelled import training_sample

#: Rows of a grade in the training sample, at most.
MAX_ROWS = 2000
BUCKETS = 1 << 18
SCALE = 20.0
#: Bytes of text scored at a time; its features take some 60 times as much.
SLICE = 1 << 18
EPOCHS = 12
WORD_TABLE = byte_table("\t\n\v\f\r ", lower=False)
LINE_TABLE = byte_table("\n", lower=False)
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128
    else ord("9") if 48 <= b <= 57 else b for b in range(256))


@dataclass(frozen=True)
class Model:
    weight: np.ndarray
    thresholds: np.ndarray


def grades(labels: DataFrame) -> Column:
    """Rating of a labelled row: 0 poor, 1 fair but toxic, 2 good; null without quality."""
    toxic = F.coalesce(labels["toxic"], F.lit(0)) == 1
    return F.when(labels["quality"] == 0, 0).when((labels["quality"] == 1) & toxic, 1) \
        .when(labels["quality"] == 1, 2)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, value, first): the features of text i are ``first[i]:first[i + 1]``."""
    words = Words(texts, WORD_TABLE)
    n = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), n)
    h = words.hashes()
    # A word's shape: its bytes by class, runs collapsed.
    shape = np.frombuffer(words.raw.translate(_SHAPE), np.uint8)
    change = np.ones(len(shape), bool)
    change[1:] = shape[1:] != shape[:-1]
    change[words.start] = True
    packed = shape[change].tobytes() + b"\0" * 8
    kept = np.cumsum(change)
    start, stop = kept[words.start] - 1, kept[words.end - 1]
    view = np.ndarray((len(packed) - 7,), "<u8", packed, 0, (1,))
    s = hash_ranges(view, start, stop - start) ^ U(1)
    last = np.zeros(len(h), bool)
    last[words.first[1:][n > 0] - 1] = True
    pair = mixed(s * MULT ^ np.append(s[1:], U(0)) ^ U(2))[~last]
    lines = Words(texts, LINE_TABLE)
    stats = []
    hashes, line_hashes = h, lines.hashes()
    for i in range(len(texts)):
        own = hashes[words.first[i]:words.first[i + 1]]
        rows = line_hashes[lines.first[i]:lines.first[i + 1]]
        distinct = len(np.unique(own)) / max(1, len(own))
        unlike = len(np.unique(rows)) / max(1, len(rows))
        stats.append([3 + 100 * int(np.log2(len(own) + 1)), 4 + 100 * int(10 * distinct),
                      5 + 100 * int(10 * unlike)])
    stats = np.array(stats, U).reshape(len(texts), 3)
    share = 1.0 / np.maximum(1, n)
    owners = [owner, owner, owner[~last], np.repeat(np.arange(len(texts)), 3)]
    bucket = np.concatenate([h, s, pair, mixed(stats.ravel())]) & U(BUCKETS - 1)
    value = np.concatenate([SCALE * share[o] for o in owners[:3]] + [np.full(3 * len(texts), 0.2)])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    first = np.searchsorted(owners[order], np.arange(len(texts) + 1))
    return bucket[order].astype(np.int64), value[order].astype(np.float32), first


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: list[bytes], grade: np.ndarray, epochs: int = EPOCHS, batch: int = 32,
        rate: float = 0.1, seed: int = 5) -> Model:
    """Maximum likelihood by Adagrad; thresholds stay ordered as sums of positive steps."""
    parts = []
    for a, b in slices([len(t) for t in texts]):
        bucket, value, first = features(texts[a:b])
        for i in range(b - a):
            own, at = np.unique(bucket[first[i]:first[i + 1]], return_inverse=True)
            parts.append((own, np.bincount(at, value[first[i]:first[i + 1]], len(own))))
    m = int(grade.max())
    seen = np.zeros(BUCKETS, np.int32)
    for own, _ in parts:
        seen[own] += 1
    known = seen >= 3
    w = np.zeros(BUCKETS)
    lowest, steps = -1.0, np.zeros(m - 1)
    past = np.full(BUCKETS, 1e-6)
    past_t = np.full(m, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        for begin in range(0, len(order), batch):
            rows = order[begin:begin + batch]
            own = np.concatenate([parts[i][0] for i in rows])
            val = np.concatenate([parts[i][1] for i in rows])
            row = np.repeat(np.arange(len(rows)), [len(parts[i][0]) for i in rows])
            val = np.where(known[own], val, 0.0)
            f = np.bincount(row, w[own] * val, len(rows))
            t = lowest + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
            y = grade[rows]
            # log(s(t_{y+1} - f) - s(t_y - f)) by its two bounds.
            upper = np.where(y < m, _sigmoid(t[np.minimum(y, m - 1)] - f), 1.0)
            lower = np.where(y > 0, _sigmoid(t[np.maximum(y, 1) - 1] - f), 0.0)
            p = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
            df = (du - dl) / len(rows)  # gradient of the loss in f
            dt = np.zeros(m)
            np.add.at(dt, np.minimum(y, m - 1), np.where(y < m, -du, 0.0) / len(rows))
            np.add.at(dt, np.maximum(y, 1) - 1, np.where(y > 0, dl, 0.0) / len(rows))
            g = np.zeros(m)
            g[0] = dt.sum()
            if m > 1:
                g[1:] = np.cumsum(dt[::-1])[::-1][1:] * np.exp(steps)
            used, slot = np.unique(own, return_inverse=True)
            gw = np.bincount(slot, df[row] * val, len(used)) + 1e-5 * w[used]
            past[used] += gw * gw
            w[used] -= rate * gw / np.sqrt(past[used])
            past_t += g * g
            move = rate * g / np.sqrt(past_t)
            lowest -= move[0]
            steps -= move[1:]
    t = lowest + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    return Model(w.astype(np.float32), t)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` rated rows of each grade outside the held-out fold.

    Grades that do not occur keep their threshold beside the next one's.  With no
    rated row, or one grade only, every text gets that grade (2 when there is none).
    """
    rows = training_sample(docs, labels, grades(labels), {g: max_rows for g in (0, 1, 2)})
    grade = rows["label"].to_numpy(np.int64)
    if len(set(grade.tolist())) < 2:
        only = int(grade[0]) if len(grade) else 2
        return Model(np.zeros(BUCKETS, np.float32),
                     np.array([-40.0 if k <= only else 40.0 for k in (1, 2)]))
    model = fit(encoded(rows["text"].tolist()), grade)
    give_back()
    if len(model.thresholds) < 2:  # no grade 2 in the sample
        return Model(model.weight, np.append(model.thresholds, 40.0))
    return model


def _score(batches: Iterator[pa.RecordBatch], model, names: list[str]):
    for batch in batches:
        texts = encoded(batch.column("_text").to_pylist())
        for a, b in slices([len(t) for t in texts], SLICE):
            bucket, value, first = features(texts[a:b])
            sums = np.concatenate([[0.0], np.cumsum(model.value.weight[bucket] * value,
                                                    dtype=np.float64)])
            f = np.diff(sums[first])
            tails = [_sigmoid(f - t) for t in model.value.thresholds]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).slice(a, b - a).columns,
                 *[pa.array(x) for x in tails], pa.array(np.sum(tails, axis=0))],
                [*names, "tail_1", "tail_2", "expected_grade"])
    give_back()


def rate(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",),
         text: str = "text") -> DataFrame:
    """``keep`` columns, ``tail_1`` = P(grade >= 1), ``tail_2``, ``expected_grade`` per row.

    A null or empty text has no words; its length features alone rate it.  Repeated rows
    and null ids are rated like any others.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(keep))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    return docs.select(text_column(docs, text).alias("_text"),
                       *[docs[c].alias(n) for c, n in zip(keep, names)]).mapInArrow(
        lambda it: _score(it, shared, names),
        f"{schema}, tail_1 double, tail_2 double, expected_grade double") \
        .toDF(*keep, "tail_1", "tail_2", "expected_grade")
