"""Toxicity of texts: averaged subword-bag embeddings with a linear softmax.

A word is the average of the vectors of its character n-grams and of itself, a text the
average of its words; vectors and softmax weights are trained together in numpy on a
bounded sample of labelled rows.  An unseen misspelling or inflection shares n-grams with
the words it comes from.  Scoring needs one number per n-gram bucket (``BUCKETS``
floats, broadcast) and reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Words, byte_table, prepare, slices, text_column
from quayside.llm.labelled import training_sample
from quayside.llm.subwords import SCALE, fit_softmax, word_units

#: Rows of a label in the training sample, at most.
MAX_ROWS = {1: 1500, 0: 2500}
EPOCHS = 5
WORD_TABLE = byte_table({*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})


@dataclass(frozen=True)
class Model:
    logit: np.ndarray
    bias: float


def _lowered(texts: list[str]) -> list[bytes]:
    return [t.lower().encode("utf-8", "surrogatepass") for t in texts]


def _distinct(words: Words) -> tuple[np.ndarray, list[bytes]]:
    """Number of each word among the distinct ones, and these."""
    _, at, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return number, [words.bytes(i) for i in at.tolist()]


def train(docs: DataFrame, labels: DataFrame, bounds: dict[int, int] | None = None,
          epochs: int = EPOCHS) -> Model:
    """Fit on at most ``MAX_ROWS`` rows of each label outside the held-out fold.

    With no rows of a label there is nothing to learn: every text then has the score 0
    (no toxic rows) or 1 (toxic rows only).
    """
    rows = training_sample(docs, labels, F.col("toxic"), bounds or MAX_ROWS)
    label = rows["label"].to_numpy(np.int64)
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(1, np.float32), 60.0 if label.any() else -60.0)
    words = Words(_lowered(rows["text"].tolist()), WORD_TABLE)
    number, distinct = _distinct(words)
    bags = [np.unique(number[a:b], return_counts=True)
            for a, b in zip(words.first[:-1], words.first[1:])]
    return Model(*fit_softmax(bags, distinct, label, epochs))


def text_logits(texts: list[str], model: Model) -> np.ndarray:
    """Log-odds of toxicity; a text without words has the bias alone."""
    words = Words(_lowered(texts), WORD_TABLE)
    if not len(words.start) or len(model.logit) == 1:
        return np.full(len(texts), model.bias)
    number, distinct = _distinct(words)
    units, first = word_units(distinct)
    per_word = np.add.reduceat(model.logit[units], first[:-1]) / np.diff(first)
    sums = np.concatenate([[0.0], np.cumsum(per_word[number], dtype=np.float64)])[words.first]
    n = np.maximum(1, np.diff(words.first))
    return model.bias + SCALE * np.diff(sums) / n


def _score(batches: Iterator[pa.RecordBatch], model):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in slices([len(t) for t in texts], 3 << 20):
            logit = np.clip(text_logits(texts[a:b], model.value), -60, 60)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(a, b - a), pa.array(1 / (1 + np.exp(-logit)))],
                ["key", "score"])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` (0 to 1) per row; only the text bears on the score.

    A null or empty text, or one without words, has the score of the bias.  Repeated rows
    and null keys are scored like any others.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(docs[key].alias("key"), text_column(docs, text).alias("text")).mapInArrow(
        lambda it: _score(it, shared),
        f"key {docs.schema[key].dataType.simpleString()}, score double") \
        .toDF(key, "score")
