"""Benchmark passages in texts, found with Wu-Manber multi-pattern search.

Symbols are words.  A pattern is a window of ``window`` consecutive words of a
benchmark item; an item with fewer words is one shorter pattern.  Patterns of one
length m are searched together with three structures:

* the *shift table*: for each hashed block of two words, the least distance from
  that block to the end of a pattern; a block that no pattern holds shifts by m - 1;
* *buckets*: pattern texts by the hash of their last block;
* direct comparison of the words with the patterns of the bucket.

A cursor starts at the end of each stride of m - 1 words (a block unknown to all
patterns skips the whole stride) and advances by its shift until it leaves the
stride; the cursors of many texts advance together as numpy arrays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import (
    MULT, U, Words, byte_table, encoded, give_back, mixed, prepare, slices, stored,
    text_column,
)

WINDOW = 10
#: Bytes of benchmark text that are broadcast and searched at a time.
BLOCK_BYTES = 2 << 20
#: A-Z are lowered; every byte but digits, letters and non-ASCII separates words.
WORD_TABLE = byte_table({*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})
_SHIFT_BITS = 22


def _block_hash(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed((first * MULT) ^ last)


class _Patterns:
    """Shift table and buckets of the patterns with ``m`` words."""

    def __init__(self, m: int, patterns: dict[bytes, set[str]]):
        self.m = m
        self.block = min(2, m)
        self.stride = m - self.block + 1
        texts = list(patterns)
        words = Words(texts, WORD_TABLE)
        h = words.hashes().reshape(len(texts), m)
        self.shift = np.full(1 << _SHIFT_BITS, self.stride, np.uint8 if m < 255 else np.int32)
        for end in range(self.block - 1, m):  # the last block shifts by 0
            b = self._hash(h[:, end - self.block + 1], h[:, end])
            np.minimum.at(self.shift, b >> U(64 - _SHIFT_BITS), m - 1 - end)
        self.bucket: dict[int, dict[bytes, tuple[str, ...]]] = defaultdict(dict)
        for t, b in zip(texts, self._hash(h[:, m - self.block], h[:, m - 1]).tolist()):
            self.bucket[b][t] = tuple(patterns[t])

    def _hash(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return _block_hash(first, last) if self.block == 2 else mixed(last)

    def find(self, words: Words) -> Iterator[tuple[int, tuple[str, ...]]]:
        """(last word, items) of each occurrence, in texts' order within a length."""
        first = words.first
        n = np.diff(first)
        strides = np.maximum(0, -(-(n - self.m + 1) // self.stride))
        text = np.repeat(np.arange(len(n)), strides)
        rank = np.arange(len(text)) - (np.cumsum(strides) - strides)[text]
        at = first[text] + self.m - 1 + rank * self.stride
        stop = np.minimum(at + self.stride, first[text + 1])
        while len(at):
            last = words.hashes(at)
            b = self._hash(words.hashes(at - 1), last) if self.block == 2 else mixed(last)
            move = self.shift[b >> U(64 - _SHIFT_BITS)].astype(np.int64)
            for i in np.flatnonzero(move == 0):
                bucket = self.bucket.get(int(b[i]))
                if bucket:
                    end = int(at[i])
                    text_ = b" ".join(words.bytes(j) for j in range(end - self.m + 1, end + 1))
                    items = bucket.get(text_)
                    if items is not None:
                        yield end, items
            at = at + np.maximum(move, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]


class Searcher:
    """All patterns of a block of benchmark items, by length."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        words = Words(encoded([t for _, t in items]), WORD_TABLE)
        by_length: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for i, (item, _) in enumerate(items):
            a, b = int(words.first[i]), int(words.first[i + 1])
            w = [words.bytes(j) for j in range(a, b)]
            m = min(window, len(w))
            for j in range(len(w) - m + 1 if m else 0):
                owners = by_length[m][b" ".join(w[j:j + m])]
                if item is not None:
                    owners.add(item)
        self.lengths = [_Patterns(m, p) for m, p in sorted(by_length.items())]

    def search(self, words: Words):
        """Per word whether it is hit; (word, items) of each occurrence."""
        edge = np.zeros(len(words.start) + 1, np.int32)
        found: list[tuple[int, tuple[str, ...]]] = []
        for patterns in self.lengths:
            for end, items in patterns.find(words):
                edge[end - patterns.m + 1] += 1
                edge[end + 1] -= 1
                found.append((end, items))
        return np.cumsum(edge[:-1]) > 0, found


_FOUND = "n_words long, hits array<struct<start:long,stop:long>>, items array<string>"
_HIT_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _search(batches: Iterator[pa.RecordBatch], model, names: list[str]):
    searcher = None
    for batch in batches:
        searcher = searcher or Searcher(model.value[0], model.value[1])
        texts = encoded(batch.column("_text").to_pylist())
        hits_before = batch.column("hits").to_pylist()
        items_before = batch.column("items").to_pylist()
        for a, b in slices([len(t) for t in texts]):
            words = Words(texts[a:b], WORD_TABLE)
            hit, found = searcher.search(words)
            first = words.first
            items: list[set[str]] = [set(x or ()) for x in items_before[a:b]]
            for end, owners in found:
                items[int(np.searchsorted(first, end, "right")) - 1].update(owners)
            hits = []
            for i in range(b - a):
                own = hit[first[i]:first[i + 1]]
                for r in hits_before[a + i] or ():
                    own[r["start"]:r["stop"]] = True
                step = np.flatnonzero(np.diff(own, prepend=False, append=False))
                hits.append([{"start": s, "stop": e} for s, e in zip(step[0::2], step[1::2])])
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*part.select(["_text", *names]).columns, pa.array(np.diff(first), pa.int64()),
                 pa.array(hits, _HIT_TYPE),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                ["_text", *names, "n_words", "hits", "items"])
    give_back()


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    rows = benchmark.select(benchmark["item_id"].cast("string"),
                            text_column(benchmark).alias("text")).orderBy("item_id", "text")
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and size + len(r["text"]) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if block:
        yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, ``n_words``, ``hits`` (word ranges), ``items`` (sorted ids) per row.

    The benchmark is searched in blocks of ``BLOCK_BYTES``, each broadcast by itself,
    so what a task holds is bounded at any benchmark size.  A null or empty text has
    no words; an item without words has no pattern; an item with a null id hits words
    but is not listed; repeated rows and items count as they stand, an id once per text.
    An empty benchmark hits nothing.  Columns beside those named are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = [f"c{i}" for i in range(len(keep))]
    schema = "_text string, " + ", ".join(
        f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    out = docs.select(
        text_column(docs, text).alias("_text"), *[docs[c].alias(n) for c, n in zip(keep, names)],
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<start:long,stop:long>>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"))
    searched = False
    for block in _blocks(benchmark) if benchmark.take(1) else [[]]:
        if searched:  # one block's tables in memory at a time
            out = stored(out, "benchmark_hits")
        model = spark.sparkContext.broadcast((block, window))
        out = out.mapInArrow(lambda it, m=model: _search(it, m, names), f"{schema}, {_FOUND}")
        searched = True
    return out.drop("_text").toDF(*keep, "n_words", "hits", "items")
