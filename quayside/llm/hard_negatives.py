"""Hard negatives of embedding anchors, scored with Kronecker-packed products.

Components are quantised to integers.  A block of candidates is packed once for each
component: less their minimum, so that none is negative, the components of several
candidates lie in separated fields of one wide integer.  One multiplication by an anchor's
component (less its minimum too) then multiplies all of them, and the sum over the
components holds the scores of these candidates in its fields, as no field can overflow.
What the minima added is subtracted when the fields are unpacked.  Words have 64 bits where
fields and sums fit, else they are Python integers: scores are exact at any magnitude.

Rows are packed in blocks ordered by label.  Every block of anchors meets every block of
candidates that matters, in one join on (block of anchors, share of the candidates); a task
keeps the best few rows of each anchor over all blocks that it sees, and a window merges
what the shares have found.  Positives come from blocks that share a label; negatives from
blocks with another one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import drop_stored, prepare, stored
from quayside.session import scratch_path

#: Rows of a block.
ANCHORS, CANDIDATES = 16_384, 2_048
#: Scores held at a time.
SCORES = 1 << 20
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: Bytes of a score beyond 64 bits, as an unsigned number that sorts as the score does.
_WIDE = 272
_BLOCK = ("block long, label_set array<long>, ids array<long>, labels array<long>, "
          "sizes array<int>, parts array<{}>")


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as int64 where they fit, else as Python integers."""
    x = values.astype(np.float64)
    with np.errstate(over="ignore"):
        q = np.floor(scale * x)
    if np.isfinite(q).all() and (np.abs(q) < 1 << 53).all():
        return q.astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 1 << 53 else math.floor(scale * v)
                     for v in x.tolist()], object)


def matrix(values: np.ndarray, sizes: np.ndarray, width: int, scale: int) -> np.ndarray:
    """One quantised vector per row; a shorter one ends in zeros."""
    q = quantised(values, scale)
    out = np.zeros((len(sizes), width), q.dtype)
    out[np.arange(width) < sizes[:, None]] = q
    return out


class PackedBlock:
    """Candidates of a block, their components packed for a given block of anchors."""

    def __init__(self, candidates: np.ndarray, low: np.ndarray, high: np.ndarray):
        """``low``, ``high``: least and greatest component of the anchors, per column."""
        n, width = candidates.shape
        self.n, self.low = n, low
        least = candidates.min(axis=0) if n else np.zeros(width, candidates.dtype)
        most = candidates.max(axis=0) if n else least
        exact = [[int(v) for v in row] for row in (low, high, least, most)]
        field = sum((b - a) * (d - c) for a, b, c, d in zip(*exact))
        reach = sum(max(-a, b, 0) * max(-c, d, 0) for a, b, c, d in zip(*exact)) \
            + sum(max(abs(a), abs(b)) * (abs(c) + abs(d)) + abs(a) * (d - c)
                  for a, b, c, d in zip(*exact))
        self.bits = max(1, field.bit_length())
        small = self.bits <= 62 and reach < 1 << 62
        self.kind = np.dtype(np.uint64) if small else np.dtype(object)
        self.sums = np.dtype(np.int64) if small else np.dtype(object)
        fields = 64 // self.bits if small else 8
        self.words = max(1, -(-n // fields))
        self.fields = -(-n // self.words)
        self.least = least.astype(self.sums)
        raised = (candidates.astype(self.sums) - self.least).astype(self.kind)
        packed = np.zeros((width, self.words), self.kind)
        for k in range(self.fields):
            part = raised[k * self.words:(k + 1) * self.words].T
            packed[:, :part.shape[1]] += part << self._number(k * self.bits)
        self.packed = packed
        self.from_low = raised.astype(self.sums) @ low.astype(self.sums)

    def _number(self, value: int):
        return np.uint64(value) if self.kind == np.uint64 else value

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates."""
        own = anchors.astype(self.sums)
        product = (own - self.low.astype(self.sums)).astype(self.kind) @ self.packed
        mask = self._number((1 << self.bits) - 1)
        out = np.concatenate(
            [((product >> self._number(k * self.bits)) & mask).astype(self.sums)
             for k in range(self.fields)] or [product[:, :0].astype(self.sums)], axis=1)
        return out[:, :self.n] + (own @ self.least)[:, None] + self.from_low


def best(scores: np.ndarray, fits: np.ndarray, order: np.ndarray, k: int):
    """(row, column) of the ``k`` first columns of each row: highest score, least order."""
    if not scores.size or not fits.any():
        return np.zeros((2, 0), np.int64)
    n = scores.shape[1]
    if scores.dtype == object or max(int(scores.max()), -int(scores.min())) >= (1 << 62) // n:
        found = [(i, j) for i in range(len(scores)) for j in
                 sorted(np.flatnonzero(fits[i]).tolist(),
                        key=lambda c, i=i: (-int(scores[i, c]), order[c]))[:k]]
        return np.array(found, np.int64).reshape(-1, 2).T
    key = np.where(fits, scores * n + (n - 1 - order), _LEAST)
    if n > k:
        column = np.argpartition(key, n - k, axis=1)[:, n - k:]
    else:
        column = np.broadcast_to(np.arange(n), key.shape)
    there = np.take_along_axis(key, column, axis=1) != _LEAST
    return np.stack([np.nonzero(there)[0], column[there]])


class _Best:
    """The first ``k`` of (anchor, slot) over several blocks."""

    def __init__(self, k: int):
        self.k = k
        self._forget()

    def _forget(self) -> None:
        self.key: list[np.ndarray] = []
        self.id: list[np.ndarray] = []
        self.score: list[np.ndarray] = []
        self.held = 0

    def add(self, key: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.key.append(key)
        self.id.append(ids)
        self.score.append(scores)
        self.held += len(key)
        if self.held > 4 * SCORES:
            self._cut()

    def _cut(self) -> None:
        key, ids, score = (np.concatenate(x) for x in (self.key, self.id, self.score))
        if score.dtype == object:
            at = np.array(sorted(range(len(key)), key=lambda i: (key[i], -score[i], ids[i])),
                          np.int64)
        else:
            at = np.lexsort((ids, -score, key))
        key, ids, score = key[at], ids[at], score[at]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(first, append=len(key)))
        keep = rank < self.k
        self.key, self.id, self.score = [key[keep]], [ids[keep]], [score[keep]]
        self.held = int(keep.sum())

    def take(self):
        if self.key:
            self._cut()
            out = self.key[0], self.id[0], self.score[0]
            self._forget()
            return out
        return None


def _as_columns(scores: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Scores as longs (the nearest one), and those beyond a long exactly, as sortable bytes."""
    if scores.dtype != object:
        return pa.array(scores), pa.nulls(len(scores), pa.binary())
    exact = [int(s) for s in scores]
    near = [min(max(s, _LEAST), _MOST) for s in exact]
    wide = [None if _LEAST < s < _MOST else (s + (1 << 8 * _WIDE - 1)).to_bytes(_WIDE, "big")
            for s in exact]
    return pa.array(near, pa.int64()), pa.array(wide, pa.binary())


def _exact(score: int, wide: bytes | None) -> int:
    return score if wide is None else int.from_bytes(wide, "big") - (1 << 8 * _WIDE - 1)


def _pack(batches: Iterator[pa.RecordBatch], size: int):
    """Consecutive rows as blocks of ``size`` rows at most, numbered over all tasks."""
    number, held, rows = TaskContext.get().partitionId() << 32, [], 0

    def block(tables):
        nonlocal number
        part = pa.Table.from_batches(tables).combine_chunks()
        vectors = part["vector"].combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.chunk(0)
        label = part["label"].to_numpy()
        one = [pa.array([number], pa.int64()), pa.array([np.unique(label)], pa.list_(pa.int64())),
               pa.array([part["vec_id"].to_numpy()], pa.list_(pa.int64())),
               pa.array([label], pa.list_(pa.int64())),
               pa.array([np.diff(vectors.offsets.to_numpy())], pa.list_(pa.int32())),
               pa.array([vectors.flatten().to_numpy()], pa.list_(vectors.type.value_type))]
        number += 1
        return pa.RecordBatch.from_arrays(
            one, ["block", "label_set", "ids", "labels", "sizes", "parts"])

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield block(held)
                held, rows = [], 0
    if rows:
        yield block(held)


class _Rows:
    """A packed block of rows, read from a joined row."""

    def __init__(self, batch: pa.RecordBatch, at: int, prefix: str = ""):
        def get(name):
            return batch.column(prefix + name)[at].values.to_numpy(zero_copy_only=False)
        self.ids, self.labels, self.sizes = get("ids"), get("labels"), get("sizes")
        self.parts = get("parts")
        self.width = int(self.sizes.max(initial=0))

    def matrix(self, width: int, scale: int) -> np.ndarray:
        return matrix(self.parts, self.sizes, width, scale)


def _scored(anchors: _Rows, candidates: _Rows, scale: int):
    """(begin, end, scores) for slices of the anchors."""
    width = max(anchors.width, candidates.width)
    a, c = anchors.matrix(width, scale), candidates.matrix(width, scale)
    block = PackedBlock(c, a.min(axis=0), a.max(axis=0))
    step = max(1, SCORES // max(1, len(c)))
    for begin in range(0, len(a), step):
        yield begin, min(begin + step, len(a)), block.scores(a[begin:begin + step])


def _by_anchors(batches: Iterator[pa.RecordBatch], begin, use, flush):
    """Run ``use`` on each joined row; anchors are read once while they stay the same."""
    now, anchors = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            key = batch.column("a")[i].as_py(), batch.column("share")[i].as_py()
            if key != now:
                if now is not None:
                    yield from flush(now[0], anchors)
                now, anchors = key, _Rows(batch, i, "a_")
                begin(batch, i)
            use(anchors, _Rows(batch, i))
    if now is not None:
        yield from flush(now[0], anchors)


def _positives(batches: Iterator[pa.RecordBatch], scale: int, k: int):
    top = _Best(k)

    def use(anchors: _Rows, candidates: _Rows) -> None:
        order = np.empty(len(candidates.ids), np.int64)
        order[np.argsort(candidates.ids, kind="stable")] = np.arange(len(order))
        for begin, end, scores in _scored(anchors, candidates, scale):
            fits = (anchors.labels[begin:end, None] == candidates.labels) \
                & (anchors.ids[begin:end, None] != candidates.ids)
            row, column = best(scores, fits, order, k)
            top.add(row + begin, candidates.ids[column], scores[row, column])

    def flush(a: int, anchors: _Rows):
        found = top.take()
        if found:
            at, ids, scores = found
            near, wide = _as_columns(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), a)), pa.array(at.astype(np.int32)), pa.array(ids),
                 near, wide], ["a", "at", "positive_id", "positive_score", "wide"])

    yield from _by_anchors(batches, lambda batch, i: None, use, flush)


def _negatives(batches: Iterator[pa.RecordBatch], scale: int, k: int, band: tuple[int, int, int]):
    low, over, high = band
    top = _Best(k)
    slots: list[np.ndarray] = []

    def begin_anchors(batch: pa.RecordBatch, i: int) -> None:
        """Per slot of a positive: its anchors and the least and the greatest score allowed."""
        positives = sorted(batch.column("positives")[i].as_py(),
                           key=lambda p: (p["slot"], p["at"]))
        slots.clear()
        held.clear()
        held.update({(p["at"], p["slot"]): p for p in positives})
        for slot in sorted({p["slot"] for p in positives}):
            own = [p for p in positives if p["slot"] == slot]
            exact = [_exact(p["positive_score"], p["wide"]) for p in own]
            least, most = [-(-low * s // over) for s in exact], [high * s // over for s in exact]
            kind = np.int64 if all(_LEAST <= x <= _MOST for x in [*least, *most]) else object
            slots.append((slot, np.array([p["at"] for p in own], np.int64),
                          np.array(least, kind), np.array(most, kind)))

    held: dict[tuple[int, int], dict] = {}

    def use(anchors: _Rows, candidates: _Rows) -> None:
        order = np.empty(len(candidates.ids), np.int64)
        order[np.argsort(candidates.ids, kind="stable")] = np.arange(len(order))
        for begin, end, scores in _scored(anchors, candidates, scale):
            other = anchors.labels[begin:end, None] != candidates.labels
            for slot, at, least, most in slots:
                lo, hi = np.searchsorted(at, [begin, end])
                own = at[lo:hi] - begin
                if not len(own):
                    continue
                s = scores if len(own) == end - begin else scores[own]
                fits = (s >= least[lo:hi, None]) & (s <= most[lo:hi, None]) \
                    & (other if len(own) == end - begin else other[own])
                row, column = best(s, fits.astype(bool), order, k)
                top.add(at[lo:hi][row] * _SLOTS + slot, candidates.ids[column], s[row, column])

    def flush(a: int, anchors: _Rows):
        found = top.take()
        if found:
            key, ids, scores = found
            at, slot = key // _SLOTS, key % _SLOTS
            own = [held[x] for x in zip(at.tolist(), slot.tolist())]
            near, wide = _as_columns(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), a)), pa.array(at.astype(np.int32)),
                 pa.array(slot.astype(np.int32)), pa.array(anchors.ids[at]),
                 pa.array([p["positive_id"] for p in own], pa.int64()),
                 pa.array([p["positive_score"] for p in own], pa.int64()), pa.array(ids), near,
                 wide],
                ["a", "at", "slot", "anchor_id", "positive_id", "positive_score", "negative_id",
                 "negative_score", "wide"])

    yield from _by_anchors(batches, begin_anchors, use, flush)


#: More than the positives of an anchor can be.
_SLOTS = 1 << 20


def valid_rows(vectors: DataFrame) -> DataFrame:
    """Rows that take part: ``vec_id``, ``label`` (one changed where 7 divides the id), ``vector``."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    element = element if element == "float" else "double"
    label = F.col("label").cast("decimal(20,0)")
    return vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].alias("label"),
        vectors["embedding"].cast(f"array<{element}>").alias("vector"),
    ).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                   & (F.abs(x) != F.lit(float("inf"))))
    ).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
                 .cast("long"))


def _blocks(rows: DataFrame, parts: int, size: int, path: str) -> DataFrame:
    element = rows.schema["vector"].dataType.elementType.simpleString()
    packed = rows.repartitionByRange(parts, "label", "vec_id") \
        .sortWithinPartitions("label", "vec_id") \
        .mapInArrow(lambda it: _pack(it, size), _BLOCK.format(element))
    return stored(packed, "", path)


def _meet(candidates: DataFrame, anchors: DataFrame, parts: int, shares: int) -> DataFrame:
    """Candidates (with the number ``a`` of a block of anchors) beside those anchors."""
    left = candidates.withColumn("share", F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int")) \
        .repartition(parts, "a", "share")
    right = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), "*")
    right = right.select(F.col("block").alias("a"), "share",
                         *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "sizes", "parts")],
                         *[c for c in right.columns if c == "positives"])
    right = right.repartition(parts, "a", "share")
    return left.join(right.hint("merge"), ["a", "share"])


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
                   band: tuple[int, int, int] = (30, 100, 90), scale: int = 256) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``.  Their positives are the
    first rows of the same label and another id, by score and id; a positive's negatives the
    first rows of other labels with ``band[0] * positive <= band[1] * negative <= band[2] *
    positive``.  Rows with a null id, label, vector or component, or a component that is not
    finite, take no part.  Every row counts by itself: a repeated row takes a place (and is
    an anchor) again, but is never a positive or negative of its own id.  Of vectors of
    unlike length the shorter one ends in zeros.  A score beyond 64 bits is compared exactly
    and reported as the nearest long.  An empty table gives no rows; columns other than
    vec_id, embedding and label are not read.
    """
    spark: SparkSession = vectors.sparkSession
    prepare(spark)
    rows = valid_rows(vectors)
    anchor_rows = rows.filter(F.col("vec_id") % every == 0)
    n_rows, n_anchors = (x.select("vec_id").count() for x in (rows, anchor_rows))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    paths = [scratch_path(spark, "llm", x) for x in ("vectors", "anchors", "positives")]
    candidates = _blocks(rows, max(parts, -(-n_rows // (32 * CANDIDATES))), CANDIDATES, paths[0])
    anchors = _blocks(anchor_rows, max(1, -(-n_anchors // ANCHORS)), ANCHORS, paths[1])
    n_blocks = max(1, candidates.count())
    numbers = [r["block"] for r in anchors.select("block").collect()]  # one of ANCHORS anchors
    shares = max(1, min(n_blocks, -(-4 * parts // max(1, len(numbers)))))

    pairs = candidates.select("block", F.explode("label_set").alias("label")).join(
        anchors.select(F.col("block").alias("a"), F.explode("label_set").alias("label")),
        "label").select("block", "a").distinct()
    met = _meet(candidates.join(pairs, "block"), anchors, parts, shares)
    by_anchor = Window.partitionBy("a", "at").orderBy(
        F.desc("positive_score"), F.desc("wide"), "positive_id")
    own = met.mapInArrow(
        lambda it: _positives(it, scale, positives),
        "a long, at int, positive_id long, positive_score long, wide binary") \
        .withColumn("slot", F.row_number().over(by_anchor)).filter(F.col("slot") <= positives) \
        .groupBy("a").agg(F.collect_list(F.struct(
            "at", "slot", "positive_id", "positive_score", "wide")).alias("positives"))
    own = stored(own, "", paths[2])

    with_positives = anchors.join(own, anchors["block"] == own["a"]).drop("a")
    others = candidates.withColumn("a", F.explode(F.array(*map(F.lit, numbers)).cast("array<long>")))
    met = _meet(others, with_positives, parts, shares)
    by_positive = Window.partitionBy("a", "at", "slot").orderBy(
        F.desc("negative_score"), F.desc("wide"), "negative_id")
    found = met.mapInArrow(
        lambda it: _negatives(it, scale, negatives, band),
        "a long, at int, slot int, anchor_id long, positive_id long, positive_score long, "
        "negative_id long, negative_score long, wide binary") \
        .withColumn("rank", F.row_number().over(by_positive)).filter(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")
    out = stored(found, "hard_negatives")
    for path in paths:
        drop_stored(spark, path)
    return out


def negatives_sql() -> str:
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER
         AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
