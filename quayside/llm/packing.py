"""Mixture-controlled packing of tokenised texts into sequences.

Each source has a queue of token ids; every window of ``window`` tokens is filled
from all queues in the target proportions by deficit round-robin: per window a
source earns its quantum, sends the whole part of its deficit, and keeps the
rest; tokens still missing go round the sources with the largest deficits.  A
source that runs out leaves its share to the others in proportion.

Windows are numbered over the whole corpus and are scheduled in blocks.  The state
with which a block begins (tokens sent and deficit of each source) is a closed
form: token g of a source of weight w is due at virtual time (g + 1/2) / w, and the
first T tokens in order of their due times have been sent.  So every partition
computes the blocks it touches by itself, deficits carry from window to window
and from block to block, and no task sees more than its own rows.

Every source has its own queue.  Those beyond the largest ``MAX_QUEUES`` that are not named
in the proportions are dealt into groups, and a group's tokens are put in order by the same
schedule over the queues of its sources; the group is one queue of the outer schedule.

Work per row: texts are tokenised once and the ids stored; queue positions are a
running count inside a stored partition plus the totals of the partitions before.
"""

from __future__ import annotations

import functools
from collections import OrderedDict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import give_back, prepare, slices, stored, text_column

WINDOW = 4096
END_ID = 2
#: Sources with a queue in the outer schedule, besides named ones; groups of others at most.
MAX_QUEUES = 1024
#: Sources in a group, about (more, if there are over ``MAX_QUEUES`` such groups).
GROUP = 512


class Schedule:
    """Deficit round-robin over queues with ``total`` tokens and given ``weight``."""

    def __init__(self, total: Sequence[int], weight: Sequence[float], window: int,
                 cells: int = 65536, least: int = 16, keep: int = 32):
        self.total = np.asarray(total, np.int64)
        self.weight = np.asarray(weight, np.float64)
        self.window = window
        self.all = int(self.total.sum())
        self.per_block = max(least, min(1024, cells // max(1, len(total))))
        self.keep = keep
        self._cache: OrderedDict[int, tuple] = OrderedDict()

    def sent(self, tau: float) -> np.ndarray:
        """Tokens of each queue that are due by virtual time ``tau``."""
        return np.minimum(self.total, np.floor(self.weight * tau + 0.5).astype(np.int64))

    def state(self, tokens: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens sent and deficits when ``tokens`` have gone out in all."""
        if tokens >= self.all:
            return self.total.copy(), np.zeros(len(self.total))
        low, high = 0.0, float(np.max((self.total + 1) / self.weight))
        while True:
            mid = (low + high) / 2
            if not low < mid < high:
                break
            if int(self.sent(mid).sum()) <= tokens:
                low = mid
            else:
                high = mid
        done = self.sent(low)
        left = tokens - int(done.sum())
        while left:  # tokens due at the same time: one each, in queue order
            due = np.where(done < self.total, (done + 0.5) / self.weight, np.inf)
            first = np.argsort(due, kind="stable")[:left]
            first = first[done[first] < self.total[first]]
            done[first] += 1
            left -= len(first)
        deficit = np.where(done < self.total, self.weight * low + 0.5 - done, 0.0)
        return done, deficit

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Of block ``b``: tokens sent before each window, and each queue's offset in it."""
        if b in self._cache:
            self._cache.move_to_end(b)
            return self._cache[b]
        span = self.per_block * self.window
        done, deficit = self.state(b * span)
        goal, _ = self.state((b + 1) * span)
        left = goal - done
        tokens = int(left.sum())
        n = -(-tokens // self.window)
        quantum = left / max(1.0, tokens / self.window)
        before = np.empty((n + 1, len(done)), np.int64)
        before[0] = done
        for i in range(n):
            size = min(self.window, tokens - i * self.window)
            deficit = deficit + quantum
            take = np.clip(np.floor(deficit).astype(np.int64), 0, left)
            over = int(take.sum()) - size
            while over < 0:
                order = np.argsort(take - deficit, kind="stable")
                order = order[take[order] < left[order]][:-over]
                take[order] += 1
                over += len(order)
            while over > 0:
                order = np.argsort(deficit - take, kind="stable")
                order = order[take[order] > 0][:over]
                take[order] -= 1
                over -= len(order)
            left = left - take
            deficit = np.where(left > 0, deficit - take, 0.0)
            before[i + 1] = before[i] + take
        take = np.diff(before, axis=0)
        offset = np.cumsum(take, axis=1) - take
        self._cache[b] = before, offset
        if len(self._cache) > self.keep:
            self._cache.popitem(last=False)
        return self._cache[b]

    def cuts(self, queue: int, start: int, stop: int) -> Iterator[tuple[int, int, int, int]]:
        """(from, to, window number, offset) of the pieces of a range of a queue."""
        tau = (start + 0.5) / self.weight[queue]
        b = int(self.sent(tau).sum()) // (self.per_block * self.window)
        while b > 0 and self.block(b)[0][0, queue] > start:
            b -= 1
        while start < stop:
            before, offset = self.block(b)
            column = before[:, queue]
            if column[-1] > start:
                i = int(np.searchsorted(column, start, "right")) - 1
                while start < stop and i < len(offset):
                    end = min(stop, int(column[i + 1]))
                    if end > start:
                        yield (start, end, b * self.per_block + i,
                               int(offset[i, queue] + start - column[i]))
                        start = end
                    i += 1
            b += 1


class Groups:
    """Schedules inside groups of sources; ``total[first[g]:first[g + 1]]`` are group g's.

    Holds 8 bytes for each source; a schedule is built when a row of its group comes.
    """

    def __init__(self, first: np.ndarray, total: np.ndarray):
        self.first, self.total = first, total
        self.share = [0.0] * (len(first) - 1)  # tokens of a group in an outer window
        self._made: dict[int, Schedule] = {}

    def cuts(self, group: int, member: int, start: int, stop: int) \
            -> Iterator[tuple[int, int, int]]:
        """(from, to, position of from in the group's queue) of a range of a source's queue."""
        if group not in self._made:
            own = self.total[self.first[group]:self.first[group + 1]]
            # Blocks of few windows: a task may hold two of each group.
            window = max(len(own), round(self.share[group]))
            self._made[group] = Schedule(own, own, window, 8192, 1, 2)
        made = self._made[group]
        for a, b, window, offset in made.cuts(member, start, stop):
            yield a, b, window * made.window + offset


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from quayside.llm.tokens import WordTokenizer

    return WordTokenizer(path)


_TOKENS = "chunk int, source string, doc_id long, at long, doc_tokens long, ids binary"


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, end_id: int):
    chunk = TaskContext.get().partitionId()
    at: dict[str, int] = {}
    for batch in batches:
        text, source, doc_id = (batch.column(c) for c in ("text", "source", "doc_id"))
        texts = text.to_pylist()
        sources = source.to_pylist()
        for a, b in slices([len(t) for t in texts]):
            ids = [np.append(x, np.uint16(end_id)) for x in _tokenizer(path).encode(texts[a:b])]
            begin = []
            for s, x in zip(sources[a:b], ids):
                begin.append(at.get(s, 0))
                at[s] = begin[-1] + len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, chunk, np.int32)), pa.array(sources[a:b], pa.string()),
                 doc_id.slice(a, b - a), pa.array(begin, pa.int64()),
                 pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.tobytes() for x in ids], pa.binary())],
                ["chunk", "source", "doc_id", "at", "doc_tokens", "ids"])
    give_back()


_PIECES = ("doc_id long, source string, start long, length long, doc_tokens long, "
           "sequence_id long, offset long, ids binary")


def _cut(batches: Iterator[pa.RecordBatch], schedule: Schedule, groups: Groups | None):
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in
                ("doc_id", "source", "queue", "member", "position", "doc_tokens")]
        stored_ids = batch.column("ids")
        out: list[tuple] = []
        size = 0
        for i, (doc_id, source, queue, member, position, n) in enumerate(zip(*rows)):
            ids = np.frombuffer(stored_ids[i].as_py(), np.uint16).astype("<u4")
            if member is None:
                runs = [(position, position + n, queue, position)]
            else:
                runs = ((a, b, len(schedule.total) - len(groups.first) + 1 + queue, at) for a, b, at in
                        groups.cuts(queue, member, position, position + n))
            for start, stop, own, at in runs:
                for a, b, window, offset in schedule.cuts(own, at, at + stop - start):
                    a, b = a - at + start - position, b - at + start - position
                    last = out[-1] if out else None
                    if a and last and last[5] == window and last[6] + last[3] == offset:
                        # The text goes on where its piece before ended.
                        out[-1] = (doc_id, source, last[2], last[3] + b - a, n, window, last[6],
                                   last[7] + ids[a:b].tobytes())
                    else:
                        out.append((doc_id, source, a, b - a, n, window, offset,
                                    ids[a:b].tobytes()))
            size += 4 * n
            if size > 1 << 21:
                yield _pieces(out)
                out, size = [], 0
        if out:
            yield _pieces(out)
    give_back()


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.binary()]
    names = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         proportions: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces of all texts: where each run of a text's ids lies in which sequence.

    ``proportions`` are relative weights of sources, all above 0; a source that is
    not named has its number of tokens as weight, scaled so that the named ones
    keep their relation to the average of the rest.  Without them each
    source's weight is its number of tokens, so all end together.

    Sequences are full windows; only the last one may be shorter.  A null or empty
    text is the end id alone; a null source is the source ''.  Repeated rows are packed
    as often as they occur, a null doc_id stays null.  No rows give no pieces.  Only
    ``doc_id``, ``text`` and ``source`` of ``docs`` are read.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = F.coalesce(docs["source"].cast("string"), F.lit(""))
    tokens = stored(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), source.alias("source"),
                    text_column(docs).alias("text"))
        .mapInArrow(lambda it: _tokenise(it, tokenizer_path, end_id), _TOKENS), "pack_tokens")
    chunks = stored(
        tokens.groupBy("chunk", "source").agg(F.sum("doc_tokens").alias("n")), "pack_chunks")
    sizes = chunks.groupBy("source").agg(F.sum("n").alias("n"))
    named = proportions or {}
    largest = sizes.orderBy(F.desc("n"), "source").limit(MAX_QUEUES).collect()
    # Bounded: MAX_QUEUES rows and those that the caller names.
    top = {r.source: int(r.n) for r in [*largest, *(
        sizes.filter(F.col("source").isin(list(named))).orderBy(F.desc("n"), "source").collect()
        if named else [])]}
    queues = spark.createDataFrame([(s, i) for i, s in enumerate(top)], "source string, queue int")
    total, groups = list(top.values()), None
    places = queues.withColumn("member", F.lit(None).cast("int")).withColumn("size", F.lit(1))
    if len(largest) == MAX_QUEUES:
        others = sizes.join(F.broadcast(queues), "source", "left_anti")
        n_groups = min(MAX_QUEUES, -(-others.count() // GROUP))
        if n_groups:
            inside, groups = _groups(others, n_groups)
            total += np.add.reduceat(groups.total, groups.first[:-1]).tolist()
            places = places.unionByName(inside)
    weight = _weights(list(top), total, named)
    schedule = Schedule(total, weight, window)
    if groups is not None:
        groups.share = [window * w / sum(weight) for w in weight[len(top):]]

    before = F.sum("n").over(_window("source").orderBy("chunk").rowsBetween(_FIRST, -1))
    base = stored(
        chunks.join(places, "source")
        .select("chunk", "source", "queue", "member", "size",
                F.coalesce(before, F.lit(0)).alias("base")),
        "pack_base")
    placed = tokens.join(base, ["chunk", "source"]).select(
        "doc_id", "source", "queue", "member", "size", (F.col("base") + F.col("at")).alias("position"),
        "doc_tokens", "ids")
    if groups is not None:  # rows that are due at about the same time share blocks
        placed = placed.sortWithinPartitions(
            F.when(F.col("member").isNotNull(), F.col("position") / F.col("size")))
    return placed.drop("size").mapInArrow(lambda it: _cut(it, schedule, groups), _PIECES)


def _groups(others: DataFrame, n_groups: int) -> tuple[DataFrame, Groups]:
    """Group, number in the group and size of each source, and the groups' schedules."""
    group = F.pmod(F.xxhash64("source"), F.lit(n_groups)).cast("int")
    placed = others.withColumn("group", group)
    number = F.row_number().over(_window("group").orderBy("source"))
    inside = stored(placed.withColumn("member", number - 1), "pack_groups")
    # 16 bytes a source: no names.
    rows = inside.select("group", "member", "n").toPandas().sort_values(["group", "member"])
    used, count = np.unique(rows["group"].to_numpy(), return_counts=True)
    first = np.concatenate([[0], np.cumsum(count)])
    queue = others.sparkSession.createDataFrame(
        [(int(g), i) for i, g in enumerate(used)], "group int, queue int")  # n_groups at most
    inside = inside.join(F.broadcast(queue), "group").select(
        "source", "queue", "member", F.col("n").alias("size"))
    return inside, Groups(first, rows["n"].to_numpy())


def _window(*columns: str):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


_FIRST = -(1 << 63)


def _weights(names: list[str], total: list[int], proportions: Mapping[str, float]) -> list[float]:
    if any(w <= 0 for w in proportions.values()):
        raise ValueError("proportions must be above 0")
    named = [proportions.get(s) for s in names] + [None] * (len(total) - len(names))
    given = sum(w for w in named if w)
    tokens = sum(n for n, w in zip(total, named) if w)
    scale = tokens / given if given else 1.0
    return [w * scale if w else float(n) for n, w in zip(total, named)]
