"""Ranked lexical search of items in documents: pipelined term partitioning.

Items are put into bundles, the terms of the items are dealt to a few owners, rarest terms
first.  A bundle carries sparse accumulators, the scores so far of the documents that can
still be among the best, through one stage for each owner: the accumulators of a bundle for
a shard of the documents meet, in a cogroup, what the owner's terms have in that shard, and
integer contributions are added.  After the last stage each shard gives its best documents
of each item, and a window selects the final ones.

Scores are exact.  Contributions are not negative, so the k-th best score so far, of one
shard or of all, is a lower bound of the final k-th best one; a document is dropped when
its score with all that later owners could add stays below that bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import (
    Words, byte_table, drop_stored, encoded, prepare, slices, stored, text_column,
)
from quayside.session import scratch_path

#: Bytes between terms: all of ASCII but letters and digits.
SEPARATORS = {b for b in range(128) if not chr(b).isalnum()}
TERM_TABLE = byte_table(SEPARATORS)
#: Bounds of a bundle; an item of more terms is a bundle of its own.
BUNDLE_ITEMS, BUNDLE_TERMS = 256, 1 << 14
#: Terms of the bundles that go over the documents together.
GROUP_TERMS = 1 << 20
#: Bounds of a shard of documents; one document may exceed the second.
SHARD_DOCS, SHARD_POSTINGS = 2_048, 1 << 19
#: Share of all postings up to which an owner's terms go, rarest terms first.
OWNERS = (0.05, 0.2, 0.5, 1.0)

_BUNDLE = "bundle long, item_ids array<{}>, sizes array<int>, terms array<long>, n_terms long"
_POSTINGS = ("shard long, doc_ids array<long>, n array<long>, terms array<int>, docs array<int>, "
             "tfs array<int>, n_docs long, n_terms long")
_OWNED = "bundle long, shard long, doc_ids array<long>, terms array<int>, docs array<int>, " \
         "parts array<long>"
_CARRIED = "bundle long, shard long, items array<int>, docs array<int>, scores array<long>, " \
           "top array<struct<item:int,score:long>>"


def _bundles(batches: Iterator[pa.RecordBatch], most_items: int, most_terms: int):
    """Items with their distinct terms (as hashes), in bundles; items without terms go."""
    number = TaskContext.get().partitionId() << 32
    ids, terms, total = [], [], 0
    item_type = None

    def bundle():
        flat = np.concatenate(terms).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(item_type)),
             pa.array([[len(t) for t in terms]], pa.list_(pa.int32())),
             pa.array([flat], pa.list_(pa.int64())), pa.array([len(flat)], pa.int64())],
            ["bundle", "item_ids", "sizes", "terms", "n_terms"])

    for batch in batches:
        item_type = batch.column("item_id").type
        texts = encoded(batch.column("_text").to_pylist())
        for a, b in slices([len(t) for t in texts]):
            words = Words(texts[a:b], TERM_TABLE)
            h = words.hashes()
            for i in range(a, b):
                own = np.unique(h[words.first[i - a]:words.first[i - a + 1]])
                if not len(own):
                    continue
                if ids and (len(ids) == most_items or total + len(own) > most_terms):
                    yield bundle()
                    ids, terms, total = [], [], 0
                    number += 1
                ids.append(batch.column("item_id")[i].as_py())
                terms.append(own)
                total += len(own)
    if ids:
        yield bundle()


class Vocabulary:
    """Index of a term's hash among sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(8, (2 * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(hashes >> self.shift, np.arange((1 << bits) + 1,
                                                                     dtype=np.uint64))
        self.deepest = int(np.diff(self.begin).max(initial=0))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of known hashes, and their indices."""
        bucket = (h >> self.shift).astype(np.int64)
        at, stop = self.begin[bucket], self.begin[bucket + 1]
        where, index = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(at < stop)
        for step in range(self.deepest):
            here = at[left] + step
            same = self.hashes[here] == h[left]
            where.append(left[same])
            index.append(here[same])
            left = left[~same]
            left = left[at[left] + step + 1 < stop[left]]
        return np.concatenate(where), np.concatenate(index)


def _postings(batches: Iterator[pa.RecordBatch], known, most_docs: int, most_postings: int):
    """Shards of documents: their sizes in terms, and the postings of known terms."""
    number = TaskContext.get().partitionId() << 32
    vocabulary = Vocabulary(known.value)
    v = max(1, len(known.value))
    ids, n, parts, docs, postings = [], [], [], 0, 0

    def shard():
        key = np.concatenate([p[0] for p in parts])
        tf = np.concatenate([p[1] for p in parts])
        at = np.lexsort((key // v, key % v))
        size = np.concatenate(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()),
             pa.array([[x for part in ids for x in part.to_pylist()]], pa.list_(pa.int64())),
             pa.array([size], pa.list_(pa.int64())),
             pa.array([(key % v)[at].astype(np.int32)], pa.list_(pa.int32())),
             pa.array([(key // v)[at].astype(np.int32)], pa.list_(pa.int32())),
             pa.array([tf[at].astype(np.int32)], pa.list_(pa.int32())),
             pa.array([int((size > 0).sum())], pa.int64()),
             pa.array([int(size.sum())], pa.int64())],
            ["shard", "doc_ids", "n", "terms", "docs", "tfs", "n_docs", "n_terms"])

    for batch in batches:
        texts = encoded(batch.column("_text").to_pylist())
        for a, b in slices([len(t) for t in texts]):
            while a < b:
                c = min(b, a + most_docs - docs)
                words = Words(texts[a:c], TERM_TABLE)
                where, index = vocabulary.find(words.hashes())
                own = np.searchsorted(words.first, where, "right") - 1
                key, tf = np.unique((own + docs) * v + index, return_counts=True)
                ids.append(batch.column("doc_id").slice(a, c - a))
                n.append(np.diff(words.first))
                parts.append((key, tf))
                docs += c - a
                postings += len(key)
                a = c
                if docs >= most_docs or postings >= most_postings:
                    yield shard()
                    number += 1
                    ids, n, parts, docs, postings = [], [], [], 0, 0
    if docs:
        yield shard()


def _values(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def _term_counts(batches: Iterator[pa.RecordBatch], size: int):
    """Per term of a task's shards: documents, greatest tf, least size of such a document."""
    df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
    least = np.full(size, np.iinfo(np.int64).max)
    for batch in batches:
        for i in range(batch.num_rows):
            term, n = _values(batch, "terms", i), _values(batch, "n", i)
            df += np.bincount(term, minlength=size)
            np.maximum.at(most, term, _values(batch, "tfs", i))
            np.minimum.at(least, term, n[_values(batch, "docs", i)])
    there = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(there.astype(np.int32)), pa.array(df[there]), pa.array(most[there]),
         pa.array(least[there])], ["term", "df", "most", "least"])


class Plan:
    """What a group of bundles needs in every stage.

    ``bundles``: number -> (item ids, begins of the items' terms, terms).  ``floor`` holds
    the lower bounds of the k-th best score of each item, as far as they are known.
    """

    def __init__(self, bundles, n_docs: int, n_terms: int, counts, size: int, k: int):
        self.bundles, self.k = bundles, k
        self.n_docs, self.n_terms = n_docs, n_terms
        df, most, least = (np.zeros(size, np.int64) for _ in range(3))
        term = counts["term"].to_numpy()
        for column, name in ((df, "df"), (most, "most"), (least, "least")):
            column[term] = counts[name].to_numpy()
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0
             for d in df.tolist()], np.int64)
        self.bound = self.weight * self.part(most, least)
        order = np.argsort(df, kind="stable")
        share = np.cumsum(df[order]) / max(1, int(df.sum()))
        self.owner = np.zeros(size, np.int32)
        self.owner[order] = np.searchsorted(np.array(OWNERS[:-1]), share)
        self.floor = {b: np.zeros(len(ids), np.int64) for b, (ids, _, _) in bundles.items()}

    def part(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A term's share of a score without its weight."""
        m = 100 - 90 + (90 * n * self.n_docs) // max(1, self.n_terms)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def later(self, bundle: int, stage: int) -> np.ndarray:
        """Per item what the owners from ``stage`` on can add to any document."""
        _, begin, terms = self.bundles[bundle]
        total = np.concatenate([[0], np.cumsum(
            np.where(self.owner[terms] >= stage, self.bound[terms], 0))])
        return np.diff(total[begin])


def _owned(batches: Iterator[pa.RecordBatch], plan, stage: int):
    """For each shard and bundle what the owner's terms give, term by term."""
    p: Plan = plan.value
    last = stage == len(OWNERS) - 1
    wanted = {}
    for b, (_, _, terms) in p.bundles.items():
        own = np.unique(terms)
        wanted[b] = own[(p.owner[own] == stage) & (p.weight[own] > 0)]
    for batch in batches:
        for i in range(batch.num_rows):
            term, doc = _values(batch, "terms", i), _values(batch, "docs", i)
            part = p.part(_values(batch, "tfs", i).astype(np.int64), _values(batch, "n", i)[doc])
            for b, own in wanted.items():
                lo, hi = np.searchsorted(term, own), np.searchsorted(term, own, "right")
                size = hi - lo
                at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                if len(at) or last:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int64()), batch.column("shard").slice(i, 1),
                         batch.column("doc_ids").slice(i, 1) if last
                         else pa.nulls(1, pa.list_(pa.int64())),
                         *[pa.array([x[at]], pa.list_(t)) for x, t in (
                             (term, pa.int32()), (doc, pa.int32()), (part, pa.int64()))]],
                        ["bundle", "shard", "doc_ids", "terms", "docs", "parts"])


def _first(rows: pa.Table, name: str) -> np.ndarray:
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    return rows.column(name)[0].values.to_numpy(zero_copy_only=False)


def _add(p: Plan, stage: int, bundle: int, carried: pa.Table, owned: pa.Table):
    """(item, documents, scores) after this stage, without documents that are out of reach."""
    _, begin, terms = p.bundles[bundle]
    item, doc, score = (_first(carried, c) for c in ("items", "docs", "scores"))
    term, where, part = (_first(owned, c) for c in ("terms", "docs", "parts"))
    size = 1 + max(int(doc.max(initial=-1)), int(where.max(initial=-1)))
    now, after = p.later(bundle, stage), p.later(bundle, stage + 1)
    floor = p.floor[bundle]
    item_at = np.searchsorted(item, np.arange(len(begin)))
    usable = np.isin(terms, np.unique(term))
    dense = np.zeros(size, np.int64)
    for i in range(len(begin) - 1):
        had = slice(item_at[i], item_at[i + 1])
        closed = now[i] < floor[i]  # no document can come in any more
        own = terms[begin[i]:begin[i + 1]][usable[begin[i]:begin[i + 1]]]
        if had.start == had.stop and (closed or not len(own)):
            continue
        dense[:] = 0
        dense[doc[had]] = score[had]
        lo, hi = np.searchsorted(term, own), np.searchsorted(term, own, "right")
        for t, a, b in zip(own.tolist(), lo.tolist(), hi.tolist()):
            dense[where[a:b]] += p.weight[t] * part[a:b]
        there = doc[had] if closed else np.flatnonzero(dense)
        s = dense[there]
        least = floor[i]
        if len(s) > p.k:
            least = max(least, int(np.partition(s, len(s) - p.k)[len(s) - p.k]))
        keep = s + after[i] >= max(1, least)
        yield i, there[keep], s[keep]


def _bundle_and_shard(left: pa.Table, right: pa.Table) -> tuple[int, int]:
    rows = left if left.num_rows else right
    return rows.column("bundle")[0].as_py(), rows.column("shard")[0].as_py()


def _stage(left: pa.Table, right: pa.Table, plan, stage: int) -> pa.Table:
    p: Plan = plan.value
    bundle, shard = _bundle_and_shard(left, right)
    items, docs, scores, top = [], [], [], []
    for i, doc, score in _add(p, stage, bundle, left, right):
        items.append(np.full(len(doc), i, np.int32))
        docs.append(doc.astype(np.int32))
        scores.append(score)
        best = score[score > p.floor[bundle][i]]
        if len(best) > p.k:
            best = np.partition(best, len(best) - p.k)[len(best) - p.k:]
        top += [{"item": i, "score": s} for s in best.tolist()]
    one = [np.concatenate([np.zeros(0, kind), *x]) for x, kind in (
        (items, np.int32), (docs, np.int32), (scores, np.int64))]
    rows = 1 if len(one[0]) else 0
    return pa.table(
        [pa.array([bundle] * rows, pa.int64()), pa.array([shard] * rows, pa.int64()),
         *[pa.array([x] * rows, pa.list_(t)) for x, t in zip(
             one, (pa.int32(), pa.int32(), pa.int64()))],
         pa.array([top] * rows, pa.list_(pa.struct([("item", pa.int32()),
                                                    ("score", pa.int64())])))],
        ["bundle", "shard", "items", "docs", "scores", "top"])


def _select(left: pa.Table, right: pa.Table, plan, stage: int, item_type) -> pa.Table:
    """The best documents of a shard after the last stage."""
    p: Plan = plan.value
    bundle, _ = _bundle_and_shard(left, right)
    ids = right.column("doc_ids")[0].values
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy()
    out_item, out_doc, out_score = [], [], []
    for i, doc, score in _add(p, stage, bundle, left, right):
        at = np.lexsort((number[doc], missing[doc], -score))[:p.k]
        out_item.append(np.full(len(at), i, np.int32))
        out_doc.append(doc[at])
        out_score.append(score[at])
    item = np.concatenate([np.zeros(0, np.int32), *out_item])
    doc = np.concatenate([np.zeros(0, np.int64), *out_doc])
    item_ids = p.bundles[bundle][0]
    return pa.table(
        [pa.array(np.full(len(item), bundle), pa.int64()), pa.array(item),
         pa.array([item_ids[i] for i in item.tolist()], item_type), ids.take(pa.array(doc)),
         pa.array(np.concatenate([np.zeros(0, np.int64), *out_score]))],
        ["bundle", "item", "item_id", "doc_id", "score"])


def _of_both(function, *own):
    """A function of the two sides of a cogroup."""
    return lambda left, right: function(left, right, *own)


def _groups(bundles: DataFrame) -> Iterator[list[int]]:
    """Numbers of bundles that go over the documents together."""
    group, total = [], 0
    for r in bundles.select("bundle", "n_terms").orderBy("bundle").collect():
        if group and total + r["n_terms"] > GROUP_TERMS:
            yield group
            group, total = [], 0
        group.append(r["bundle"])
        total += r["n_terms"]
    if group:
        yield group


def _raise_floors(carried: DataFrame, plan: Plan) -> None:
    """Put the k-th best score so far of each item, over all shards, into the plan."""
    by_item = Window.partitionBy("bundle", "item").orderBy(F.desc("score"))
    rows = carried.select("bundle", F.explode("top").alias("t")).select("bundle", "t.item", "t.score") \
        .withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= plan.k) \
        .groupBy("bundle", "item").agg(F.min("score").alias("score"), F.count("*").alias("n")) \
        .filter(F.col("n") == plan.k).drop("n")
    for b, i, s in rows.collect():  # at most one row for each item of the group
        plan.floor[b][i] = max(plan.floor[b][i], s)


def _search(docs: DataFrame, bundles: DataFrame, group: list[int], k: int, item_type: str,
            arrow_type) -> DataFrame:
    """The best documents of each item of a group of bundles."""
    spark: SparkSession = docs.sparkSession
    sc = spark.sparkContext
    rows = bundles.filter(F.col("bundle").between(group[0], group[-1])).collect()
    hashes = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in rows])
                       .view(np.uint64))
    own = {}
    for r in rows:
        terms = np.searchsorted(hashes, np.array(r["terms"], np.int64).view(np.uint64))
        own[r["bundle"]] = (r["item_ids"], np.concatenate([[0], np.cumsum(r["sizes"])]), terms)
    known = sc.broadcast(hashes)
    path = scratch_path(spark, "llm", "postings")
    bounds = SHARD_DOCS, SHARD_POSTINGS
    postings = stored(docs.mapInArrow(lambda it: _postings(it, known, *bounds), _POSTINGS), "", path)
    n_docs, n_terms = (int(x or 0) for x in postings.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    size = len(hashes)
    counts = postings.select("n", "terms", "docs", "tfs") \
        .mapInArrow(lambda it: _term_counts(it, size), "term int, df long, most long, least long") \
        .groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"),
                             F.min("least").alias("least")).toPandas()
    plan = Plan(own, n_docs, n_terms, counts, size, k)
    key, carried_path = ["bundle", "shard"], None
    carried = spark.createDataFrame([], _CARRIED)
    for stage in range(len(OWNERS)):
        shared = sc.broadcast(plan)
        owned = postings.mapInArrow(lambda it, p=shared, s=stage: _owned(it, p, s), _OWNED)
        met = carried.drop("top").groupBy(*key).cogroup(owned.groupBy(*key))
        if stage == len(OWNERS) - 1:
            found = met.applyInArrow(
                _of_both(_select, shared, stage, arrow_type),
                f"bundle long, item int, item_id {item_type}, doc_id long, score long")
            break
        next_path = scratch_path(spark, "llm", "accumulators")
        carried = stored(met.applyInArrow(_of_both(_stage, shared, stage), _CARRIED), "",
                         next_path)
        if carried_path:
            drop_stored(spark, carried_path)
        carried_path = next_path
        _raise_floors(carried, plan)
    by_item = Window.partitionBy("bundle", "item").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    out = stored(found.withColumn("rank", F.row_number().over(by_item))
                 .filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"),
                 "ranked")
    for p in (path, carried_path):
        drop_stored(spark, p)
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``k`` best documents.

    Every row of ``docs`` is a document and every row of ``items`` an item by itself, so
    repeated rows take places, or are answered, again.  A null or empty text has no terms:
    such an item has no result, such a document is not counted.  Null ids stay null; a
    document with one comes last among equal scores.  ``doc_id`` is a whole number.  Only
    scores above 0 are reported; without documents or items there are no rows.  Columns
    other than the ids and texts are not read.  Terms are compared as 64-bit hashes.

    Items go over the documents in groups of ``GROUP_TERMS`` terms, whose terms and bounds
    are broadcast; documents lie in shards, so a group of a cogroup is bounded.
    """
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    item_type = items.schema["item_id"].dataType.simpleString()
    bounds = BUNDLE_ITEMS, BUNDLE_TERMS
    bundles = stored(items.select(items["item_id"], text_column(items).alias("_text")).mapInArrow(
        lambda it: _bundles(it, *bounds), _BUNDLE.format(item_type)), "bundles")
    arrow_type = items.select("item_id").limit(0).toArrow().schema.field("item_id").type
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                        text_column(docs).alias("_text"))
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    for group in _groups(bundles):
        out = out.unionByName(_search(texts, bundles, group, k, item_type, arrow_type))
    return out


def ranked_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
            "'abcdefghijklmnopqrstuvwxyz')"
    terms = f"regexp_extract_all({lower}, " \
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {terms} AS terms FROM documents),
c AS (
  SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms
  FROM d),
i AS (
  SELECT DISTINCT r, item_id, term FROM (
    SELECT r, item_id, unnest(terms) AS term FROM (
      SELECT row_number() OVER () AS r, item_id, {terms} AS terms FROM benchmark))),
t AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (
    SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
  GROUP BY r, doc_id, n, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM t, c GROUP BY term, n_docs),
s AS (
  SELECT i.r, item_id, t.r AS d, doc_id,
         sum(w * ((1000000000 * tf)
                  // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term), c
  GROUP BY i.r, item_id, t.r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST)::INTEGER
         AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 10
"""
