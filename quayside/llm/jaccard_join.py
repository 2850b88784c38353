"""Exact Jaccard self-join of texts on word shingles: grouped prefix join.

1. Texts with equal shingle sets are one vertex (128-bit hash of the sorted set).
2. Prefixes: of n shingles in one global order, the first n - ceil(t n) + 1.  Linked
   sets share a prefix shingle.  The order is by hash in three classes: shingles below a
   cutoff that one vertex alone holds, all above the cutoff, those below that several hold.
   The cutoff leaves a little more than a prefix below it, so a text without much in
   common with others has a prefix of the first class and is in no posting list at all;
   counts of the shingles below the cutoff tell the classes, whatever the corpus' size.
3. Vertices with identical prefixes and size are one group; posting lists hold groups.
4. Group pairs from the lists pass a size filter and a positional filter; then they
   are expanded to members.  Member pairs pass a bitmap filter (the parities of ``BITS``
   hash classes differ at most as often as the sets do) and are verified on whole sets.

Components, not pairs, are wanted, so pairs inside a component are not formed:
star rounds first verify a few leaders of each list against the others.
What remains is exact: in every list with more than one component, each member
outside the list's largest component is verified against all members of other
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import (
    MULT, U, Words, byte_table, drop_stored, encoded, free_shuffles, give_back, joined_hash, mixed,
    prepare, slices, stored, text_column,
)
from quayside.llm.components import components
from quayside.session import scratch_path

#: Expected shingles below the cutoff, in prefixes.
WINDOW = 1.5
#: Bits of the bitmap of a set, in longs of 64.
BITS = 1024
#: Longs of the folded bitmap (parities of coarser classes) that joins compare.
FOLD = 4
#: Row keys up to this number are broadcast (16 bytes each), more are shuffled.
MAX_KEYS = 1_000_000
STAR_ROUNDS = 2
#: Leaders of a list in a round; every list has its own, so a text in many lists meets many.
LEADERS = 4
WORD_TABLE = byte_table("\t\n\v\f\r ", nul=0xFF)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked when ``over * shared >= least * union``."""

    words: int = 3
    least: int = 90
    over: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.least * n // self.over) + 1

    def prefix_sql(self, n: str) -> str:
        return f"({n} - ({self.least} * {n} + {self.over - 1}) div {self.over} + 1)"

    def cutoff(self) -> np.uint64:
        return U(min(1.0, WINDOW * (self.over - self.least) / self.over) * (2 ** 64 - 2 ** 12))

    def sizes(self, a: str, b: str):
        small, large = F.least(a, b), F.greatest(a, b)
        return small * self.over >= large * self.least

    def bitmaps(self, n1: str, bits1: str, n2: str, bits2: str, longs: int = BITS // 64):
        """Parities differ in no more bits than linked sets may differ in shingles."""
        differ = sum(F.bit_count(F.col(bits1)[i].bitwiseXOR(F.col(bits2)[i]))
                     for i in range(longs))
        return differ * (self.over + self.least) <= \
            (F.col(n1) + F.col(n2)) * (self.over - self.least)

    def positions(self, n1: str, p1: str, n2: str, p2: str):
        """Shingles after a first shared one at p1, p2 still allow the overlap."""
        most = F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2))
        return most * (self.over + self.least) >= (F.col(n1) + F.col(n2)) * self.least


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle."""
    words = Words(texts, WORD_TABLE)
    h = words.hashes()
    runs = joined_hash(h, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if a == b:
            out.append(np.zeros(0, U))
        elif b - a < k:
            out.append(joined_hash(h[a:b], b - a) ^ U(b - a))
        else:
            s = np.sort(runs[a:b - k + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
    return out


def _vertex(s: np.ndarray) -> bytes:
    """128 bits of the sorted set."""
    at = np.arange(1, len(s) + 1, dtype=U)
    with np.errstate(over="ignore"):
        a = mixed(s ^ (at * MULT)).sum(dtype=U)
        b = mixed(mixed(s + at) ^ MULT).sum(dtype=U)
    return np.array([a, b], ">u8").tobytes()


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, U)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


def _parities(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(U)


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule):
    """(key columns of the rows, shingle sets) for slices of the texts."""
    for batch in batches:
        texts = encoded(batch.column("text").to_pylist())
        keys = batch.select([c for c in batch.schema.names if c != "text"])
        for a, b in slices([len(t) for t in texts]):
            yield keys.slice(a, b - a), shingle_sets(texts[a:b], rule.words)
    give_back()


def _names(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([_vertex(s) if len(s) else None for s in sets], pa.binary())


def _emit_heads(batches: Iterator[pa.RecordBatch], rule: Rule):
    """Rows with their vertex, size, the shingles below the cutoff and a prefix above it."""
    cutoff = rule.cutoff()
    for keys, sets in _sets(batches, rule):
        below = [int(np.searchsorted(s, cutoff)) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [*keys.columns, _names(sets), pa.array([len(s) for s in sets], pa.int64()),
             _longs([s[:w + rule.prefix(len(s))] for s, w in zip(sets, below)]),
             pa.array(below, pa.int32()), _longs([_parities(s) for s in sets])],
            [*keys.schema.names, "v", "n", "head", "below", "bits"])


def _emit_sets(batches: Iterator[pa.RecordBatch], rule: Rule):
    for _, sets in _sets(batches, rule):
        yield pa.RecordBatch.from_arrays(
            [_names(sets), pa.array([s.tobytes() for s in sets], pa.binary())], ["v", "shingles"])


def _verify(batches: Iterator[pa.RecordBatch], rule: Rule):
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        sa, sb = batch.column("set_a"), batch.column("set_b")
        keep = []
        for x, y in zip(sa, sb):
            x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(rule.over * shared >= rule.least * (len(both) - shared))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])


def row_hashes(docs: DataFrame, text: str = "text", key: str = "doc_id"):
    """128 bits of key and text: two columns that name a row up to exact repeats."""
    value = text_column(docs, text)
    return (F.xxhash64(docs[key], value).alias("r1"),
            F.xxhash64(F.lit(1), docs[key], value).alias("r2"))


def jaccard_components(docs: DataFrame, rule: Rule = Rule(),
                       text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (least key reachable by links) per row.

    A null or empty text, or one without words, has no shingle and no link: its
    component is its own key.  Repeated rows and equal texts are linked.  A null key
    is left out of the least key; a component of null keys has a null id.
    Other columns of ``docs`` are not read.
    """
    return labelled_rows(docs, rule, text, key).select(key, "n_shingles", "component_id")


def one_per_component(docs: DataFrame, rule: Rule, text: str = "text",
                      key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the least key.

    Null keys come last; of rows with one key, the least row hash stays, and exact repeats
    are one row.  A row without words is a component of its own.
    """
    rows = labelled_rows(docs, rule, text, key)
    first = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), "r1", "r2")
    keep = rows.filter("root is not null").groupBy("root").agg(F.min(first).alias("f")) \
        .select("f.r1", "f.r2").unionByName(rows.filter("root is null").select("r1", "r2")).distinct()
    named = docs.select("*", *row_hashes(docs, text, key))
    return named.join(keep, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]) \
        .drop("r1", "r2")


def labelled_rows(docs: DataFrame, rule: Rule, text: str, key: str) -> DataFrame:
    """``key``, row hashes, ``n_shingles``, ``root`` (null without words), ``component_id``."""
    spark = docs.sparkSession
    prepare(spark)
    value = text_column(docs, text)
    base = docs.select(docs[key].alias("id"), value.alias("text"), *row_hashes(docs, text, key))
    kind = docs.schema[key].dataType.simpleString()
    wide = scratch_path(spark, "llm", "join_wide")
    first = stored(base.mapInArrow(
        lambda it: _emit_heads(it, rule), f"id {kind}, r1 long, r2 long, v binary, n long, "
        "head array<long>, below int, bits array<long>"), "", wide)
    rows = stored(first.drop("head", "below", "bits"), "join_rows")
    vertices = rows.filter("v is not null").groupBy("v", "n").agg(
        F.min(F.struct("r1", "r2")).alias("row"), F.min("id").alias("id"))
    vertices = stored(vertices.select(F.monotonically_increasing_id().alias("vid"), "v", "n",
                                      "row.r1", "row.r2", "id"), "join_vertices")
    chosen = vertices.select("v", "r1", "r2")
    path = scratch_path(spark, "llm", "join_heads")
    heads = stored(first.drop("id").join(vertices.select("vid", "v", "r1", "r2"), ["v", "r1", "r2"])
                   .dropDuplicates(["vid"]).drop("r1", "r2"), "", path)
    drop_stored(spark, wide)
    prefixes = stored(_prefixes(heads, rule), "join_prefix")
    drop_stored(spark, path)
    free_shuffles(spark)
    members = stored(
        prefixes.join(prefixes.groupBy("g1", "g2").agg(
            F.min("v").alias("gid"), F.count("*").alias("size")), ["g1", "g2"])
        .select("v", "n", "gid", "size", "bits", F.array(*[
            _xor([F.col("bits")[i] for i in range(j, BITS // 64, FOLD)])
            for j in range(FOLD)]).alias("fold")), "join_members")
    groups = prefixes.join(members.filter("v = gid").select("v"), "v", "left_semi")
    posted = groups.select(F.col("v").alias("gid"), "n", "own", F.posexplode("prefix").alias("pos", "s")) \
        .select("gid", "n", (F.col("own") + F.col("pos")).alias("pos"), "s")
    shared = posted.groupBy("s").agg(F.count("*").alias("c")).filter("c > 1").select("s")
    folds = members.filter("v = gid").select("gid", "size", "fold")
    lists = stored(posted.join(shared, "s").join(folds, "gid"), "join_lists")
    free_shuffles(spark)
    members = stored(
        members.join(lists.select("gid").distinct()
                     .unionByName(members.filter("size > 1").select("gid")).distinct(),
                     "gid", "left_semi"), "join_members")

    links = None
    label = members.select("v", F.col("v").alias("root"))
    for r in range(STAR_ROUNDS + 1):
        state = stored(members.join(label, "v", "left").select(
            "v", "n", "gid", "fold", F.coalesce("root", "v").alias("root")), "join_state")
        pairs = (_star_pairs(lists, state, rule, r) if r < STAR_ROUNDS
                 else _remaining_pairs(lists, state, members, rule))
        pairs = stored(_alike(pairs, members, rule), "join_pairs")
        if not pairs.take(1):
            continue
        ends = pairs.select(F.col("a").alias("v")).unionByName(
            pairs.select(F.col("b").alias("v"))).distinct()
        texts = _semi(base, chosen.join(ends, "v", "left_semi").select("r1", "r2"))
        sets = stored(texts.select("text").mapInArrow(lambda it: _emit_sets(it, rule),
                                                     "v binary, shingles binary")
                      .groupBy("v").agg(F.first("shingles").alias("shingles")), "join_sets")
        found = stored(_linked(pairs, sets, rule), "join_links")
        if found.take(1):
            links = found if links is None else links.unionByName(found)
            label = components(links)
        free_shuffles(spark)

    ends = vertices.select("v", "id").join(label, "v", "left") \
        .select("v", "id", F.coalesce("root", "v").alias("root"))
    least = ends.groupBy("root").agg(F.min("id").alias("component_id"))
    ends = ends.join(least, "root").select("v", "root", "component_id")
    return rows.join(ends, "v", "left").select(
        F.col("id").alias(key), "r1", "r2", F.col("n").alias("n_shingles"), "root",
        F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def _prefixes(heads: DataFrame, rule: Rule) -> DataFrame:
    """Vertices whose prefix holds shingles that others may hold: these shingles in order,
    and ``own``, how many of the prefix come before them and are the vertex's alone."""
    below = heads.select("vid", F.explode(F.slice("head", 1, F.col("below"))).alias("s"))
    shared = below.groupBy("s").agg(F.count("*").alias("c")).filter("c > 1").select("s")
    late = below.join(shared, "s").groupBy("vid").agg(F.collect_list("s").alias("late"))
    none = F.expr("cast(array() as array<long>)")
    above = F.expr("slice(head, below + 1, size(head))")
    return heads.join(late, "vid", "left") \
        .withColumn("late", F.coalesce("late", none)) \
        .withColumn("own", F.col("below") - F.size("late")) \
        .withColumn("need", F.expr(f"cast({rule.prefix_sql('n')} as int) - own")) \
        .filter("need > 0") \
        .withColumn("prefix", F.slice(F.concat(
            above, F.array_intersect(F.slice("head", 1, F.col("below")), "late")), 1, F.col("need"))) \
        .select("v", "n", "own", "prefix", "bits", F.xxhash64("own", "prefix", "n").alias("g1"),
                F.xxhash64(F.lit(1), "own", "prefix", "n").alias("g2"))


def _semi(base: DataFrame, keys: DataFrame) -> DataFrame:
    keys = stored(keys.distinct(), "join_keys")
    if keys.count() <= MAX_KEYS:
        keys = F.broadcast(keys)
    return base.join(keys, ["r1", "r2"], "left_semi")


def _xor(columns: list):
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def _alike(pairs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that pass the bitmap filter."""
    side = lambda c: members.select(
        F.col("v").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a") \
        .filter(rule.bitmaps("n_a", "bits_a", "n_b", "bits_b")).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    side = lambda c: sets.select(F.col("v").alias(c), F.col("shingles").alias(f"set_{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a") \
        .select("a", "b", "set_a", "set_b") \
        .mapInArrow(lambda it: _verify(it, rule), "a binary, b binary")


def _star_pairs(lists: DataFrame, state: DataFrame, rule: Rule, r: int) -> DataFrame:
    """Each list's leaders (others in every round) with the members of its other groups, and
    leaders of each group with its members.  A group leads by a member of its own for each
    place, as its members have one prefix, but not one set."""
    members = [F.min(F.struct(F.xxhash64(F.lit(r * LEADERS + j), "v"), F.lit(j).alias("j"), "v", "root",
                              "fold")) for j in range(LEADERS)]
    leaders = state.groupBy("gid").agg(F.array(*members).alias("m"), F.count("*").alias("size")) \
        .select("gid", "size", F.explode("m").alias("m")) \
        .select("gid", "size", "m.j", F.col("m.v").alias("a"), F.col("m.root").alias("root_a"),
                F.col("m.fold").alias("fold_a"))
    inside = state.join(leaders.filter("size > 1").drop("j").distinct(), "gid") \
        .filter("root != root_a").filter(rule.bitmaps("n", "fold", "n", "fold_a", FOLD)) \
        .select("a", F.col("v").alias("b"))
    picks = [F.min(F.struct(F.xxhash64(F.lit(r * LEADERS + j), "s", "gid"), F.lit(j).alias("j"), "gid",
                            "n", "pos")) for j in range(LEADERS)]
    head = lists.groupBy("s").agg(F.array(*picks).alias("heads")) \
        .select("s", F.explode("heads").alias("h")) \
        .select("s", F.col("h.j").alias("j"), F.col("h.gid").alias("gid"),
                F.col("h.n").alias("n_a"), F.col("h.pos").alias("pos_a")) \
        .join(leaders.drop("size"), ["gid", "j"]).drop("j").withColumnRenamed("gid", "gid_a").distinct()
    groups = lists.join(head, "s").filter(F.col("gid") != F.col("gid_a")) \
        .filter(rule.sizes("n", "n_a")).filter(rule.positions("n", "pos", "n_a", "pos_a")) \
        .filter((F.col("size") > 1) | rule.bitmaps("n", "fold", "n_a", "fold_a", FOLD)) \
        .select("a", "n_a", "root_a", "fold_a", "gid").distinct()
    across = groups.join(state, "gid").filter("root != root_a") \
        .filter(rule.bitmaps("n", "fold", "n_a", "fold_a", FOLD)).select("a", F.col("v").alias("b"))
    return across.unionByName(inside).distinct()


def _one_of_equal(lists: DataFrame) -> DataFrame:
    """Lists that hold different groups; of those that hold the same, the first in the order.

    A passage gives a list for each of its shingles.  The first shared shingle of a pair, by
    which the positional filter judges it, is the first of its lists, so it stays.
    """
    same = lists.groupBy("s").agg(
        F.bit_xor(F.xxhash64("gid")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "gid")).alias("h2"),
        F.count("*").alias("c"), F.sum("pos").alias("at"))
    first = same.groupBy("h1", "h2", "c").agg(F.min(F.struct("at", "s")).alias("f"))
    return lists.join(first.select("f.s"), "s", "left_semi")


def _remaining_pairs(lists: DataFrame, state: DataFrame, members: DataFrame,
                     rule: Rule) -> DataFrame:
    """All pairs of different components in a list, one of them outside its largest."""
    grouped = state.groupBy("gid").agg(F.count("*").alias("size"), F.first("n").alias("n"),
                                       F.min("root").alias("low"), F.max("root").alias("high"))
    own = grouped.filter("low != high").select(
        F.xxhash64("gid").alias("s"), "gid", "n", F.lit(0).alias("pos"))
    posted = _one_of_equal(lists).select("s", "gid", "n", "pos").unionByName(own) \
        .join(state.select("gid", "v", "root"), "gid")
    mixed_lists = posted.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")) \
        .filter("low != high").select("s")
    posted = stored(posted.join(mixed_lists, "s")
                    .select("s", "v", "n", "pos", "root"), "join_remaining")
    main = posted.groupBy("s", "root").agg(F.count("*").alias("c")) \
        .groupBy("s").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    posted = stored(posted.join(main, "s").join(members.select("v", "bits"), "v").select(
        "s", "v", "n", "pos", "root", "bits", (F.col("root") != F.col("main")).alias("stray")),
        "join_remaining")
    strays = posted.filter("stray").select("s", *[
        F.col(c).alias(d) for c, d in (("v", "a"), ("n", "n_a"), ("pos", "pos_a"),
                                       ("root", "root_a"), ("bits", "bits_a"))])
    # All filters belong to the join: only pairs that pass them become rows, a pair of two
    # strays once.  Whole bitmaps, as folded ones pass most texts with a passage in common.
    pairs = strays.join(posted, "s").filter("root != root_a") \
        .filter("not stray or a < v") \
        .filter(rule.sizes("n", "n_a")).filter(rule.positions("n", "pos", "n_a", "pos_a")) \
        .filter(rule.bitmaps("n", "bits", "n_a", "bits_a"))
    return pairs.select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct()
