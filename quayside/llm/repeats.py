"""Removal of long repeated byte strings within and across texts.

A byte is removed when a string of ``length`` bytes that covers it also starts
anywhere else, in another text or at another place of the same text.  Overlaps
count, strings never cross texts, and all of them are judged on the input.

Method.  Sorting every suffix with disk-backed queues needs some 16 bytes of
tuple for each byte of text (see README), so only *sampled* suffixes are sorted,
and what holds for the rest is induced from them:

1. Of the ``length - K + 1`` K-byte strings inside a ``length``-byte window, the one
   with the least hash (the leftmost of equal ones) is the window's anchor.  Equal
   windows have equal anchors at equal places, so windows need comparison only
   within an anchor.  About one position in ``(length - K) / 2`` is an anchor.
2. Spark sorts and groups the anchors by their K-byte string, through its own
   disk-backed sort.  Strings that occur once settle all their windows: unique.
3. The run of windows that share an anchor spans at most ``2 * length - K`` bytes.
   Runs that are equal as a whole settle all their windows: repeated.
4. Runs with a repeated anchor but a context of their own (ends of passages) are
   brought together by anchor, one representative of each class of equal runs
   with them, and are compared window by window, leftwards from the anchor.
   An anchor with more than ``HOT`` such runs is spread by window instead.

Equality of byte strings is equality of 64-bit polynomial hashes over random
byte values, finalised by a bijection.  Texts are identified by 128 hash bits,
so ids may be null or repeated: equal texts have equal results.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import (
    MULT, U, encoded, mixed, prepare, slices, stored, text_column,
)

LENGTH = 400
#: Runs of one anchor that are compared in one task at most.
HOT = 2000
#: Bytes handled at a time; the arrays stay in the processor's cache.
SLICE = 1 << 18
_POS_BITS = 28
_BASE = U(0xD1342543DE82EF95)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))


@functools.cache
def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=U)
    return values * U(2) + U(1)


@functools.cache
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        a = np.full(n, base, U)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = SLICE * 2
    while size < n:
        size *= 2
    return _powers_to(size)


class _Hasher:
    """Hashes of substrings of one buffer."""

    def __init__(self, data: bytes):
        bytes_ = np.frombuffer(data, np.uint8)
        n = len(bytes_)
        self.up, self.down = _powers(n + 1)
        self.prefix = np.zeros(n + 1, U)
        np.cumsum(_byte_values()[bytes_] * self.up[:n], out=self.prefix[1:])

    def every(self, k: int) -> np.ndarray:
        g = (self.prefix[k:] - self.prefix[:-k]) * self.down[:len(self.prefix) - k]
        return mixed(g)

    def at(self, start: np.ndarray, size) -> np.ndarray:
        return mixed((self.prefix[start + size] - self.prefix[start]) * self.down[start])


def _least(packed: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    m, s = packed, 1
    while s * 2 <= width:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    if s < width:
        m = np.minimum(m[:len(m) - (width - s)], m[width - s:])
    return m


def anchor_runs(texts: list[bytes], length: int, k: int):
    """Runs of windows with one anchor: text, first, last, anchor offset, hashes.

    ``first``/``last`` are window starts within the text, the anchor offset is
    from ``first`` (it may be negative for no run: an anchor is never left of
    its window), ``h`` hashes the anchor string, ``c`` the bytes of the whole run.
    """
    data = b"".join(texts)
    if len(data) < length:
        return None
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    n_windows = np.maximum(0, sizes - length + 1)
    text = np.repeat(np.arange(len(texts)), n_windows)
    if not len(text):
        return None
    first_window = np.cumsum(n_windows) - n_windows
    p = begin[text] + np.arange(len(text)) - first_window[text]
    hasher = _Hasher(data)
    g = hasher.every(k)
    low = U((1 << _POS_BITS) - 1)
    if len(g) > int(low):
        raise ValueError("a single text of over 256 MB")
    packed = (g & ~low) | np.arange(len(g), dtype=U)
    x = (_least(packed, length - k + 1) & low).astype(np.int64)[p]
    new = np.ones(len(p), bool)
    new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(p)) - 1
    t, lo, hi, x = text[i], p[i], p[j], x[i]
    c = hasher.at(lo, hi - lo + length) ^ ((hi - lo).astype(U) * MULT)
    at = begin[t]
    return t, lo - at, hi - at, x - lo, g[x], c


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(U).view(np.int64)


_RUN = "k1 long, k2 long, lo int, hi int, x int, h long, c long"


def _emit_runs(batches: Iterator[pa.RecordBatch], length: int, k: int):
    for batch in batches:
        texts = encoded(batch.column("text").to_pylist())
        k1 = batch.column("k1").to_numpy(zero_copy_only=False)
        k2 = batch.column("k2").to_numpy(zero_copy_only=False)
        for a, b in slices([len(t) for t in texts], SLICE):
            runs = anchor_runs(texts[a:b], length, k)
            if runs is None:
                continue
            t, lo, hi, x, h, c = runs
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[a:b][t]), pa.array(k2[a:b][t]),
                 pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                 pa.array(x.astype(np.int32)), pa.array(_signed(h)), pa.array(_signed(c))],
                ["k1", "k2", "lo", "hi", "x", "h", "c"])


_REGION = "k1 long, k2 long, lo int, settled boolean, h long, hot boolean, region binary"


def _cut_regions(batches: Iterator[pa.RecordBatch], length: int):
    for batch in batches:
        out: list[tuple] = []
        for row in batch.select(["k1", "k2", "text", "runs"]).to_pylist():
            text = row["text"].encode("utf-8", "surrogatepass")
            for r in row["runs"]:
                out.append((row["k1"], row["k2"], r["lo"], r["settled"], r["h"], r["hot"],
                            text[r["lo"]:r["hi"] + length]))
        for i in range(0, len(out), 20_000):
            cols = list(zip(*out[i:i + 20_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_()),
                 pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.bool_()),
                 pa.array(cols[6], pa.binary())],
                ["k1", "k2", "lo", "settled", "h", "hot", "region"])


def _windows(regions: list[bytes], length: int):
    """Region number, window offset and hash of every window of the regions."""
    hasher = _Hasher(b"".join(regions))
    sizes = np.fromiter((len(r) for r in regions), np.int64, len(regions))
    begin = np.cumsum(sizes) - sizes
    n = sizes - length + 1
    region = np.repeat(np.arange(len(regions)), n)
    offset = np.arange(len(region)) - (np.cumsum(n) - n)[region]
    return region, offset, hasher.at(begin[region] + offset, length)


def _compare(batches: Iterator[pa.RecordBatch], length: int):
    """Repeated spans of the unsettled regions; rows come sorted by anchor."""
    held: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            if size > SLICE and row["h"] != held[-1]["h"]:
                yield from _spans_of(held, length)
                held, size = [], 0
            held.append(row)
            size += len(row["region"])
    if held:
        yield from _spans_of(held, length)


def _spans_of(rows: list[dict], length: int):
    region, offset, h = _windows([r["region"] for r in rows], length)
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    settled = np.fromiter((r["settled"] for r in rows), bool, len(rows))
    hit = (count[inverse] > 1) & ~settled[region]
    region, offset = region[hit], offset[hit]
    if not len(region):
        return
    new = np.ones(len(region), bool)
    new[1:] = (region[1:] != region[:-1]) | (offset[1:] != offset[:-1] + 1)
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(region)) - 1
    lo = np.fromiter((r["lo"] for r in rows), np.int64, len(rows))
    k1 = np.fromiter((r["k1"] for r in rows), np.int64, len(rows))
    k2 = np.fromiter((r["k2"] for r in rows), np.int64, len(rows))
    at = region[i]
    yield pa.RecordBatch.from_arrays(
        [pa.array(k1[at]), pa.array(k2[at]),
         pa.array((lo[at] + offset[i]).astype(np.int32)),
         pa.array((lo[at] + offset[j] + length).astype(np.int32))],
        ["k1", "k2", "start", "stop"])


def _explode_windows(batches: Iterator[pa.RecordBatch], length: int):
    for batch in batches:
        rows = batch.to_pylist()
        for a, b in slices([len(r["region"]) for r in rows], SLICE):
            part = rows[a:b]
            region, offset, h = _windows([r["region"] for r in part], length)
            k1 = np.fromiter((r["k1"] for r in part), np.int64, len(part))
            k2 = np.fromiter((r["k2"] for r in part), np.int64, len(part))
            lo = np.fromiter((r["lo"] for r in part), np.int64, len(part))
            settled = np.fromiter((r["settled"] for r in part), bool, len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[region]), pa.array(k2[region]),
                 pa.array((lo[region] + offset).astype(np.int32)),
                 pa.array(settled[region]), pa.array(_signed(h))],
                ["k1", "k2", "start", "settled", "w"])


def _apply(batches: Iterator[pa.RecordBatch], names: list[str]):
    for batch in batches:
        texts = encoded(batch.column("_text").to_pylist())
        cover = batch.column("_cover").to_pylist()
        rest = batch.select(names)
        for a, b in slices([len(t) for t in texts], 4 * SLICE):
            kept, spans = [], []
            for text, found in zip(texts[a:b], cover[a:b]):
                merged: list[list[int]] = []
                for s, e in sorted((f["start"], f["stop"]) for f in found or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                pieces, at = [], 0
                for s, e in merged:
                    pieces.append(text[at:s])
                    at = e
                pieces.append(text[at:])
                kept.append(b"".join(pieces))
                spans.append([{"start": s, "stop": e} for s, e in merged])
            part = rest.slice(a, b - a)
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([len(t) for t in texts[a:b]], pa.int64()),
                 pa.array(spans, span_type), pa.array(kept, pa.binary())],
                [*names, "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text",
                   keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``removed`` (array of start/stop), ``kept`` bytes.

    One row per input row.  A null or empty text has no bytes and no spans; a text
    shorter than ``length`` keeps all its bytes; repeated rows count as occurrences
    of each other.  Other columns of ``docs``, whatever their names, are not read.
    """
    if length < 8:
        raise ValueError("length must be at least 8 bytes")
    spark = docs.sparkSession
    prepare(spark)
    k = length // 2
    names = [f"c{i}" for i in range(len(keep))]
    value = text_column(docs, text)
    base = docs.select(
        *[docs[c].alias(n) for c, n in zip(keep, names)], value.alias("text"),
        F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(1), value).alias("k2"))
    long_enough = base.filter(F.octet_length("text") >= length).select("k1", "k2", "text")

    # One row per distinct text and run, with its number of copies.
    runs = stored(
        long_enough.mapInArrow(lambda it: _emit_runs(it, length, k), _RUN)
        .groupBy("k1", "k2", "lo", "hi", "x", "h", "c").agg(F.count("*").alias("n")),
        "repeat_runs")
    often = runs.groupBy("h").agg(F.sum("n").alias("n_h"), F.count("*").alias("runs_h"))
    often = often.filter("n_h > 1").select("h", "n_h")
    shared = runs.join(often, "h")
    classes = shared.groupBy("h", "c").agg(
        F.sum("n").alias("n_c"), F.min(F.struct("k1", "k2", "lo")).alias("first"))
    shared = stored(
        shared.join(classes, ["h", "c"]).select(
            "k1", "k2", "lo", "hi", "h", (F.col("n_c") > 1).alias("settled"),
            ((F.col("n_c") == 1) | ((F.col("n_c") < F.col("n_h"))
              & (F.struct("k1", "k2", "lo") == F.col("first")))).alias("compare")),
        "repeat_shared")
    settled = shared.filter("settled").select(
        "k1", "k2", F.col("lo").alias("start"), (F.col("hi") + length).alias("stop"))

    crowded = (shared.filter("compare").groupBy("h").agg(F.count("*").alias("m"))
               .filter(F.col("m") > HOT).select("h", F.lit(True).alias("hot")))
    compare = shared.filter("compare").join(crowded, "h", "left")
    by_text = compare.groupBy("k1", "k2").agg(F.collect_list(F.struct(
        "lo", "hi", "settled", "h", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))
    one_text = long_enough.join(by_text.select("k1", "k2"), ["k1", "k2"], "left_semi") \
        .groupBy("k1", "k2").agg(F.first("text").alias("text"))
    regions = stored(
        one_text.join(by_text, ["k1", "k2"])
        .mapInArrow(lambda it: _cut_regions(it, length), _REGION), "repeat_regions")

    span = "k1 long, k2 long, start int, stop int"
    found = (regions.filter("not hot").select("k1", "k2", "lo", "settled", "h", "region")
             .repartition("h").sortWithinPartitions("h")
             .mapInArrow(lambda it: _compare(it, length), span))
    windows = stored(
        regions.filter("hot").select("k1", "k2", "lo", "settled", "region")
        .mapInArrow(lambda it: _explode_windows(it, length),
                    "k1 long, k2 long, start int, settled boolean, w long"),
        "repeat_windows")
    again = windows.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w")
    spread = (windows.filter("not settled").join(again, "w", "left_semi")
              .select("k1", "k2", "start", (F.col("start") + length).alias("stop")))

    cover = (settled.unionByName(found).unionByName(spread)
             .groupBy("k1", "k2")
             .agg(F.collect_list(F.struct("start", "stop")).alias("_cover")))
    joined = base.withColumnRenamed("text", "_text").join(cover, ["k1", "k2"], "left")
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    out = joined.select(*names, "_text", "_cover").mapInArrow(
        lambda it: _apply(it, names),
        schema + ", n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")
    return out.toDF(*keep, "n_bytes", "removed", "kept")
