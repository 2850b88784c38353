"""Language of web pages: Bayesian fusion of four kinds of evidence.

log P(lang | page) = tempered text log-likelihood + log P(declared | lang)
                     + log P(suffix | lang) + log prior of the host.

* Text: naive Bayes on hashed byte trigrams of the visible text, trained on a bounded
  sample of texts with a known language.  Neighbouring trigrams depend on each other, so the
  log-likelihood is divided by ``TEMPER``, and never counts for more than ``MOST`` trigrams.
* Declared language (``<html lang>``) and address suffix: their frequencies given the
  language that the text alone points to, by grouped aggregation over all pages.
* Host prior: the same languages counted by host, smoothed towards the registered
  domain, that towards the suffix, that towards all pages.

The page's own vote is taken out of the host's counts, so no evidence counts twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import U, give_back, mixed, prepare, slices, stored, text_column
from quayside.llm.labelled import TEXTS_PER_ID

BUCKETS = 1 << 18
#: Ids of a language in the training sample, at most.
MAX_ROWS = 500
#: Sampled ids that are broadcast; beyond that the planner joins them as it sees fit.
MAX_PICKED = 1_000_000
#: Characters of text whose trigrams a task holds at a time; they take some 40 times as much.
SLICE = 1 << 18
#: Entries of the model that a task looks up at a time.
LOOKUPS = 4_000_000
TEMPER = 4.0
MOST = 400
#: Weight of the level above in a smoothed prior; added count of a frequency.
SMOOTH = 4.0
ADDED = 0.5
#: Letters and non-ASCII bytes stay, A-Z lowered, all else is a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


@dataclass(frozen=True)
class Model:
    """Trigram log-likelihoods of any number of languages, by bucket.

    ``begin[b]:begin[b + 1]`` are the entries of bucket b: languages in which it was seen,
    and by how much its log-likelihood exceeds that of an unseen trigram (``unseen``).
    """

    languages: list[str]
    begin: np.ndarray
    language: np.ndarray
    loglik: np.ndarray
    unseen: np.ndarray

    def scores(self, text: np.ndarray, bucket: np.ndarray, times: np.ndarray,
               n: np.ndarray) -> np.ndarray:
        """Log-likelihood of each text, by what ``counted`` gives."""
        k = len(self.languages)
        size = self.begin[bucket + 1] - self.begin[bucket]
        out = np.zeros(len(n) * k)
        for a, b in slices(size, LOOKUPS):
            own = size[a:b]
            at = np.repeat(self.begin[bucket[a:b]] - (np.cumsum(own) - own), own)
            at += np.arange(len(at))
            out += np.bincount(np.repeat(text[a:b], own) * k + self.language[at],
                               self.loglik[at] * np.repeat(times[a:b], own), len(out))
        return out.reshape(len(n), k) + n[:, None] * self.unseen


def _buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of each three bytes of ``data`` that follow each other."""
    return mixed(data[:-2] << U(16) | data[1:-1] << U(8) | data[2:]) & U(BUCKETS - 1)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, first) of the byte trigrams of each text, blanks alone left out."""
    parts = [b" ".join(t.encode("utf-8", "surrogatepass").translate(_TABLE).split()) for t in texts]
    parts = [b" " + p + b" " if p else b"" for p in parts]
    data = np.frombuffer(b"".join(parts) + b"\0\0", np.uint8).astype(U)
    size = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    h = _buckets(data)
    begin = np.cumsum(size) - size
    inside = np.ones(int(size.sum()), bool)
    for off in (1, 2):
        inside[(begin + size - off)[size >= off]] = False
    n = np.maximum(0, size - 2)
    return h[np.flatnonzero(inside)].astype(np.int64), np.concatenate([[0], np.cumsum(n)])


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, times) of the different trigrams of a slice of texts; trigrams of each text.

    The counts of a text that is longer than a slice are summed over parts of it.
    """
    if len(texts) != 1 or len(texts[0]) <= SLICE:
        bucket, first = trigrams(texts)
        n = np.diff(first)
        text = np.repeat(np.arange(len(n)), n)
        key, times = np.unique(text * BUCKETS + bucket, return_counts=True)
        return key // BUCKETS, key % BUCKETS, times, n
    data = np.frombuffer(texts[0].encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    kept = data != 32
    kept[1:] |= kept[:-1].copy()  # of several blanks the first
    part = data[kept].tobytes().strip(b" ")
    data = np.frombuffer(b" " + part + b" " if part else b"", np.uint8)
    every = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(data) - 2, SLICE):
        h = _buckets(data[a:a + SLICE + 2].astype(U))
        every += np.bincount(h.astype(np.int64), minlength=BUCKETS)
    bucket = np.flatnonzero(every)
    return np.zeros(len(bucket), np.int64), bucket, every[bucket], np.array([every.sum()])


def _trigram_counts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts, lang = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for a, b in slices([len(t) for t in texts], SLICE):
            names = sorted(set(lang[a:b]))
            text, bucket, times, _ = counted(texts[a:b])
            own = np.array([names.index(x) for x in lang[a:b]], np.int64)[text]
            key, at = np.unique(own * BUCKETS + bucket, return_inverse=True)
            n = np.bincount(at, times, len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(pa.array(key // BUCKETS)),
                 pa.array((key % BUCKETS).astype(np.int32)), pa.array(n)], ["lang", "bucket", "n"])
    give_back()


def train(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Trigram frequencies of every language in the texts of at most ``max_rows`` ids of it.

    All languages are sampled and counted by one job each; the counts, at most ``BUCKETS``
    of a language, come to the driver.  A repeated text of an id counts once, and an id has at
    most ``TEXTS_PER_ID`` texts.  Rows without a language or id are no samples.  No sample at
    all gives a model without languages, by which every page's language is null.
    """
    prepare(docs.sparkSession)
    known = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"),
                        text_column(docs).alias("text")) \
        .filter("lang is not null and doc_id is not null")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = stored(known.select("lang", "doc_id").distinct()
                    .withColumn("_n", F.row_number().over(by_hash))
                    .filter(F.col("_n") <= max_rows).drop("_n"), "language_ids")
    names = sorted(r["lang"] for r in picked.select("lang").distinct().collect())
    if picked.count() <= MAX_PICKED:
        picked = F.broadcast(picked)
    by_id = Window.partitionBy("lang", "doc_id").orderBy(F.xxhash64("text"), "text")
    texts = known.join(picked, ["lang", "doc_id"]).distinct() \
        .withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= TEXTS_PER_ID)
    counts = texts.select("lang", "text").mapInArrow(
        _trigram_counts, "lang string, bucket int, n long").groupBy("lang", "bucket") \
        .agg(F.sum("n").alias("n")).toArrow()
    index = {name: i for i, name in enumerate(names)}
    language = np.array([index[x] for x in counts.column("lang").to_pylist()], np.int32)
    bucket = counts.column("bucket").to_numpy().astype(np.int64)
    n = counts.column("n").to_numpy().astype(np.float64)
    rest = ADDED / 64  # of every bucket
    total = np.bincount(language, n, len(names)) + BUCKETS * rest
    at = np.lexsort((language, bucket))
    gain = np.log((n[at] + rest) / rest)
    return Model(names, np.searchsorted(bucket[at], np.arange(BUCKETS + 1)), language[at],
                 gain, np.log(rest / total))


def visible_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags left out."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def _text_scores(batches: Iterator[pa.RecordBatch], model):
    k = len(model.value.languages)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rest = batch.select([c for c in batch.schema.names if c != "text"])
        for a, b in slices([len(t) for t in texts], SLICE):
            text, bucket, times, size = counted(texts[a:b])
            n = np.maximum(1, size)
            weight = np.minimum(n, MOST) / n / TEMPER
            scores = model.value.scores(text, bucket, times, size) * weight[:, None]
            flat = pa.array(scores.ravel())
            at = pa.array(np.arange(b - a + 1, dtype=np.int32) * k)
            best = scores.argmax(axis=1) if k else np.zeros(b - a, np.int64)
            vote = pa.array(np.where(size > 0, best, -1).astype(np.int32) if k
                            else np.full(b - a, -1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).columns, pa.ListArray.from_arrays(at, flat), vote],
                [*rest.schema.names, "loglik", "vote"])
    give_back()


def _counts(rows: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    """Votes per language, as an array, for each value of ``by``."""
    votes = rows.groupBy(*by, "vote").agg(F.count("*").alias("n"))
    entries = F.map_from_entries(F.collect_list(F.struct("vote", "n")))
    votes = votes.groupBy(*by).agg(entries.alias("m")) if by else votes.agg(entries.alias("m"))
    return votes.select(*by, F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(
        F.try_element_at("m", i), F.lit(0))).alias(name))


def _smoothed(own: Column, above: Column) -> Column:
    total = F.aggregate(own, F.lit(0.0), lambda acc, x: acc + x)
    return F.zip_with(own, above, lambda x, p: (x + SMOOTH * p) / (total + SMOOTH))


def identify(pages: DataFrame, model: Model, key: str = "page_id") -> DataFrame:
    """``key``, ``host``, ``declared``, ``text_lang``, ``lang``, ``probability`` per page.

    A null or empty page has no text evidence and no declared language, a null or odd
    address the empty host; what evidence is left decides, ties go to the first
    language by name.  Repeated rows count as votes of their own.  Without languages in the
    model ``lang`` is null.
    """
    spark = pages.sparkSession
    prepare(spark)
    k = len(model.languages)
    url = F.coalesce(pages["url"].cast("string"), F.lit(""))
    html = text_column(pages, "html")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    base = pages.select(
        pages[key].alias("key"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
        declared.alias("declared"), visible_text(html).alias("text"))
    shared = spark.sparkContext.broadcast(model)
    rows = stored(base.mapInArrow(
        lambda it: _text_scores(it, shared),
        f"key {pages.schema[key].dataType.simpleString()}, host string, domain string, "
        "suffix string, declared string, loglik array<double>, vote int"), "language_rows")
    if not k:
        return rows.select(F.col("key").alias(key), "host", "declared",
                           F.lit(None).cast("string").alias("text_lang"),
                           F.lit(None).cast("string").alias("lang"),
                           F.lit(None).cast("double").alias("probability"))

    everything = _counts(rows, [], k, "n_all")
    by_suffix = _counts(rows, ["suffix"], k, "n_suffix")
    by_domain = _counts(rows, ["domain", "suffix"], k, "n_domain")
    by_host = _counts(rows, ["host", "domain", "suffix"], k, "n_host")
    by_declared = _counts(rows, ["declared"], k, "n_declared")
    flat = F.array_repeat(F.lit(1.0 / k), k)
    prior = by_host.join(by_domain, ["domain", "suffix"]).join(by_suffix, "suffix") \
        .crossJoin(F.broadcast(everything))  # one row
    prior = prior.select("host", "n_host", "n_all", "n_suffix", _smoothed(
        F.col("n_domain"), _smoothed(F.col("n_suffix"), _smoothed(F.col("n_all"), flat))).alias("above"))
    joined = rows.join(prior, "host").join(by_declared, "declared")

    def evidence(i):
        own = (F.col("vote") == i).cast("int")
        here = F.element_at("n_host", i + 1) - own
        total = F.aggregate("n_host", F.lit(0).cast("long"), lambda acc, x: acc + x) \
            - (F.col("vote") >= 0).cast("int")
        host_prior = (here + SMOOTH * F.element_at("above", i + 1)) / (total + SMOOTH)
        votes = F.element_at("n_all", i + 1) + 64 * ADDED
        said = F.when(F.col("declared") == "", F.lit(0.0)).otherwise(
            F.log((F.element_at("n_declared", i + 1) - own + ADDED) / votes))
        suffix = F.log((F.element_at("n_suffix", i + 1) - own + ADDED) / votes)
        return F.element_at("loglik", i + 1) + F.log(host_prior) + said + suffix

    names = F.from_json(F.lit(json.dumps(model.languages)), F.lit("array<string>"))
    scored = joined.withColumn(
        "score", F.transform(F.sequence(F.lit(0), F.lit(k - 1)), evidence))
    top = F.array_max("score")
    spread = F.aggregate("score", F.lit(0.0), lambda acc, s: acc + F.exp(s - top))
    return scored.select(
        F.col("key").alias(key), "host", "declared",
        F.when(F.col("vote") >= 0, F.get(names, F.col("vote"))).alias("text_lang"),
        F.get(names, F.array_position("score", top).cast("int") - 1).alias("lang"),
        (1.0 / spread).alias("probability"))
