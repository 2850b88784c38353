"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

DataFrame functions only.  A text's words are lower-cased runs of letters and digits.
Every anchor (a common word, or any word whose hash is 0 modulo ``HASHED``, which serves
languages without a list here) gives a spot: the anchor and the next ``CHAIN`` words that are
no common words.  The fingerprint is the text's set of 32-bit spot hashes, written as
its size and the sorted hashes.  A text with words but without a spot has one spot of all
its words; a text without words has the empty set.

Likeness is the Jaccard similarity of two sets.  ``similar_pairs`` partitions the sets by
length, so that a set meets only sets of lengths that can reach the threshold, and stops at
a prefix of each sorted set.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import text_column

CHAIN = 2
#: Words after an anchor among which its chain is looked for.
REACH = 8
HASHED = 4
#: Documents per bucket when each document is paired with the next one.
BUCKET_ROWS = 1000
#: Buckets at most; the table of their first rows is broadcast (32 bytes each).
MAX_BUCKETS = 50_000
#: Keys sampled for each range.
SAMPLED = 20

# Common words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to a in is it that on for as was with by this at are be from or an not have "
    "le la les de des du un une et en que qui au aux est sur pour par dans avec pas ne ce "
    "der die das und ist den dem von zu mit sich auf ein eine einen im nicht auch als nach "
    "el los las y lo del se por con una su para es al como más pero sus"
).split()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _is_common(w: Column) -> Column:
    return w.isin(*COMMON_WORDS)


def _is_anchor(w: Column) -> Column:
    return _is_common(w) | (F.xxhash64(w).bitwiseAND(F.lit(HASHED - 1)) == 0)


def _spot_hash(x: Column) -> Column:
    return F.xxhash64(x).bitwiseAND(F.lit(0xFFFFFFFF))


def spots(text: Column) -> Column:
    """Sorted distinct spot hashes of a text (array of long)."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(words):
        def spot(w, i):
            chain = F.filter(F.slice(words, i + 2, F.lit(REACH)), lambda x: ~_is_common(x))
            return F.when(_is_anchor(w) & (F.size(chain) >= CHAIN),
                          _spot_hash(F.concat(F.array(w), F.slice(chain, 1, CHAIN))))

        found = F.array_sort(F.array_distinct(F.filter(
            F.transform(words, spot), lambda h: h.isNotNull())))
        return F.when(F.size(words) == 0, F.expr("cast(array() as array<long>)")) \
            .otherwise(_let(found, lambda f: F.when(F.size(f) > 0, f)
                            .otherwise(F.array(_spot_hash(words)))))

    return _let(words, of)


def written(spot_set: Column) -> Column:
    """The fingerprint as text: size, then the hashes in hexadecimal."""
    return F.concat(F.size(spot_set).cast("string"), F.lit(":"), F.array_join(
        F.transform(spot_set, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two spot sets; 1 for two empty ones."""
    def of(shared):
        union = F.size(a) + F.size(b) - shared
        return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)

    return _let(F.size(F.array_intersect(a, b)), of)


def fingerprint(docs: DataFrame, text: str = "text", into: str = "spots") -> DataFrame:
    """``docs`` with the spot set of the text (null: empty) in column ``into``."""
    return docs.withColumn(into, spots(text_column(docs, text)))


def similar_pairs(sets: DataFrame, threshold: float = 0.8, key: str = "doc_id",
                  column: str = "spots") -> DataFrame:
    """``(a, b, likeness)`` of different sets at or over the threshold, each pair once.

    Equal sets are one row each before the join (``a``, ``b`` are their least keys).
    Sets are partitioned by length in steps of 1 / threshold: a set meets its own part and
    the next longer one.  Posting lists hold the first ``n - ceil(threshold n) + 1``
    hashes of a set.  Empty sets pair with nothing.
    """
    distinct = sets.filter(F.size(column) > 0).groupBy(F.col(column).alias("s")).agg(
        F.min(key).alias("k")).withColumn("n", F.size("s"))
    step = -math.log(threshold)
    part = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9)
    listed = distinct.withColumn("part", part).withColumn("h", F.explode(F.expr(
        f"slice(s, 1, n - cast(ceil({threshold} * n - 1e-9) as int) + 1)")))
    left = listed.select(F.col("k").alias("a"), F.col("s").alias("sa"), F.col("n").alias("na"),
                         "h", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = listed.select(F.col("k").alias("b"), F.col("s").alias("sb"), F.col("n").alias("nb"),
                          "h", "part")
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, ["h", "part"]) \
        .filter(ordered & (F.col("na") >= threshold * F.col("nb") - 1e-9))
    return pairs.select("a", "b", "sa", "sb").distinct() \
        .withColumn("likeness", likeness(F.col("sa"), F.col("sb"))) \
        .filter(F.col("likeness") >= threshold).select("a", "b", "likeness")


def _ranges(docs: DataFrame, key: str, by: Column) -> tuple[Column, int]:
    """Number of a row's range, lower for later rows in descending order; number of rows.

    Ranges end at quantiles of a sample of the keys (``SAMPLED`` for each range, 8 bytes each,
    come to the driver), so they hold about ``BUCKET_ROWS`` rows however the keys are spread.  A key that fills several of them is split by the hash ``by``, the
    second key of the order, and so are null keys, which come last.
    """
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col(key).isNull())).first()
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    x = F.col(key).cast("long")
    keys = docs.filter(x.isNotNull()).select(x.alias("x")).sample(
        fraction=min(1.0, SAMPLED * buckets / max(1, n)), seed=9).toArrow()
    ordered = sorted(keys.column("x").to_pylist())
    ends = Counter([-(1 << 63), *(ordered[i * len(ordered) // buckets] for i in range(1, buckets))
                    ] if ordered else [-(1 << 63)])
    bounds = sorted(ends)
    listed = lambda values, kind: F.from_json(
        F.lit(json.dumps(values)), F.lit(f"array<{kind}>"))
    bound, parts = listed(bounds, "long"), listed([ends[b] for b in bounds], "int")
    step = math.isqrt(len(bounds)) + 1
    coarse = listed(bounds[::step], "long")
    unit = by / F.lit(2.0 ** 64) + 0.5
    split = lambda n: F.least(F.floor(unit * n).cast("long"), n - F.lit(1).cast("long"))

    def numbered(x):
        block = F.size(F.filter(coarse, lambda b: b <= x)) - 1
        at = block * step + F.size(F.filter(F.slice(bound, block * step + 1, F.lit(step)),
                                            lambda b: b <= x))
        return _let(at, lambda i: i.cast("long") * (1 << 20) + F.when(
            F.element_at(bound, i) == x, split(F.element_at(parts, i))).otherwise(
            F.element_at(parts, i)))

    n_null = F.lit(nulls // BUCKET_ROWS + 1).cast("long")
    return F.when(F.col(key).isNull(), split(n_null) - n_null).otherwise(_let(x, numbered)), n


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id",
              derived: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``derived(docs)`` with ``next_<column>`` of the row that follows by descending key.

    After the last row comes the first one; rows of one key follow each other by descending
    hash of the first of ``columns``, which is one of ``docs``; null keys come last.  Rows
    are cut into ranges by ``_ranges``; each range also gets the first row of the range that
    follows, so every range finds its next rows by itself and each row is shuffled once.
    ``derived`` adds columns row by row.
    """
    named = docs.withColumn("_h", F.xxhash64(columns[0]))
    number, n = _ranges(named, key, F.col("_h"))
    if not n:
        empty = derived(docs)
        return empty.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    placed = named.withColumn("_bucket", number)
    by_rank = Window.orderBy(F.desc("_bucket"))
    # One row for each range: its first row's key and hash, and the range before it.
    tops = placed.groupBy("_bucket").agg(F.max(F.struct(
        F.col(key).isNotNull().alias("there"), F.col(key).alias("k"), F.col("_h").alias("h"))).alias("t")) \
        .withColumn("_before", F.lag("_bucket").over(by_rank)) \
        .withColumn("_before", F.coalesce(
            "_before", F.min("_bucket").over(Window.partitionBy()))) \
        .select(F.col("_bucket").alias("_of"), F.col("t.k").alias("_k"), F.col("t.h").alias("_top"),
                "_before")
    firsts = placed.join(F.broadcast(tops), (F.col("_bucket") == F.col("_of")) & (
        F.col("_h") == F.col("_top")) & F.col(key).eqNullSafe(F.col("_k"))) \
        .dropDuplicates(["_bucket"]).withColumn("_bucket", F.col("_before"))
    rows = derived(placed).withColumn("_extra", F.lit(0)).unionByName(
        derived(firsts.select(*placed.columns)).withColumn("_extra", F.lit(1)))
    within = Window.partitionBy("_bucket").orderBy(
        "_extra", F.desc_nulls_last(key), F.desc("_h"), F.desc(columns[0]))
    out = rows.select("*", *[F.lead(c).over(within).alias(f"next_{c}") for c in columns])
    return out.filter("_extra = 0").drop("_extra", "_bucket", "_h")


def edited_and_next(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, ``n_chars``, ``spots``, ``edited`` text, ``edited_spots``, likenesses.

    The edited text has its last third of code points (rounded down) replaced by as many
    of the beginning of the next text.  With one row, the next text is its own.
    A null or empty text has no code points and stays empty.
    """
    base = docs.select(docs[key].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))
    paired = with_next(base, ["text", "spots"], derived=lambda df: df.withColumn(
        "spots", spots(F.col("text"))))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    paired = paired.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    paired = paired.withColumn("edited_spots", spots(F.col("edited")))
    return paired.select(
        F.col("doc_id").alias(key), "n_chars", "spots", "edited", "edited_spots",
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))
