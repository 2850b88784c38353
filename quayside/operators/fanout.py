"""How many rows a join can give, before it runs.

Duplicate keys on both sides multiply rows.  ``join_bound`` counts the rows of each side in
buckets of the hashed key, under a few hashes; the sum over the buckets of left times right
rows is never less than what the join gives, as rows of one key share a bucket.  The least of
the bounds is reported.  Counting combines in every task to one row for each bucket, so a
key that holds a third of the rows costs nothing more.  ``chain_bounds`` does so for each
step of a join list and bounds the whole chain by the greatest multiplicity of each key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.joins import Chain, Join, _exact, join_chain

BUCKETS = 1 << 20
HASHES = 3


class FanOutError(ValueError):
    """A join could give more rows than its caller allows."""


@dataclass(frozen=True)
class Bound:
    left_rows: int
    right_rows: int
    #: Rows that the join gives at most.
    rows: int
    #: Rows of the right side with one key, at most.
    multiplicity: int


def _bucket_counts(keys: DataFrame, name: str, buckets: int, hashes: int) -> DataFrame:
    places = F.array(*[
        F.struct(F.lit(j).alias("j"), F.pmod(F.xxhash64(F.lit(j), "k"), F.lit(buckets)).alias("b"))
        for j in range(hashes)])
    return keys.filter(F.col("k").isNotNull()).select(F.inline(places)).groupBy("j", "b") \
        .agg(F.count(F.lit(1)).alias(name))


def join_bound(left: DataFrame, right: DataFrame, left_key: Column | str, right_key: Column | str,
               how: str = "inner", buckets: int = BUCKETS, hashes: int = HASHES) -> Bound:
    """Bound of ``left JOIN right ON left_key = right_key``; null keys meet nothing.

    Both keys must have one type.  A left join adds the left rows without a partner, at
    most all of them.
    """
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError(f"no bound for a join of kind {how}")
    key = lambda c: F.col(c) if isinstance(c, str) else c
    left_keys, right_keys = left.select(key(left_key).alias("k")), right.select(key(right_key).alias("k"))
    counted = _bucket_counts(left_keys, "l", buckets, hashes).join(
        _bucket_counts(right_keys, "r", buckets, hashes), ["j", "b"])
    products = counted.groupBy("j").agg(
        F.sum(F.col("l").cast("decimal(38,0)") * F.col("r")).alias("rows")).collect()  # ``hashes`` rows
    most = right_keys.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.max("n")).first()[0] or 0
    n_left, n_right = left_keys.count(), right_keys.count()
    rows = min((int(r["rows"]) for r in products), default=0)
    rows = min(rows, n_left * most)
    return Bound(n_left, n_right, rows if how == "inner" else min(rows + n_left, n_left * max(1, most)),
                 most)


def check_fan_out(bound: Bound, most: float, step: str = "join") -> Bound:
    """The bound, or ``FanOutError`` if the join can give over ``most`` rows for each left one."""
    if bound.rows > most * max(1, bound.left_rows):
        raise FanOutError(
            f"{step}: up to {bound.rows} rows of {bound.left_rows} ({bound.multiplicity} for one key)")
    return bound


def chain_bounds(tables: Mapping[str, DataFrame], base: str, steps: Sequence[Join],
                 most: float | None = None) -> list[tuple[str, Bound, int]]:
    """(table, bound of its join with the table that has the key, bound of the chain so far).

    Steps are USING steps.  A key is looked up in the base and in the tables before, in the
    order in which the chain would find it; a nested chain counts as the table that it makes.
    With ``most`` a step that can give over that many rows for each left row is an error,
    before anything is joined.
    """
    out, rows = [], None
    known = [tables[base]]
    for step in steps:
        if isinstance(step.table, Chain):
            name, right = step.table.base, join_chain(tables, step.table.base, step.table.steps)
        else:
            name, right = step.table, tables[step.table]
        owner = next(t for t in known if step.left in t.columns)
        left_key, right_key = F.col(step.left), F.col(step.right or step.left)
        if step.key_type:
            left_key, right_key = (_exact(t, k, step.key_type)
                                   for t, k in ((owner, left_key), (right, right_key)))
        bound = join_bound(owner, right, left_key, right_key, step.how)
        if most is not None:
            check_fan_out(bound, most, f"{base} to {name}")
        if rows is None:
            rows = bound.rows if owner is known[0] else tables[base].count()
        else:
            rows *= max(bound.multiplicity, 0 if step.how == "inner" else 1)
        out.append((name, bound, rows))
        known.append(right)
    return out
