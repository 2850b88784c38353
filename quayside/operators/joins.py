"""Join chains described as data.

A denormalisation is a base table and a list of ``Join`` steps folded over
it.  The left-join chain, the inner chain with a left join on customers, the
SQL-style view with ``ON`` conditions and the sales star are four lists, not
four programs.

Physical strategy is left to Catalyst and AQE: a dimension is broadcast when
its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` or when
AQE sees the materialised shuffle is small; everything else is a sort-merge
join whose skewed partitions AQE splits.  A step may also declare a row bound
(``max_broadcast_rows``); the bound is verified with a bounded count before
the broadcast hint is given, and the hint is dropped if the table is larger.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingTablesError(LookupError):
    """Raised when a join plan needs tables that failed to load."""

    def __init__(self, missing: Sequence[str]):
        self.missing = list(missing)
        super().__init__(f"required tables missing: {', '.join(self.missing)}")


@dataclass(frozen=True)
class Chain:
    """A sub-chain joined as one table (a dimension pre-joined to its own
    dimensions before the fact meets it).  Aliases inside stay resolvable."""

    base: str
    steps: tuple
    base_alias: str | None = None


@dataclass(frozen=True)
class Join:
    """One step of a join chain.

    ``right`` is None for a USING join on ``left`` (one merged key column,
    placed first, as Spark does).  Otherwise the join is ``left == right`` and
    both key columns stay.  ``left`` may be qualified (``oh.order_id``) when
    the chain uses aliases.  ``key_type`` casts both keys first - a float id
    joined to an integer id is compared as an exact integer, not as doubles.
    """

    table: str | Chain
    left: str
    right: str | None = None
    how: str = "inner"
    alias: str | None = None
    key_type: str | None = None
    max_broadcast_rows: int | None = None


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after proving the table has at most ``max_rows`` rows.

    The proof is ``limit(max_rows + 1).count()``: it stops reading as soon as
    the bound is exceeded, so checking a big table is cheap too.  Beyond the
    bound the table is returned unhinted and the planner's shuffle join (with
    AQE's runtime re-plan) takes over.  Each call proves anew: a table
    rewritten since is never broadcast on an old proof.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def require_tables(tables: Mapping[str, DataFrame], required: Iterable[str]) -> None:
    missing = [t for t in required if tables.get(t) is None]
    if missing:
        raise MissingTablesError(missing)


def _table_names(base: str, steps: Sequence[Join]) -> list[str]:
    names = [base]
    for s in steps:
        if isinstance(s.table, Chain):
            names += _table_names(s.table.base, s.table.steps)
        else:
            names.append(s.table)
    return names


def _resolve(df: DataFrame, name: str) -> Column:
    # Qualified names resolve through aliases; plain names bind to this frame.
    return F.col(name) if "." in name else df[name]


# Hint for the base of a chain that is the fact table: the biggest input,
# never to be broadcast.  At scale the planner would not anyway; at toy sizes
# it would, and the rest of the chain would then run in the probe side's few
# tasks.  The hint reaches only the first join of the chain.
FACT_HINT = "merge"


_INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def _exact(df: DataFrame, key, key_type: str):
    """``key`` as ``key_type``; a fraction, NaN or number out of range is null.

    So a floating-point key matches an integer key only when both are equal.
    """
    kind = df.select(key).schema[0].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)) and key_type in _INTEGRAL:
        return F.when(key == F.floor(key.cast("double")), key.try_cast(key_type))
    return key.cast(key_type)


def join_chain(
    tables: Mapping[str, DataFrame],
    base: str,
    steps: Sequence[Join],
    base_alias: str | None = None,
    base_hint: str | None = None,
) -> DataFrame:
    """Fold ``steps`` over ``tables[base]``; every referenced table must exist.

    ``base_hint`` (e.g. ``FACT_HINT``) is a join hint put on the base table.
    """
    require_tables(tables, _table_names(base, steps))
    df = tables[base]
    if base_hint:
        df = df.hint(base_hint)
    if base_alias:
        df = df.alias(base_alias)
    for step in steps:
        if isinstance(step.table, Chain):
            sub = step.table
            right = join_chain(tables, sub.base, sub.steps, base_alias=sub.base_alias)
        else:
            right = tables[step.table]
        if step.max_broadcast_rows is not None:
            right = bounded_broadcast(right, step.max_broadcast_rows)
        if step.right is None:
            key = step.left
            if step.key_type:
                df = df.withColumn(key, _exact(df, F.col(key), step.key_type))
                right = right.withColumn(key, _exact(right, F.col(key), step.key_type))
            if step.alias:
                right = right.alias(step.alias)
            df = df.join(right, [key], step.how)
        else:
            if step.alias:
                right = right.alias(step.alias)
            lk = _resolve(df, step.left)
            if step.alias:
                rk = F.col(f"{step.alias}.{step.right}")
            else:
                rk = F.col(step.right) if "." in step.right else right[step.right]
            if step.key_type:
                lk = _exact(df, lk, step.key_type)
                rk = _exact(right, rk, step.key_type)
            df = df.join(right, lk == rk, step.how)
    return df
