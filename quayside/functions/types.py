"""Type inference for untyped (string) columns.

Every column is tested against every candidate type inside one aggregate, so
inference is a single scan with a map-side partial aggregate whatever the
number of columns.  The chosen type of a column is the first candidate that no
non-null value fails; a column without any value stays string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.sources.parquet import spread_narrow_scan

# Candidate order: narrowest first.
CANDIDATES = ("int", "bigint", "double", "date", "timestamp_ntz", "boolean")

# Literal shapes.  Each candidate cast runs only on text of its shape, so a
# text column never reaches a failing cast (which costs a caught exception
# per value under ANSI semantics).  A number with leading zeros is a code and
# stays text.
_INTEGER = r"^[+-]?(0|[1-9][0-9]*)$"
_DECIMAL = r"^[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
_BOOLEAN = r"^(?i:true|false)$"

# One bit per candidate; a value's mask holds the bits of every type it fits.
_BIT = {t: 1 << i for i, t in enumerate(CANDIDATES)}


def _bit_if_casts(text: Column, type_name: str) -> Column:
    return F.when(text.try_cast(type_name).isNotNull(), F.lit(_BIT[type_name])).otherwise(F.lit(0))


def _fit_mask(text: Column) -> Column:
    """Bits of the candidates the (trimmed, non-null) text is a literal of.

    A value fits a type when it has the type's literal shape and the cast
    succeeds.  The shapes nest (integer inside decimal, date inside
    timestamp) and the two families are disjoint, so one ``CASE`` classifies
    the value with at most three pattern tests; casts run only on text of the
    right shape (a failing cast would cost a caught exception per value under
    ANSI semantics).
    """
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(
            text.rlike(_INTEGER),
            _bit_if_casts(text, "int")
            .bitwiseOR(_bit_if_casts(text, "bigint"))
            .bitwiseOR(_bit_if_casts(text, "double")),
        )
        .when(text.rlike(_DECIMAL), _bit_if_casts(text, "double"))
        .when(
            text.rlike(_TIMESTAMP),
            F.when(text.rlike(_DATE), _bit_if_casts(text, "date"))
            .otherwise(F.lit(0))
            .bitwiseOR(_bit_if_casts(text, "timestamp_ntz")),
        )
        .when(text.rlike(_BOOLEAN), F.lit(_BIT["boolean"]))
        .otherwise(F.lit(0))
    )


def column_fits(df: DataFrame, columns=None, by: str | None = None) -> DataFrame:
    """(by?, column_name, row_count, null_count, value_count, fit) of text columns, in one job.

    Each row is unpivoted into (column index, trimmed text) pairs, and one
    aggregate grouped by column counts them and keeps the AND of their fit masks -
    the candidates *every* value fits.  The columns are data here, not code: one small
    expression serves all of them, and the aggregates combine map-side, so a task sends one
    row per column (and value of ``by``).
    """
    names = list(columns or df.columns)
    # The tests are CPU work per value: an input narrower than the cluster
    # (one file, one row group) is spread first; a wide input is left as is.
    group = [by] if by else []
    pairs = spread_narrow_scan(df).select(
        *group, F.inline(F.array(*[
            F.struct(F.lit(i).alias("i"), F.trim(F.col(f"`{name}`").cast("string")).alias("t"))
            for i, name in enumerate(names)
        ]))
    )
    counts = pairs.groupBy(*group, "i").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("t").alias("value_count"),
        F.bit_and(_fit_mask(F.col("t"))).alias("fit"))
    return counts.select(
        *group, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1).alias("column_name"),
        "row_count", (F.col("row_count") - F.col("value_count")).alias("null_count"),
        "value_count", "fit")


def type_choice(value_count: Column, fit: Column) -> Column:
    """The first candidate left in a mask; string without any value."""
    choice = F.when(value_count == 0, F.lit("string"))
    for t in CANDIDATES:
        choice = choice.when(fit.bitwiseAND(F.lit(_BIT[t])) != 0, F.lit(t))
    return choice.otherwise("string")


def infer_types(df: DataFrame) -> DataFrame:
    """(column_name, inferred_type) for every column, from one job.

    Row order of the result is not defined.
    """
    return column_fits(df).select(
        "column_name", type_choice(F.col("value_count"), F.col("fit")).alias("inferred_type"))


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast string columns to their inferred types (values that fail -> null)."""
    return df.select(
        *[
            (F.trim(F.col(f"`{c}`")).try_cast(types[c]) if types.get(c, "string") != "string"
             else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )
