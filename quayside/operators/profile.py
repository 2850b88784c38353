"""One-pass null profile of a table.

Counting nulls column by column costs one scan per column.  Here every
column's count is one aggregate expression of a single ``agg`` call, so a
table of any width is profiled by one job with one scan and a map-side partial
aggregate; only one row (one number per column) leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_COUNT = "row_count"


def _null_count_col(index: int) -> str:
    # Positional aliases keep the aggregate independent of awkward names.
    return f"__nulls_{index}"


def null_count_agg(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and one ``__nulls_i`` per column, in order."""
    exprs = [F.count(F.lit(1)).alias(ROW_COUNT)]
    for i, name in enumerate(df.columns):
        exprs.append(F.count_if(F.col(f"`{name}`").isNull()).alias(_null_count_col(i)))
    return df.agg(*exprs)


def null_counts(df: DataFrame) -> dict[str, int]:
    """Column name -> number of nulls, from one job."""
    row = null_count_agg(df).first()
    return {name: int(row[_null_count_col(i)]) for i, name in enumerate(df.columns)}


def null_profile(df: DataFrame, table_name: str | None = None) -> DataFrame:
    """Distributed profile: (table_name?, column_name, null_count, row_count).

    The single aggregate row is unpivoted with ``stack`` so the result stays a
    DataFrame and can be joined, written or unioned with other tables'.
    """
    agg = null_count_agg(df)
    n = len(df.columns)
    if n == 0:
        raise ValueError("cannot profile a table without columns")
    pairs = ", ".join(
        f"'{name.replace(chr(39), chr(92) + chr(39))}', {_null_count_col(i)}"
        for i, name in enumerate(df.columns)
    )
    out = agg.selectExpr(
        ROW_COUNT, f"stack({n}, {pairs}) AS (column_name, null_count)"
    ).select("column_name", "null_count", ROW_COUNT)
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), "*")
    return out


def catalog_null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several tables as one DataFrame (one job, one scan each)."""
    parts = [null_profile(df, name) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
