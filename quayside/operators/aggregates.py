"""Aggregates of the pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> int:
    return df.count()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables as one DataFrame / one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def member_metrics(
    members: DataFrame,
    orders: DataFrame,
    *,
    member_key: str,
    order_member_key: str,
    group_cols: Sequence[str],
    amount_col: str,
    set_col: str,
    total_alias: str = "total_sales",
    set_alias: str = "visited_location_ids_array",
    amount_type: str = "decimal(38,4)",
) -> DataFrame:
    """Per member: exact money total and the sorted distinct set of a column.

    Same result as ``members JOIN orders ON key GROUP BY group_cols`` with
    ``SUM(amount)`` and ``ARRAY_AGG(DISTINCT set_col)``, but the orders are
    aggregated per member key *before* the join.  The big side is therefore
    combined map-side and shuffled as at most one row per key and task, and a
    member holding a third of all orders costs no more in the join than any
    other.  Member rows that repeat (no uniqueness is assumed) multiply the
    partial totals exactly as they would multiply the order rows.
    """
    per_key = orders.groupBy(F.col(order_member_key).alias("__key")).agg(
        F.sum(F.col(amount_col).cast(amount_type)).alias("__total"),
        F.collect_set(F.col(set_col)).alias("__set"),
    )
    joined = members.join(per_key, members[member_key] == per_key["__key"], "inner")
    return joined.groupBy(*[members[c] for c in group_cols]).agg(
        F.sum("__total").cast(amount_type).alias(total_alias),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__set")))).alias(set_alias),
    )
