"""Column selection operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.profile import null_counts


def complete_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Keep only the columns that hold no null at all.

    The output schema depends on the data, so one aggregate job is run to
    decide it (all columns counted in one pass).  ``keep`` names columns that
    stay regardless - join keys, so a null key cannot make a later join fail.
    An empty table keeps every column (all counts are zero).
    """
    keep_lower = {k.lower() for k in keep}
    counts = null_counts(df)
    chosen = [c for c in df.columns if counts[c] == 0 or c.lower() in keep_lower]
    return df.select(*[F.col(f"`{c}`") for c in chosen])


def select_list(df: DataFrame, items: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Explicit select list: ``"col"`` or ``("col", "alias")``; qualified names ok."""
    cols: list[Column] = []
    for item in items:
        if isinstance(item, tuple):
            src, alias = item
            cols.append(F.col(src).alias(alias))
        else:
            cols.append(F.col(item))
    return df.select(*cols)


def with_date_first(df: DataFrame, ts_col: str, name: str = "date") -> DataFrame:
    """``SELECT DATE(ts) AS date, *``: a derived date in front of all columns."""
    return df.select(F.to_date(F.col(ts_col)).alias(name), "*")


def rename_all(tables: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]]):
    """Apply per-table rename maps to a dictionary of tables."""
    from quayside.functions.names import prefix_rename

    return {
        name: prefix_rename(df, renames.get(name, {})) for name, df in tables.items()
    }
