"""Semi-structured columns.

JSON text loaded from CSV is parsed into Spark's ``VARIANT`` type on load;
malformed text becomes null instead of failing the load.  Fields are then
extracted by path with a target type, again null where they do not fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_variant(c: Column | str) -> Column:
    return F.try_parse_json(F.col(c) if isinstance(c, str) else c)


def variant_field(v: Column | str, path: str, type_name: str) -> Column:
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, type_name)


def with_variant(df: DataFrame, text_col: str, variant_col: str | None = None) -> DataFrame:
    """Replace (or add) a JSON text column by its parsed ``VARIANT``."""
    return df.withColumn(variant_col or text_col, parse_variant(text_col))
