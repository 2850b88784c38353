"""Reads from relational databases through Spark's JDBC source.

A whole table is read in parallel when a numeric ``partition_column`` and
its bounds are given (one range query per partition); otherwise a single task
reads it.  A query is pushed down whole with the ``query`` option; filters and
column selections applied to a table read are pushed down by Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, properties: Mapping[str, str] | None = None, **extra) -> dict:
    opts = {"url": url}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
    fmt: str = "jdbc",
) -> DataFrame:
    extra = {"dbtable": table, "fetchsize": fetch_size}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs bounds and num_partitions")
        extra.update(
            partitionColumn=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
        )
    return spark.read.format(fmt).options(**jdbc_options(url, properties, **extra)).load()


def clean_query(sql: str) -> str:
    """Spark wraps the query in a sub-select, so a trailing ``;`` must go."""
    return sql.strip().rstrip(";").strip()


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    fetch_size: int | None = 10_000,
    fmt: str = "jdbc",
) -> DataFrame:
    opts = jdbc_options(url, properties, query=clean_query(query), fetchsize=fetch_size)
    return spark.read.format(fmt).options(**opts).load()
