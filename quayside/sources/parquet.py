"""Parquet scans.

A parquet file is split by row groups.  A small table written as one row
group is read by one task, and everything pipelined after the scan (filters,
projections, broadcast joins) runs in that task too.  ``spread_narrow_scan``
redistributes such a scan round-robin over the available slots; a scan that
already has at least that many splits - any large table - is left as it is,
so the extra exchange exists only where the input is too narrow to use the
cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread_narrow_scan(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``min_partitions`` when the scan has fewer splits.

    Round-robin placement does not depend on key values, so a key holding a
    large share of the rows is spread like any other.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_parquet(spark: SparkSession, path: str, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread_narrow_scan(df) if spread else df
