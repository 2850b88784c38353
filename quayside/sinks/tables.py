"""Full-refresh writes: catalog tables and JDBC targets."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import run_concurrently
from quayside.sinks.versions import replace_rows, replace_table
from quayside.sources.jdbc import jdbc_options

log = logging.getLogger(__name__)

SAVED = "saved"
FAILED = "failed"


def overwrite_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    fmt: str = "parquet",
    bucket_key: str | None = None,
    buckets: int | None = None,
) -> str:
    """Replace a catalog table's content (and schema) with ``df``, or leave both.

    A failing write leaves the old table (see ``sinks.versions``); ``path`` is the folder
    of the table's versions.

    With ``bucket_key`` and ``buckets`` the table is hash-bucketed and sorted on
    that key, so later joins and aggregates on the key read it co-partitioned
    without a shuffle.  A bucket is read by one task, whatever its size: the caller
    states a count that fits the table, and leaves it out (the default: no buckets,
    joins shuffle and AQE splits hot keys) where one key holds much of it.  Rows are
    first distributed on the key, into as many partitions as buckets, so each task
    writes one file per bucket it owns instead of one per bucket and task.  The
    distribution is a *rebalance*: AQE splits a partition swollen by a hot key over
    several tasks (that bucket then has several files, which bucketed reads allow),
    so a key holding a third of the rows is not written by one task.
    """
    replace_table(df, table, path, fmt, bucket_key, buckets)
    return table


def declared_columns(schema: str, types: Mapping[str, str]) -> str:
    """DDL of a scan schema with the types that the stored table is declared with."""
    return ", ".join(f"`{f.name}` {types.get(f.name) or f.dataType.simpleString()}"
                     for f in T.StructType.fromDDL(schema).fields)


def write_declared(df: DataFrame, table: str, columns: str, path: str | None = None) -> str:
    """Replace a table's rows under a declared definition; text becomes VARIANT as JSON.

    Money gets its declared scale; a number beyond its digits, a text beyond its length or
    text that is not JSON is an error, and the table keeps what it had.
    """
    variants = {f.name for f in T.StructType.fromDDL(columns).fields
                if isinstance(f.dataType, T.VariantType)}
    df = df.select(*[
        F.parse_json(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in variants and isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])
    replace_rows(df, table, columns, path)
    return table


@dataclass
class SaveReport:
    saved: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    # Per saved table: column -> null count, observed while writing.
    null_counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def status(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(
            [
                T.StructField("table_name", T.StringType()),
                T.StructField("status", T.StringType()),
                T.StructField("target", T.StringType()),
            ]
        )
        rows = [(n, SAVED, t) for n, t in self.saved.items()]
        rows += [(n, FAILED, e) for n, e in self.failed.items()]
        return spark.createDataFrame(rows, schema)


# Independent tables written at the same time.  Small tables leave most task
# slots idle when written one after another; a big table's job fills the
# cluster either way, so concurrency never slows the large case.
CONCURRENT_WRITES = 4


def save_catalog(
    tables: Mapping[str, DataFrame],
    target_of: Mapping[str, str],
    path_of: Mapping[str, str] | None = None,
    bucket_of: Mapping[str, str | None] | None = None,
    buckets: int | None = None,
    observe_nulls: bool = False,
    workers: int = CONCURRENT_WRITES,
    columns_of: Mapping[str, str] | None = None,
) -> SaveReport:
    """Overwrite one target per table; a failing table keeps its old rows and does not
    stop the rest.

    ``columns_of`` states the definition of a table (``declared_columns``); values that
    do not fit it make that table fail.  Others take the types of their rows.
    """
    report = SaveReport()
    observations: dict[str, tuple[Observation, list[str]]] = {}
    jobs = {}
    for name, df in tables.items():
        if observe_nulls and df.columns:
            # Null counts ride along the write job: no extra scan later.
            observation = Observation(f"nulls_{name}")
            observations[name] = (observation, df.columns)
            df = df.observe(
                observation,
                *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                  for i, c in enumerate(df.columns)],
            )
        if columns := (columns_of or {}).get(name):
            jobs[name] = (lambda df=df, name=name, columns=columns: write_declared(
                df, target_of[name], columns, (path_of or {}).get(name)))
            continue
        jobs[name] = (lambda df=df, name=name: overwrite_table(
            df,
            target_of[name],
            path=(path_of or {}).get(name),
            bucket_key=(bucket_of or {}).get(name),
            buckets=buckets,
        ))
    spark = next(iter(tables.values())).sparkSession if tables else None
    for name, result in run_concurrently(spark, jobs, workers).items():
        if isinstance(result, Exception):  # content errors surface here
            log.error("saving %s failed: %s", name, result)
            report.failed[name] = str(result).splitlines()[0]
            continue
        report.saved[name] = result
        if name in observations:
            observation, columns = observations[name]
            got = observation.get
            report.null_counts[name] = {c: int(got[f"n{i}"]) for i, c in enumerate(columns)}
    return report


def jdbc_overwrite(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Drop-and-recreate overwrite of a JDBC table; errors are logged, re-raised."""
    opts = jdbc_options(
        url, properties, dbtable=table, batchsize=batch_size, numPartitions=num_partitions
    )
    try:
        df.write.format("jdbc").options(**opts).mode("overwrite").save()
    except Exception:
        log.exception("writing %s failed", table)
        raise


def jdbc_truncate_load(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    cascade: bool = True,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> str:
    """Empty the target (cascading to dependants), then load it.

    Keeps the target's definition, grants and dependants.  Only a target whose
    columns, read before the write, no longer fit the data is dropped and
    recreated; any failure of the write itself is raised and leaves the target's
    definition.  Returns the path taken.
    """
    columns = _target_columns(df, jdbc_options(url, properties, dbtable=table))
    if columns is not None and {c.lower() for c in columns} != {c.lower() for c in df.columns}:
        log.warning("columns of %s no longer fit the data; recreating it", table)
        jdbc_overwrite(df, url, table, properties, batch_size, num_partitions)
        return "recreate"
    opts = jdbc_options(
        url,
        properties,
        dbtable=table,
        batchsize=batch_size,
        numPartitions=num_partitions,
        truncate="true",
        cascadeTruncate="true" if cascade else "false",
    )
    df.write.format("jdbc").options(**opts).mode("overwrite").save()
    return "truncate"


def _target_columns(df: DataFrame, opts: Mapping[str, str]) -> list[str] | None:
    """Columns of a JDBC target; None if it cannot be read (the write then says why)."""
    try:
        return df.sparkSession.read.format("jdbc").options(**opts).load().columns
    except Exception as exc:  # noqa: BLE001 - no such table, mostly
        log.info("target not readable before the load: %s", exc)
        return None
