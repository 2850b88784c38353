"""Incremental bulk load of a stage folder.

A stage folder receives new CSV files over time.  The load is a Structured
Streaming query over the file source with ``trigger(availableNow=True)``:
each run processes exactly the files not seen before and stops.  The file
sink's commit log together with the checkpoint make every file land exactly
once, even if executors are lost or a run is repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.session import run_concurrently
from quayside.sources.catalog import CatalogLoad
from quayside.sources.csv import _READ_DEFAULTS
from quayside.specs import TableSpec


@dataclass(frozen=True)
class StageLoad:
    source: str
    schema: str
    target: str
    checkpoint: str
    header: bool = True
    fmt: str = "parquet"
    max_files_per_trigger: int | None = None
    options: Mapping[str, str] | None = None
    # Files older than this, against the newest one seen, are never loaded.  The default
    # lies beyond any retention: a file that arrives late with an old date is loaded.
    max_file_age: str = "36500d"


def run_stage_load(spark: SparkSession, load: StageLoad) -> int:
    """Process every file that arrived since the last run; return batches run."""
    reader = spark.readStream.schema(load.schema).option(
        "header", "true" if load.header else "false"
    )
    for key, value in {**_READ_DEFAULTS, **(load.options or {})}.items():
        reader = reader.option(key, value)
    reader = reader.option("maxFileAge", load.max_file_age)
    if load.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(load.max_files_per_trigger))
    stream = reader.csv(load.source)
    query = (
        stream.writeStream.format(load.fmt)
        .option("path", load.target)
        .option("checkpointLocation", load.checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(query.recentProgress)


def stage_loads(
    specs: Mapping[str, TableSpec], root: str, tables_root: str, checkpoints_root: str
) -> dict[str, StageLoad]:
    """One load per table of a catalog: its stage folder to ``tables_root/<name>``."""
    return {
        name: StageLoad(
            source=spec.path(root),
            schema=spec.schema,
            target=f"{tables_root.rstrip('/')}/{name}",
            checkpoint=f"{checkpoints_root.rstrip('/')}/{name}",
            header=spec.header,
            options=spec.options,
        )
        for name, spec in specs.items()
    }


def run_stage_loads(spark: SparkSession, loads: Mapping[str, StageLoad]) -> CatalogLoad:
    """Run the loads; a failing one is recorded and does not stop the others.

    Returns the loaded targets; a load that never had a file (no stage folder yet)
    is a failure of that table.
    """
    jobs = {n: (lambda load=load: (run_stage_load(spark, load), read_loaded(spark, load))[1])
            for n, load in loads.items()}
    result = CatalogLoad()
    for name, got in run_concurrently(spark, jobs).items():
        if isinstance(got, Exception):
            result.failures[name] = (str(got).splitlines() or [type(got).__name__])[0]
        else:
            result.tables[name] = got
    return result


def read_loaded(spark: SparkSession, load: StageLoad) -> DataFrame:
    """The target as committed by the file sink (its log names the files)."""
    return spark.read.format(load.fmt).load(load.target)
