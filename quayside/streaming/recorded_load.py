"""Stage loads that record which file was loaded when, and with how many rows.

As in ``stage_load`` a run takes exactly the files not seen before.  Each batch is written
by ``foreachBatch`` in a fixed order: its rows to ``<target>/load_batch=<id>``, then
what follows from them (such as the state of kept-up metrics), then its line for each file
to ``<history>/load_batch=<id>``.  All of these overwrite folders named after the batch, so
a batch that runs again after a lost driver replaces what it wrote; its history line is the
commit, and rows of batches without one are not read.

A streaming source knows files by their names.  ``reload_changed_files`` finds files whose
time or size differs from their history, loads them again and thereby supersedes the rows
of their earlier load: a file's rows count from its last load only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.sources.csv import _READ_DEFAULTS
from quayside.streaming.stage_load import StageLoad

BATCH = "load_batch"
FILE = "load_file"
_FILE_COLUMNS = (FILE, "file_modified", "file_bytes")
_HISTORY = (f"{FILE} string, file_modified timestamp, file_bytes bigint, row_count bigint, "
            f"sequence bigint, loaded_at timestamp, {BATCH} string")

#: Called with the rows of a batch, the rows they supersede (or None), and the batch's name.
OnBatch = Callable[[DataFrame, "DataFrame | None", str], None]


@dataclass(frozen=True)
class RecordedLoad:
    stage: StageLoad
    history: str

    @property
    def target(self) -> str:
        return self.stage.target.rstrip("/")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _options(load: RecordedLoad) -> dict[str, str]:
    return {**_READ_DEFAULTS, **(load.stage.options or {}),
            "header": "true" if load.stage.header else "false"}


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.col(f"_metadata.{m}").alias(c) for m, c in zip(
        ("file_path", "file_modification_time", "file_size"), _FILE_COLUMNS)])


def _row_schema(load: RecordedLoad) -> str:
    return (f"{load.stage.schema}, {FILE} string, file_modified timestamp, file_bytes bigint, "
            f"{BATCH} string")


def load_history(spark: SparkSession, load: RecordedLoad) -> DataFrame:
    """One row for each load of a file, ``superseded`` where a later one replaced its rows."""
    if not _exists(spark, load.history):
        empty = spark.createDataFrame([], _HISTORY)
        return empty.withColumn("superseded", F.lit(False))
    rows = spark.read.schema(_HISTORY).parquet(load.history)
    latest = F.max("sequence").over(Window.partitionBy(FILE))
    return rows.withColumn("superseded", F.col("sequence") < latest)


def read_recorded(spark: SparkSession, load: RecordedLoad) -> DataFrame:
    """The rows of every file's last load, with their file and batch."""
    if not _exists(spark, load.target):
        return spark.createDataFrame([], _row_schema(load))
    rows = spark.read.schema(_row_schema(load)).parquet(load.target)
    history = load_history(spark, load)
    # Batches and superseded files are few beside the rows: the planner can broadcast both.
    return rows.join(history.select(BATCH).distinct(), BATCH, "left_semi").join(
        history.filter("superseded").select(FILE, BATCH), [FILE, BATCH], "left_anti")


def record_batch(
    spark: SparkSession, load: RecordedLoad, rows: DataFrame, batch: str,
    on_batch: OnBatch | None = None, supersedes: DataFrame | None = None,
) -> None:
    """Write a batch and its history; writing the same batch again replaces it."""
    folder = f"{load.target}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    if on_batch:
        on_batch(written, supersedes, batch)
    before = load_history(spark, load).filter(F.col(BATCH) != batch) \
        .agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
    written.groupBy(*_FILE_COLUMNS).agg(F.count(F.lit(1)).alias("row_count")) \
        .withColumn("sequence", F.lit(before + 1).cast("bigint")) \
        .withColumn("loaded_at", F.current_timestamp()) \
        .write.mode("overwrite").parquet(f"{load.history}/{BATCH}={batch}")


def run_recorded_load(
    spark: SparkSession, load: RecordedLoad, on_batch: OnBatch | None = None,
) -> None:
    """Load every file that arrived since the last run."""
    stage = load.stage
    reader = spark.readStream.schema(stage.schema).options(**_options(load)) \
        .option("maxFileAge", stage.max_file_age)
    if stage.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(stage.max_files_per_trigger))
    query = (
        _with_file(reader.csv(stage.source)).writeStream
        .foreachBatch(lambda rows, i: record_batch(
            rows.sparkSession, load, rows, f"s{i:09d}", on_batch))
        .option("checkpointLocation", stage.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def changed_files(spark: SparkSession, load: RecordedLoad) -> DataFrame:
    """Files of the stage folder whose time or size is not that of their last load."""
    listing = spark.read.format("binaryFile").load(load.stage.source).select(*[
        F.col(f"_metadata.{m}").alias(c) for m, c in zip(
            ("file_path", "file_modification_time", "file_size"), _FILE_COLUMNS)])
    last = load_history(spark, load).filter(~F.col("superseded")).select(
        FILE, F.col("file_modified").alias("m"), F.col("file_bytes").alias("b"))
    return listing.join(last, FILE).filter(
        (F.col("file_modified") != F.col("m")) | (F.col("file_bytes") != F.col("b"))) \
        .select(*_FILE_COLUMNS)


def reload_changed_files(
    spark: SparkSession, load: RecordedLoad, on_batch: OnBatch | None = None,
) -> list[str]:
    """Load files that changed in place again; their earlier rows do not count any more."""
    files = sorted(r[FILE] for r in changed_files(spark, load).select(FILE).collect())
    if not files:
        return []
    rows = _with_file(spark.read.schema(load.stage.schema).options(**_options(load)).csv(files))
    # A later reload has a higher number; one that broke off before its commit is written anew.
    n = load_history(spark, load).filter(F.col(BATCH).startswith("r")) \
        .select(BATCH).distinct().count()
    old = read_recorded(spark, load).filter(F.col(FILE).isin(files))
    record_batch(spark, load, rows, f"r{n:09d}", on_batch, old)
    return files
