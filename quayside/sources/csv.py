"""CSV scans: typed, untyped, gzip, folders; and the matching stage writer.

Text is converted to the declared types on the scan itself (PERMISSIVE
mode): a value that does not parse becomes null, a short row is padded with
nulls, a long row loses its extra fields.  A declared schema is matched to the
fields by position; the header line of every file is skipped, not used.

``header="auto"`` decides for each file: a line in a file's first block whose fields are the
declared column names is its header, any other line is a row.  So a folder may hold files
with and without one, and no file loses its first row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.specs import TableSpec

# Quotes inside a value are doubled, by the writer and for the reader.
_QUOTING = {"quote": '"', "escape": '"'}

# No timestamp pattern: the scan takes every form that a cast from text takes.  A table
# whose text needs a pattern says so in its options.
_READ_DEFAULTS = {"mode": "PERMISSIVE", **_QUOTING}


#: The line of a row that the scan could not take as it stands.
LINE = "__line"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    header: bool | str = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan CSV text.  ``schema=None`` reads every column as string.

    ``header="auto"`` needs a schema, as only names tell a header from a row.
    """
    if header == "auto":
        return read_lines(spark, path, schema, header, options).drop(LINE)
    reader = spark.read.option("header", "true" if header else "false")
    for key, value in {**_READ_DEFAULTS, **(options or {})}.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    header: bool | str = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The typed scan and ``LINE``: the whole line of a malformed row, else null."""
    options = {**_READ_DEFAULTS, **(options or {})}
    fields = T.StructType.fromDDL(schema).fields
    rows = spark.read.options(**options).option("header", "true" if header is True else "false") \
        .option("columnNameOfCorruptRecord", LINE).option("columnPruning", "false") \
        .schema(f"{schema}, `{LINE}` string").csv(path)
    if header != "auto":
        return rows
    # A header is malformed if a column is typed; its fields are then split again.
    again = F.from_csv(F.col(LINE), F.lit(", ".join(f"c{i} string" for i in range(len(fields)))),
                       options)
    match = F.lit(True)
    for i, f in enumerate(fields):
        own = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            # Naming the column makes the scan convert it, so that the header is malformed.
            match &= own.isNull()
            own = again[f"c{i}"]
        match &= F.lower(F.trim(F.regexp_replace(own, "^\ufeff", ""))).eqNullSafe(f.name.lower())
    return rows.filter(~((F.col("_metadata.file_block_start") == 0) & match))


def read_csv_gz(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    header: bool | str = True,
    options: Mapping[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Scan gzip-compressed CSV and spread it over the cluster.

    A gzip stream cannot be split, so every file is read by exactly one task.
    When there are fewer files than task slots, the rows are redistributed
    round-robin right after the scan so the rest of the plan runs wide.
    """
    df = read_csv(spark, path, schema, header, options)
    target = partitions or spark.sparkContext.defaultParallelism
    # One task per gzip file: with fewer files than slots, spread the rows.
    if len(df.inputFiles()) < target:
        df = df.repartition(target)
    return df


def read_table(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """Scan the folder of one catalog table."""
    return read_csv(spark, spec.path(root), spec.schema, spec.header, spec.options)


def write_stage(
    df: DataFrame,
    path: str,
    header: bool = True,
    compression: str | None = None,
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
    by: str | None = None,
) -> str:
    """Write a table as CSV files (one per partition) under ``path``.

    With ``by`` the files lie in a folder for each value of that column, which they leave out.

    Timestamps are written as a cast to text gives them: all digits of the fraction, and
    none where it is zero.
    """
    df = df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])
    writer = df.write.mode(mode).option("header", "true" if header else "false")
    for key, value in _QUOTING.items():
        writer = writer.option(key, value)
    if compression:
        writer = writer.option("compression", compression)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if by:
        writer = writer.partitionBy(by)
    writer.csv(path)
    return path


def ddl_of(df: DataFrame) -> str:
    """DDL string of a DataFrame's schema, usable as a declared scan schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
