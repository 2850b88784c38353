"""Types and null counts of columns that each load batch keeps up to date.

A batch writes, for each of its files and columns, the number of rows and nulls and the
*fit mask*: which candidate types every value is a literal of.  Numbers add up and masks are
combined by AND, so the state over all files is that of one pass over all their rows, in
whatever order they arrived, and a batch reads only its own rows.  A file that was loaded
again counts with its last load.  A column's type can only widen as rows arrive (int, bigint,
double, string); ``changes`` tells with which load it did, and when a column ceased to be
complete.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.types import apply_types, column_fits, type_choice
from quayside.streaming.recorded_load import BATCH, FILE, RecordedLoad, _exists, load_history

_PART = (f"{FILE} string, column_name string, row_count bigint, null_count bigint, "
         "value_count bigint, fit int")


@dataclass(frozen=True)
class ColumnState:
    """``path`` holds the state of ``columns`` of what ``load`` loads."""

    path: str
    load: RecordedLoad
    columns: tuple[str, ...]

    def on_batch(self, rows: DataFrame, supersedes: DataFrame | None, batch: str) -> None:
        """The hook of a recorded load: write the part of one batch."""
        column_fits(rows, self.columns, by=FILE).write.mode("overwrite").parquet(
            f"{self.path}/{BATCH}={batch}")

    def parts(self, spark: SparkSession) -> DataFrame:
        """One row for each file and column, with the ``sequence`` of the file's last load."""
        history = load_history(spark, self.load).filter(~F.col("superseded")) \
            .select(FILE, BATCH, "sequence")
        if not _exists(spark, self.path):
            return spark.createDataFrame([], f"{_PART}, {BATCH} string, sequence bigint")
        return spark.read.schema(f"{_PART}, {BATCH} string").parquet(self.path) \
            .join(history, [FILE, BATCH])

    @staticmethod
    def _merged(parts: DataFrame, *by: str) -> DataFrame:
        return parts.groupBy(*by, "column_name").agg(
            F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
            F.sum("value_count").alias("value_count"), F.bit_and("fit").alias("fit"))

    def profile(self, spark: SparkSession) -> DataFrame:
        """``column_name``, ``null_count``, ``row_count`` over all files."""
        return self._merged(self.parts(spark)).select("column_name", "null_count", "row_count")

    def types(self, spark: SparkSession) -> DataFrame:
        """``column_name``, ``inferred_type`` over all files."""
        return self._merged(self.parts(spark)).select(
            "column_name", type_choice(F.col("value_count"), F.col("fit")).alias("inferred_type"))

    def complete_columns(self, spark: SparkSession) -> list[str]:
        """The columns without a null in any file, in their order."""
        found = {r["column_name"] for r in self.profile(spark).filter("null_count = 0").collect()}
        return [c for c in self.columns if c in found]

    def typed(self, rows: DataFrame) -> DataFrame:
        """Text rows of the load under the types that hold for all of them by now."""
        types = {r["column_name"]: r["inferred_type"]
                 for r in self.types(rows.sparkSession).collect()}
        return apply_types(rows.select(*[F.col(f"`{c}`") for c in self.columns]), types)

    def changes(self, spark: SparkSession) -> DataFrame:
        """``sequence``, ``column_name``, ``old_type``, ``new_type``, ``was_complete``,
        ``is_complete`` of each load that changed a column's type or completeness.

        Loads with their first rows for a column have no old values.
        """
        by_column = Window.partitionBy("column_name").orderBy("sequence")
        so_far = by_column.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # One row for each load and column.
        steps = self._merged(self.parts(spark), "sequence").select(
            "sequence", "column_name",
            type_choice(F.sum("value_count").over(so_far), F.bit_and("fit").over(so_far))
            .alias("new_type"),
            (F.sum("null_count").over(so_far) == 0).alias("is_complete"))
        steps = steps.withColumn("old_type", F.lag("new_type").over(by_column)) \
            .withColumn("was_complete", F.lag("is_complete").over(by_column))
        return steps.filter(~F.col("old_type").eqNullSafe(F.col("new_type"))
                            | ~F.col("was_complete").eqNullSafe(F.col("is_complete"))).select(
            "sequence", "column_name", "old_type", "new_type", "was_complete", "is_complete")
