"""Member metrics that each load batch keeps up to date.

The state holds one row for each member and value of the set column: the sum of the amounts
and the number of order rows.  Such rows add up, and what a reloaded file had before can be
taken off again, so a batch only reads its own rows (and those it supersedes).  Its part
lies in a folder named after the batch: a batch that runs again replaces its part.
``compact`` adds all parts up to one snapshot that lists the batches in it; a part counts
as long as the newest whole snapshot does not list it.  Only batches that the load has
committed count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.streaming.recorded_load import BATCH, RecordedLoad, _exists, load_history

_NUMBER = "number"


@dataclass(frozen=True)
class MemberState:
    """Where the state lies, and which columns of the orders it adds up."""

    path: str
    load: RecordedLoad
    member_col: str
    amount_col: str
    set_col: str
    amount_type: str = "decimal(38,4)"

    def on_batch(self, rows: DataFrame, supersedes: DataFrame | None, batch: str) -> None:
        """The hook of a recorded load: write the part of one batch."""
        part = self._part(rows, 1)
        if supersedes is not None:
            part = self._sum(part.unionByName(self._part(supersedes, -1)))
        part.write.mode("overwrite").parquet(f"{self.path}/parts/{BATCH}={batch}")

    def _part(self, rows: DataFrame, sign: int) -> DataFrame:
        amount = F.col(self.amount_col).cast(self.amount_type)
        return rows.filter(F.col(self.member_col).isNotNull()).groupBy(
            F.col(self.member_col).alias("member"), F.col(self.set_col).alias("value")
        ).agg((F.sum(amount) * sign).cast(self.amount_type).alias("amount"),
              (F.count(amount) * sign).alias("n_amounts"),
              (F.count(F.lit(1)) * sign).alias("n_rows"))

    def _sum(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy("member", "value").agg(
            F.sum("amount").cast(self.amount_type).alias("amount"),
            F.sum("n_amounts").alias("n_amounts"), F.sum("n_rows").alias("n_rows"))

    def _snapshot(self, spark: SparkSession) -> int | None:
        """Number of the newest snapshot whose list of batches, written last, is there."""
        path = f"{self.path}/listed"
        if not _exists(spark, path):
            return None
        return spark.read.schema(f"{BATCH} string, {_NUMBER} int").parquet(path) \
            .agg(F.max(_NUMBER)).first()[0]

    def _parts(self, spark: SparkSession) -> DataFrame:
        """The parts of committed batches."""
        schema = (f"member {self._type(self.member_col)}, value {self._type(self.set_col)}, "
                  f"amount {self.amount_type}, n_amounts bigint, n_rows bigint, {BATCH} string")
        if not _exists(spark, f"{self.path}/parts"):
            return spark.createDataFrame([], schema)
        committed = load_history(spark, self.load).select(BATCH).distinct()
        return spark.read.schema(schema).parquet(f"{self.path}/parts") \
            .join(committed, BATCH, "left_semi")

    def _type(self, column: str) -> str:
        fields = T.StructType.fromDDL(self.load.stage.schema).fields
        return next(f.dataType.simpleString() for f in fields if f.name == column)

    def current(self, spark: SparkSession) -> DataFrame:
        """``member``, ``value``, ``amount``, ``n_amounts``, ``n_rows`` over all batches."""
        columns = ["member", "value", "amount", "n_amounts", "n_rows"]
        parts = self._parts(spark)
        number = self._snapshot(spark)
        if number is None:
            return self._sum(parts.select(*columns))
        listed = spark.read.schema(f"{BATCH} string").parquet(
            f"{self.path}/listed/{_NUMBER}={number}")
        newer = parts.join(listed, BATCH, "left_anti").select(*columns)
        merged = spark.read.parquet(f"{self.path}/merged/{_NUMBER}={number}").select(*columns)
        return self._sum(newer.unionByName(merged))

    def compact(self, spark: SparkSession) -> int:
        """Write all parts as one snapshot; returns its number.  Parts stay for replays."""
        number = self._snapshot(spark)
        number = 0 if number is None else number + 1
        batches = [r[0] for r in self._parts(spark).select(BATCH).distinct().collect()]
        self.current(spark).filter("n_rows <> 0").write.mode("overwrite").parquet(
            f"{self.path}/merged/{_NUMBER}={number}")
        spark.createDataFrame([(b,) for b in batches], f"{BATCH} string").write \
            .mode("overwrite").parquet(f"{self.path}/listed/{_NUMBER}={number}")
        return number

    def metrics(
        self,
        members: DataFrame,
        member_key: str,
        group_cols: Sequence[str],
        total_alias: str = "total_sales",
        set_alias: str = "visited_location_ids_array",
    ) -> DataFrame:
        """What ``member_metrics`` gives over all orders loaded so far."""
        per_key = self.current(members.sparkSession).filter("n_rows > 0").groupBy(
            F.col("member").alias("__key")).agg(
            F.when(F.sum("n_amounts") > 0, F.sum("amount")).alias("__total"),
            F.collect_set("value").alias("__set"))
        joined = members.join(per_key, members[member_key] == per_key["__key"], "inner")
        return joined.groupBy(*[members[c] for c in group_cols]).agg(
            F.sum("__total").cast(self.amount_type).alias(total_alias),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("__set")))).alias(set_alias))
