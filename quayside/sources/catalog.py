"""Load a catalog of tables, isolating failures per table.

Failures show up at two moments because reads are lazy: a missing folder is
found while the scan is planned (caught here, in ``load_catalog``), bad
content only when a job runs (caught by the sinks' ``save_catalog``).  Both
are returned as data instead of being printed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.joins import MissingTablesError
from quayside.sources.csv import read_csv, read_csv_gz
from quayside.specs import TableSpec

LOADED = "loaded"
MISSING = "missing"


@dataclass
class CatalogLoad:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)

    def require(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """The tables a plan needs, or ``MissingTablesError`` before any join."""
        missing = [n for n in names if n not in self.tables]
        if missing:
            raise MissingTablesError(missing)
        return self.tables

    def status(self, spark: SparkSession, with_counts: bool = True) -> DataFrame:
        """(table_name, status, row_count) - counts of all loaded tables in one job."""
        schema = T.StructType(
            [
                T.StructField("table_name", T.StringType()),
                T.StructField("status", T.StringType()),
                T.StructField("row_count", T.LongType()),
            ]
        )
        parts = []
        for name, df in self.tables.items():
            count = F.count(F.lit(1)) if with_counts else F.lit(None).cast("bigint")
            parts.append(
                df.agg(count.alias("row_count")).select(
                    F.lit(name).alias("table_name"), F.lit(LOADED).alias("status"), "row_count"
                )
            )
        missing = [(name, MISSING, None) for name in self.failures]
        out = spark.createDataFrame(missing, schema)
        for part in parts:
            out = out.unionByName(part)
        return out


def load_catalog(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    root: str,
    paths: Mapping[str, str | list[str]] | None = None,
    gzip_tables: Iterable[str] = (),
) -> CatalogLoad:
    """Scan every spec under ``root``; a failing table is recorded, not fatal.

    ``paths`` overrides the folder of single tables (a specific file, say);
    tables in ``gzip_tables`` are redistributed after their unsplittable scan.
    """
    result = CatalogLoad()
    paths = paths or {}
    gz = set(gzip_tables)
    for name, spec in specs.items():
        path = paths.get(name, spec.path(root))
        reader = read_csv_gz if name in gz else read_csv
        try:
            result.tables[name] = reader(spark, path, spec.schema, spec.header, spec.options)
        except Exception as exc:  # noqa: BLE001 - access denied, time-outs: any table may fail
            result.failures[name] = (str(exc).splitlines() or [type(exc).__name__])[0]
    return result
