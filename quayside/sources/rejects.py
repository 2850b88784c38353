"""What a typed CSV scan cannot take: counted by reason and kept, in the scan of the load.

The load keeps every row as the scan gives it: a value that does not parse is null, a short
row is padded with nulls, a long one loses its extra fields.  ``read_with_rejects`` adds the
column ``rejected``: null for a row that was taken as it stands, else its line and the
reasons, ``short``, ``long`` and the columns whose text did not parse.  The scan itself
says which lines are malformed; only those are split a second time.  Counts come with the
write of the load as observed metrics, and the rejects table is read from that one column of
the written table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import run_concurrently
from quayside.sources.csv import _QUOTING, _READ_DEFAULTS, LINE, read_lines
from quayside.specs import TableSpec

REJECTED = "rejected"
SHORT, LONG, BAD = "short", "long", "bad "
#: A malformed line in which every field parses, such as one with an open quote.
UNREADABLE = "unreadable"


def _field_count(line: Column, options: Mapping[str, str]) -> Column:
    """Fields of a line: its separators outside of quoted fields, and one."""
    sep = options.get("sep", options.get("delimiter", ","))
    quote, escape = (options.get(k, v) for k, v in _QUOTING.items())
    s, q, e = map(re.escape, (sep, quote, escape))
    inner = f"(?:[^{q}]|{q}{q})*" if escape == quote else f"(?:[^{q}{e}]|{e}.)*"
    bare = F.regexp_replace(line, f"(?s)(^|{s}){q}{inner}{q}(?={s}|$)", "$1")
    return F.size(F.split(bare, s, -1))


def read_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    header: bool | str = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The typed scan and ``rejected`` (``line``, ``reasons``), null where nothing is wrong."""
    options = {**_READ_DEFAULTS, **(options or {})}
    fields = T.StructType.fromDDL(schema).fields
    rows = read_lines(spark, path, schema, header, options)
    line = F.col(LINE)
    texts = ", ".join(f"c{i} string" for i in range(len(fields)))
    again = F.from_csv(line, F.lit(texts), {**options, "mode": "PERMISSIVE"})
    n = _field_count(line, options)
    # A field that is there as text and null as a value did not parse.
    bad = [F.when(F.col(f"`{f.name}`").isNull() & again[f"c{i}"].isNotNull(), F.lit(BAD + f.name))
           for i, f in enumerate(fields) if not isinstance(f.dataType, T.StringType)]
    reasons = F.array_compact(F.array(
        F.when(n < len(fields), F.lit(SHORT)), F.when(n > len(fields), F.lit(LONG)), *bad))
    reasons = F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit(UNREADABLE)))
    rejected = F.when(line.isNotNull(), F.struct(line.alias("line"), reasons.alias("reasons")))
    return rows.withColumn(REJECTED, rejected).drop(LINE)


@dataclass
class LoadedRows:
    """A load written with its rejects."""

    path: str
    schema: T.StructType
    rows: int = 0
    rejected: int = 0
    reasons: dict[str, int] = field(default_factory=dict)

    def all(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def table(self, spark: SparkSession) -> DataFrame:
        """The rows, malformed ones with what could be read of them."""
        return self.all(spark).drop(REJECTED)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """``line`` and ``reasons`` of each malformed row; reads no other column."""
        return self.all(spark).filter(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*")


def load_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    target: str,
    header: bool | str = True,
    options: Mapping[str, str] | None = None,
) -> LoadedRows:
    """Write the typed rows and their rejects to ``target`` in one scan, and count both."""
    rows = read_with_rejects(spark, path, schema, header, options)
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    known = [SHORT, LONG, UNREADABLE, *[BAD + n for n in names]]
    watched = Observation()
    observed = rows.observe(
        watched, F.count(F.lit(1)).alias("rows"), F.count(REJECTED).alias("rejected"),
        *[F.count_if(F.array_contains(f"{REJECTED}.reasons", r)).alias(f"r{i}")
          for i, r in enumerate(known)])
    observed.write.mode("overwrite").parquet(target)
    got = watched.get
    return LoadedRows(target, rows.schema, int(got["rows"]), int(got["rejected"]), {
        r: int(got[f"r{i}"]) for i, r in enumerate(known) if got[f"r{i}"]})


def load_catalog_with_rejects(
    spark: SparkSession, specs: Mapping[str, TableSpec], root: str, target_root: str,
) -> dict[str, LoadedRows | Exception]:
    """Every table of a catalog loaded with its rejects; a failing one is returned as its error."""
    return run_concurrently(spark, {
        name: (lambda spec=spec, name=name: load_with_rejects(
            spark, spec.path(root), spec.schema, f"{target_root.rstrip('/')}/{name}", spec.header,
            spec.options))
        for name, spec in specs.items()})


def reject_counts(spark: SparkSession, loads: Mapping[str, LoadedRows]) -> DataFrame:
    """(table_name, reason, row_count) of loaded tables; ``rejected`` counts each row once."""
    rows = [(name, reason, n) for name, x in loads.items()
            for reason, n in [("rows", x.rows), ("rejected", x.rejected), *x.reasons.items()]]
    return spark.createDataFrame(rows, "table_name string, reason string, row_count bigint")
