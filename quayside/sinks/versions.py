"""Replacing catalog tables so that a failure leaves the old content.

Every replacement writes a new version folder beside the old ones.  Only when it is whole
does the table's name move to it: by ``SET LOCATION`` where the definition stays the same
(and states no text length), else by two renames that the next replacement finishes or takes
back if the driver is lost between them.  Readers see the old rows or the new ones, never a part, and a plan that
reads the table may write it.  The last versions are kept: plans that were made before a
replacement can still run, and ``restore_table`` goes back to one of them.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "quayside.versions"
KEPT = 2
_NEXT, _PREVIOUS = "__next", "__previous"
#: Lines of a table's description that tell how it is laid out.
_LAYOUT = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")


@dataclass(frozen=True)
class Version:
    path: str
    bucket_key: str | None = None
    buckets: int | None = None


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def versions(spark: SparkSession, table: str) -> list[Version]:
    """The versions of a table that are kept, the present one first."""
    known = _properties(spark, table).get(VERSIONS)
    return [Version(**v) for v in json.loads(known)] if known else []


def definition(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Columns with their declared types, format and buckets, as the catalog has them."""
    rows = [(r["col_name"], r["data_type"])
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    n = next(i for i, (name, _) in enumerate(rows) if not name or name.startswith("#"))
    return rows[:n] + sorted((r for r in rows[n:] if r[0] in _LAYOUT),
                             key=lambda r: _LAYOUT.index(r[0]))


def _layout(declared: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return declared[next(i for i, r in enumerate(declared) if r[0] == "Provider"):]


def version_root(spark: SparkSession, table: str) -> str:
    """Where versions go when the caller names no folder: beside the tables of the database."""
    *namespace, name = table.replace("`", "").split(".")
    database = spark.catalog.getDatabase(".".join(namespace) or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name}__versions"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def finish_replacement(spark: SparkSession, table: str) -> None:
    """Finish, or take back, a replacement that ended between its steps."""
    if spark.catalog.tableExists(table + _PREVIOUS):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table + _PREVIOUS}")
        else:
            spark.sql(f"ALTER TABLE {table + _PREVIOUS} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table + _NEXT}")


def _moves(old: list[tuple[str, str]], new: list[tuple[str, str]]) -> bool:
    """Whether a table can get a new location.  Setting one forgets declared text lengths."""
    return old == new and not any("char(" in kind for _, kind in old)


def _point_to(spark: SparkSession, table: str, version: Version, kept: list[Version]) -> None:
    """Move the table's name to the version that ``<table>__next`` stands for."""
    following = table + _NEXT
    history = _text(json.dumps([asdict(v) for v in [version, *kept]]))
    spark.sql(f"ALTER TABLE {following} SET TBLPROPERTIES ({_text(VERSIONS)} = {history})")
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    elif versions(spark, table) and _moves(definition(spark, table), definition(spark, following)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(version.path)}")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_text(VERSIONS)} = {history})")
        spark.sql(f"DROP TABLE {following}")
    else:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table + _PREVIOUS}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
        spark.sql(f"DROP TABLE {table + _PREVIOUS}")
    spark.catalog.refreshTable(table)


def _new_version(spark: SparkSession, table: str, root: str | None) -> tuple[str, list[Version], str]:
    """Root of the versions, the present ones, and the folder of the next one."""
    finish_replacement(spark, table)
    old = versions(spark, table) if spark.catalog.tableExists(table) else []
    root = (root or version_root(spark, table)).rstrip("/")
    numbers = [int(m[1]) for v in old if (m := re.search(r"/v(\d+)_[0-9a-f]+$", v.path))]
    return root, old, f"{root}/v{max(numbers, default=0) + 1:06d}_{uuid.uuid4().hex[:8]}"


def _take_over(spark: SparkSession, table: str, version: Version, root: str, old: list[Version],
               keep: int) -> None:
    _point_to(spark, table, version, old[:keep - 1])
    for v in old[keep - 1:]:
        if v.path.startswith(root + "/v"):
            _delete(spark, v.path)


def _give_up(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table + _NEXT}")
    _delete(spark, path)


def replace_table(
    df: DataFrame,
    table: str,
    root: str | None = None,
    fmt: str = "parquet",
    bucket_key: str | None = None,
    buckets: int | None = None,
    keep: int = KEPT,
) -> Version:
    """Replace rows and definition of ``table`` by those of ``df``, or leave both.

    ``root`` is the folder of the versions.  ``keep`` versions stay (the new one among
    them), older ones are deleted.  A table that was not written here before is taken
    over; its files are deleted only if the catalog owns them.
    """
    spark = df.sparkSession
    root, old, path = _new_version(spark, table, root)
    version = Version(path, bucket_key if buckets else None, buckets if bucket_key else None)
    writer = (df.hint("rebalance", buckets, bucket_key) if version.buckets else df).write
    writer = writer.mode("error").format(fmt).option("path", path)
    if version.buckets:
        writer = writer.bucketBy(buckets, bucket_key).sortBy(bucket_key)
    try:
        writer.saveAsTable(table + _NEXT)
    except Exception:
        _give_up(spark, table, path)
        raise
    _take_over(spark, table, version, root, old, keep)
    return version


def prepare_rows(
    df: DataFrame | None,
    table: str,
    columns: str | None = None,
    root: str | None = None,
    fmt: str = "parquet",
    keep: int = KEPT,
):
    """Write rows under a declared definition; returns the function that makes them the table's.

    ``columns`` is the definition (default: the table's present one, which then stays).
    Columns of ``df`` are matched by name, missing ones are null, others are an error.
    Values are assigned as by an ANSI ``INSERT``: a number that does not fit its type or
    a text that is too long is an error.  ``df=None`` stands for no rows.  On an error
    nothing changes.
    """
    spark = df.sparkSession if df is not None else SparkSession.active()
    root, old, path = _new_version(spark, table, root)
    if columns is None:
        declared = definition(spark, table)
        columns = ", ".join(f"`{name}` {kind}" for name, kind in declared
                            if (name, kind) not in _layout(declared))
        fmt = dict(declared)["Provider"]
    following = table + _NEXT
    try:
        spark.sql(f"CREATE TABLE {following} ({columns}) USING {fmt} LOCATION {_text(path)}")
        if df is not None:
            names = spark.table(following).columns
            known = {n.lower() for n in names}
            if extra := [c for c in df.columns if c.lower() not in known]:
                raise ValueError(f"{table} has no column for {extra}")
            given = {c.lower(): c for c in df.columns}
            df.select(*[
                df[f"`{given[n.lower()]}`"].alias(n) if n.lower() in given
                else F.lit(None).alias(n) for n in names]).write.insertInto(following)
    except Exception:
        _give_up(spark, table, path)
        raise

    def publish() -> Version:
        version = Version(path)
        _take_over(spark, table, version, root, old, keep)
        return version

    publish.cancel = lambda: _give_up(spark, table, path)
    return publish


def replace_rows(df: DataFrame | None, table: str, columns: str | None = None,
                 root: str | None = None, fmt: str = "parquet", keep: int = KEPT) -> Version:
    """``prepare_rows`` and, if that went well, the swap."""
    return prepare_rows(df, table, columns, root, fmt, keep)()


def restore_table(spark: SparkSession, table: str, back: int = 1, fmt: str = "parquet") -> Version:
    """Let the table's name stand for a kept version again; the versions stay as they are.

    The columns are those of that version's files.
    """
    finish_replacement(spark, table)
    known = versions(spark, table)
    if not 0 < back < len(known):
        raise ValueError(f"{table} keeps {len(known)} versions")
    version = known.pop(back)
    layout = "" if not version.buckets else (
        f"CLUSTERED BY (`{version.bucket_key}`) SORTED BY (`{version.bucket_key}`) "
        f"INTO {version.buckets} BUCKETS")
    columns = ""
    if layout:  # a bucketed table is created with its columns stated
        schema = spark.read.format(fmt).load(version.path).schema
        columns = "(" + ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    spark.sql(f"CREATE TABLE {table + _NEXT} {columns} USING {fmt} {layout} "
              f"LOCATION {_text(version.path)}")
    _point_to(spark, table, version, known)
    return version
