"""Query keys of the load side: CSV scans, catalog load and save, typed raw
tables, overwrites, the incremental stage load, type inference and the
semi-structured column.

Every key stages tables derived from the test tables as files in the shared
scratch folder (under ``spark.checkpoint.dir``) and reads them back, so the
work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.types import infer_types
from quayside.functions.variant import parse_variant, variant_field
from quayside.plans import views
from quayside.plans.registry import ORACLES, register
from quayside.plans.workbook_stage import stage_workbooks
from quayside.plans.standins import KEY_RENAMES, read_source, standin_sql_ctes, standin_tables
from quayside.session import scratch_path
from quayside.sinks.cascade import truncate_load
from quayside.sinks.tables import (
    declared_columns, overwrite_table, run_concurrently, save_catalog,
)
from quayside.sinks.versions import definition, restore_table
from quayside.sources.catalog import load_catalog
from quayside.sources.csv import ddl_of, read_csv, read_csv_gz, write_stage
from quayside.sources.rejects import LoadedRows, load_with_rejects, reject_counts
from quayside.specs import DECLARED_TYPES, RAW_FOLDERS, TableSpec, ddl_columns, pos_catalog
from quayside.sources.workbook import read_workbook_cells, sheet_frame, stage_cells
from quayside.sources.workbook import sheet_tables as workbook_sheet_tables
from quayside.streaming.column_state import ColumnState
from quayside.streaming.member_state import MemberState
from quayside.streaming.recorded_load import (
    BATCH, FILE, RecordedLoad, load_history, read_recorded, record_batch, reload_changed_files,
    run_recorded_load,
)
from quayside.streaming.stage_load import (
    StageLoad, read_loaded, run_stage_load, run_stage_loads, stage_loads,
)


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, sf_dir, name)


# ---------------------------------------------------------------------------
# CSV scans
# ---------------------------------------------------------------------------


#: Order states in the order in which their files arrive.
_DROPS = ("F", "O", "P")

# Staged input files, written once per session and data folder (like the
# catalog's folders below).  They are inputs derived from the test tables; the
# scans that read them back are the work of each key.
_STAGED_FILES: dict = {}


def _staged_once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED_FILES:
        _STAGED_FILES[key] = write()
    return _STAGED_FILES[key]


def _staged_orders(spark, sf_dir):
    orders = _raw(spark, sf_dir, "orders")
    path = _staged_once(
        spark, sf_dir, "orders_csv",
        lambda: write_stage(orders, scratch_path(spark, "stage", "orders")),
    )
    return orders, path


@register("csv_typed_scan", "SELECT * FROM orders")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = _staged_orders(spark, sf_dir)
    return read_csv(spark, path, schema=ddl_of(orders))


@register(
    "csv_string_scan",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders",
)
def csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = _staged_orders(spark, sf_dir)
    return read_csv(spark, path)


@register("csv_gz_scan", "SELECT * FROM lineitem")
def csv_gz_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _raw(spark, sf_dir, "lineitem")
    path = _staged_once(
        spark, sf_dir, "lineitem_gz",
        # Fastest deflate level for the staged input; the key's work is the scan.
        lambda: write_stage(lineitem, scratch_path(spark, "stage", "lineitem_gz"), compression="gzip",
                            options={"zlib.compress.level": "BEST_SPEED"}),
    )
    return read_csv_gz(spark, path, schema=ddl_of(lineitem))


@register("csv_dir_scan", "SELECT * FROM part")
def csv_dir_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _raw(spark, sf_dir, "part")
    # Several files in one folder (one per write partition) read as one table.
    path = _staged_once(
        spark, sf_dir, "part_csv",
        lambda: write_stage(part.repartition(4), scratch_path(spark, "stage", "part")),
    )
    return read_csv(spark, path, schema=ddl_of(part))


@register("csv_mixed_headers", "SELECT * FROM orders")
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files with and without a header line: every row is there, no header is."""
    orders = _raw(spark, sf_dir, "orders")

    def write() -> str:
        path = scratch_path(spark, "stage", "mixed_headers")
        for state in _DROPS:
            write_stage(orders.filter(F.col("o_orderstatus") == state), path, header=state != "O",
                        mode="append")
        return path

    path = _staged_once(spark, sf_dir, "mixed_headers", write)
    return read_csv(spark, path, schema=ddl_of(orders), header="auto")


#: Planted faults by order key: (condition, reason); the same expressions in Spark and SQL.
_FAULTS = (
    ("o_orderkey % 23 = 0", "short"), ("o_orderkey % 29 = 0 AND o_orderkey % 23 <> 0", "long"),
    ("o_orderkey % 17 = 0", "bad o_totalprice"),
    ("o_orderkey % 19 = 0 AND o_orderkey % 23 <> 0", "bad o_orderdate"),
)


def _faulty_line(day: str) -> str:
    """Text of an order's line, with the faults of its key."""
    return (
        "concat(CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING), ',', o_orderstatus, ',', "
        "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END, "
        "CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE concat(',', "
        f"CASE WHEN o_orderkey % 19 = 0 THEN '2001-13-45' ELSE {day} END, ',', o_orderpriority) END, "
        "CASE WHEN o_orderkey % 29 = 0 AND o_orderkey % 23 <> 0 THEN ',extra' ELSE '' END)")


def _faulty_orders(spark: SparkSession, sf_dir: str) -> LoadedRows:
    """The orders as text with planted faults, loaded with their rejects."""
    orders = _raw(spark, sf_dir, "orders")

    def write() -> str:
        path = scratch_path(spark, "stage", "faulty")
        orders.select(F.expr(_faulty_line("date_format(o_orderdate, 'yyyy-MM-dd')"))).write.text(path)
        return path

    path = _staged_once(spark, sf_dir, "faulty_orders", write)
    return load_with_rejects(spark, path, ddl_of(orders), scratch_path(spark, "tables", "checked"),
                             header=False)


_SQL_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_ANY_FAULT = " OR ".join(f"({c})" for c, _ in _FAULTS)


@register("reject_counts", "\nUNION ALL\n".join(
    f"SELECT 'orders' AS table_name, '{reason}' AS reason, count(*) AS row_count FROM orders "
    f"WHERE {condition}"
    for condition, reason in (("true", "rows"), (_ANY_FAULT, "rejected"), *_FAULTS)))
def reject_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(spark, {"orders": _faulty_orders(spark, sf_dir)})


@register("rejected_rows", f"""
SELECT {_faulty_line(_SQL_DAY)} AS line, concat_ws(', ', {', '.join(
    f"CASE WHEN {c} THEN '{r}' END" for c, r in _FAULTS)}) AS reasons
FROM orders WHERE {_ANY_FAULT}""")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _faulty_orders(spark, sf_dir).rejects(spark)
    return rejects.select("line", F.array_join("reasons", ", ").alias("reasons"))


@register("rows_with_faults", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) END
         AS o_totalprice,
       CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0
            THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS o_orderdate,
       CASE WHEN o_orderkey % 23 <> 0 THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def rows_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load itself: every row is there, with nulls for what could not be read."""
    return _faulty_orders(spark, sf_dir).table(spark)


# ---------------------------------------------------------------------------
# Catalog load / save, typed raw tables
# ---------------------------------------------------------------------------

CATALOG_TABLES = ("order_detail", "order_header", "truck", "menu", "franchise", "location",
                  "customer_loyalty")


#: A gzip file is read by one task: files of so many rows keep the scans wide.
_PACKED = {"zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}

_STAGED: dict = {}


def _stage_catalog(spark: SparkSession, sf_dir: str):
    """Stage the stand-ins as CSV folders in the raw layout; return (root, specs).

    The spec list also names ``country``, which has no folder: its load fails
    and is reported while the other tables load.  Staged once per session and
    data folder; the files are inputs, not results.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        _STAGED[key] = _stage_catalog_files(spark, sf_dir)
    return _STAGED[key]


def _stage_catalog_files(spark: SparkSession, sf_dir: str):
    root = scratch_path(spark, "stage", "catalog")
    tables = standin_tables(spark, sf_dir, list(CATALOG_TABLES))
    specs = {}
    writes = {}
    for name, df in tables.items():
        spec = TableSpec(name=name, folder=RAW_FOLDERS[name], schema=ddl_of(df),
                         namespace="raw_customer" if name == "customer_loyalty" else "raw_pos",
                         bucket_key="order_id" if name in ("order_detail", "order_header") else None)
        writes[name] = (lambda df=df, path=spec.path(root): write_stage(
            df, path, compression="gzip", options=_PACKED))
        specs[name] = spec
    for name, result in run_concurrently(spark, writes).items():
        if isinstance(result, Exception):
            raise result
    specs["country"] = pos_catalog()["country"]
    return root, specs


def _catalog_status_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, 'loaded' AS status, count(*) AS row_count FROM {t}"
             for t in CATALOG_TABLES]
    parts.append("SELECT 'country' AS table_name, 'missing' AS status, CAST(NULL AS BIGINT)")
    return standin_sql_ctes() + "\n" + "\nUNION ALL\n".join(parts)


@register("load_catalog", _catalog_status_sql())
def load_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, specs = _stage_catalog(spark, sf_dir)
    return load_catalog(spark, specs, root).status(spark)


def _save_loaded(spark: SparkSession, sf_dir: str, extra=None):
    root, specs = _stage_catalog(spark, sf_dir)
    loaded = load_catalog(spark, specs, root)
    views.create_namespaces(spark, scratch_path(spark, "warehouse"))
    tables_root = scratch_path(spark, "tables")
    tables = loaded.tables | (extra(loaded.tables) if extra else {})
    layer = {n: specs[n].namespace if n in specs else "raw_pos" for n in tables}
    report = save_catalog(
        tables,
        target_of={n: f"{layer[n]}.{n}" for n in tables},
        path_of={n: f"{tables_root}/{layer[n]}/{n}" for n in tables},
    )
    return loaded, report


def _key_of(name: str) -> str:
    return next(iter(KEY_RENAMES[name][1].values()))


def _unwritable(tables) -> dict[str, DataFrame]:
    """A copy of the order headers whose content fails when it is written."""
    return {"order_header_copy": tables["order_header"].withColumn(
        "checked", F.raise_error(F.lit("unreadable content")).cast("string"))}


@register(
    "save_catalog",
    standin_sql_ctes() + "\n" + "\nUNION ALL\n".join(
        [f"SELECT '{t}' AS table_name, 'saved' AS status, count(*) AS row_count, "
         f"CAST(sum({_key_of(t)}) AS BIGINT) AS key_sum FROM {t}" for t in CATALOG_TABLES]
        + ["SELECT 'order_header_copy', 'failed', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"]
    ),
)
def save_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each table of the save, with rows and key sum read back from the target."""
    _, report = _save_loaded(spark, sf_dir, _unwritable)
    parts = [
        spark.table(target).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(_key_of(name)).cast("bigint").alias("key_sum"),
        ).select(F.lit(name).alias("table_name"), "row_count", "key_sum")
        for name, target in report.saved.items()
    ]
    content = parts[0]
    for p in parts[1:]:
        content = content.unionByName(p)
    return report.status(spark).select("table_name", "status").join(content, "table_name", "left")


def _create_layer_views(spark: SparkSession, sf_dir: str) -> None:
    _, report = _save_loaded(spark, sf_dir)
    views.create_views(spark, report.saved, views.STANDIN_ORDERS, views.STANDIN_LOYALTY)


@register("catalog_orders_view", ORACLES["orders_dated"])
def catalog_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``analytics.orders_v``, a persistent view over the saved raw tables."""
    _create_layer_views(spark, sf_dir)
    return spark.table("analytics.orders_v")


@register("catalog_loyalty_view", ORACLES["loyalty_view"])
def catalog_loyalty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``analytics.customer_loyalty_metrics_v``, a persistent view over the saved raw tables."""
    _create_layer_views(spark, sf_dir)
    return spark.table("analytics.customer_loyalty_metrics_v")


@register("stage_load_catalog", _catalog_status_sql())
def stage_load_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage folder loaded incrementally into its table; a missing folder is reported."""
    root, specs = _stage_catalog(spark, sf_dir)
    loads = stage_loads(specs, root, scratch_path(spark, "tables", "loaded"),
                        scratch_path(spark, "checkpoints", "loaded"))
    return run_stage_loads(spark, loads).status(spark)


@register("raw_tables", ORACLES["orders_wide"])
def raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The harmonised orders view over the typed raw tables."""
    _, report = _save_loaded(spark, sf_dir)
    tables = {name: spark.table(target) for name, target in report.saved.items()}
    return views.orders_view(tables, views.STANDIN_ORDERS)


@register("table_overwrite", "SELECT * FROM orders")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _raw(spark, sf_dir, "orders")
    path = scratch_path(spark, "tables", "orders_target")
    # First load a part of the orders, then fully refresh with all of them.
    overwrite_table(orders.filter(F.col("o_orderstatus") == "F"), "orders_target", path)
    overwrite_table(orders, "orders_target", path)
    return spark.table("orders_target")


#: Where the raw tables' rows come from: test table and key.  Columns follow from the key by
#: their type, the same expressions in Spark and SQL.
_RAW_SOURCES = {
    "country": ("nation", "n_nationkey"), "franchise": ("nation", "n_nationkey"),
    "location": ("region", "r_regionkey"), "menu": ("part", "p_partkey"),
    "truck": ("supplier", "s_suppkey"), "order_header": ("orders", "o_orderkey"),
    "order_detail": ("lineitem", "l_orderkey"), "customer_loyalty": ("customer", "c_custkey"),
}


def _raw_value(name: str, kind: str, declared: str, key: str) -> str:
    """A column of a raw table as an expression over its source's key."""
    kind = kind.split("(")[0]
    if declared.startswith("VARCHAR"):
        size = int(declared[8:-1])
        return f"substr(concat('{name}', CAST({key} AS STRING)), 1, {size})"
    if declared == "VARIANT":
        return f"concat('{{\"n\": ', CAST({key} % 7 AS STRING), '}}')"
    return {
        "INT": f"CAST({key} % 10000 AS INT)", "DOUBLE": f"CAST({key} AS DOUBLE) / 8",
        "FLOAT": f"CAST({key} % 100 AS FLOAT)", "DECIMAL": f"CAST({key} AS DECIMAL(18,0))",
        "DATE": f"DATE '1990-01-01' + CAST({key} % 9000 AS INT)",
        "TIMESTAMP_NTZ": "CAST(DATE '1990-01-01' AS {ts})",
    }.get(kind, f"concat('{name} ', CAST({key} AS STRING))")


def _raw_columns(table: str) -> list[tuple[str, str, str, str]]:
    """(column, scan type, declared type, expression) of a raw table."""
    key = _RAW_SOURCES[table][1]
    out = []
    for name, kind in ddl_columns(pos_catalog()[table].schema):
        declared = DECLARED_TYPES[table].get(name, kind)
        out.append((name, kind, declared.lower(), _raw_value(name, kind, declared, key)))
    return out


def _measure(column: str, kind: str, declared: str, spark: bool) -> str:
    """What a column adds up to: numbers as money, the number of a VARIANT, text by length."""
    if declared == "variant":
        value = f"variant_get({column}, '$.n', 'int')" if spark else \
            f"CAST(json_extract({column}, '$.n') AS INTEGER)"
    elif kind in ("INT", "DOUBLE", "FLOAT") and declared != "string" or declared.startswith("decimal"):
        value = column
    else:
        value = f"length(CAST({column} AS STRING))"
    return f"CAST(sum(CAST({value} AS DECIMAL(28,4))) AS DECIMAL(38,4))"


def _declared_sql() -> str:
    parts = []
    for table, (source, _) in _RAW_SOURCES.items():
        status = "failed" if table == "country" else "saved"
        for name, kind, declared, value in _raw_columns(table):
            value = value.replace("{ts}", "TIMESTAMP")
            parts.append(
                f"SELECT '{table}' AS table_name, '{status}' AS status, '{name}' AS column_name, "
                f"'{declared}' AS declared_type, count({value}) AS n_values, "
                f"{_measure(value, kind, declared, False)} AS total FROM {source}")
    return "\nUNION ALL\n".join(parts)


@register("declared_tables", _declared_sql())
def declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight raw tables with their declared types, saved twice and read back.

    The second time a currency of four letters is among the countries: that save fails
    and the first rows stay.
    """
    views.create_namespaces(spark, scratch_path(spark, "warehouse"))
    specs = pos_catalog()
    tables = {}
    for table, (source, _) in _RAW_SOURCES.items():
        tables[table] = _raw(spark, sf_dir, source).select(*[
            F.expr(value.replace("{ts}", "TIMESTAMP_NTZ")).cast(kind).alias(name)
            for name, kind, _, value in _raw_columns(table)])
    targets = {t: f"{specs[t].namespace}.declared_{t}" for t in tables}
    root = scratch_path(spark, "tables", "declared")
    paths = {t: f"{root}/{t}" for t in tables}
    columns = {t: declared_columns(specs[t].schema, DECLARED_TYPES[t]) for t in tables}
    save_catalog({"country": tables["country"]}, targets, paths, columns_of=columns)
    wrong = F.when(F.col("country_id") == 3, "EURO").otherwise(F.col("iso_currency"))
    second = {**tables, "country": tables["country"].withColumn("iso_currency", wrong)}
    report = save_catalog(second, targets, paths, columns_of=columns)
    parts = []
    for table, target in targets.items():
        known = dict(definition(spark, target))
        rows = _raw_columns(table)
        one = spark.table(target).selectExpr(*[
            f"struct(count(`{n}`) AS n_values, {_measure(f'`{n}`', kind, declared, True)} AS total) "
            f"AS `{n}`" for n, kind, declared, _ in rows])
        stack = ", ".join(f"'{n}', '{known[n]}', `{n}`.n_values, `{n}`.total" for n, *_ in rows)
        parts.append(one.selectExpr(
            f"'{table}' AS table_name", f"'{'saved' if table in report.saved else 'failed'}' AS status",
            f"stack({len(rows)}, {stack}) AS (column_name, declared_type, n_values, total)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Which tables refer to which in the order model, for a truncate in cascade.
_REFERS = {"menu": ["order_detail"], "order_header": ["order_detail"], "truck": ["order_detail"],
           "franchise": ["truck"], "location": ["franchise"],
           "customer_loyalty": ["order_header"]}


@register("truncate_load", standin_sql_ctes() + """
SELECT 'order_header' AS table_name, 'loaded' AS status, count(*) AS row_count,
       CAST(sum(order_id) AS BIGINT) AS key_sum, count(*) FILTER (WHERE o_orderpriority IS NULL) AS n_null
FROM order_header WHERE o_orderstatus = 'F'
UNION ALL SELECT 'order_detail', 'emptied', 0, NULL, 0
UNION ALL SELECT 'menu', 'kept', count(*), CAST(sum(menu_item_id) AS BIGINT), 0 FROM menu
UNION ALL SELECT 'customer_loyalty', 'misfit', count(*), CAST(sum(customer_id) AS BIGINT), 0
FROM customer_loyalty
""")
def truncate_load_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers are loaded anew under their definition, which empties the lines that
    refer to them; a load of members with a column that their table lacks changes nothing."""
    views.create_namespaces(spark, scratch_path(spark, "warehouse"))
    names = ["order_header", "order_detail", "menu", "customer_loyalty"]
    tables = standin_tables(spark, sf_dir, names)
    targets = {n: f"raw_pos.cascade_{n}" for n in names}
    root = scratch_path(spark, "tables", "cascade")
    save_catalog(tables, targets, {n: f"{root}/{n}" for n in names})
    refers = {f"raw_pos.cascade_{t}": [f"raw_pos.cascade_{c}" for c in children if c in names]
              for t, children in _REFERS.items()}
    finished = tables["order_header"].filter(F.col("o_orderstatus") == "F")
    # By name: in another order, and a column that is not there is null in every row.
    emptied = truncate_load(finished.select(*reversed(finished.columns)), targets["order_header"], refers)
    status = {n: "emptied" if targets[n] in emptied else "kept" for n in names}
    status["order_header"] = "loaded"
    try:
        truncate_load(tables["customer_loyalty"].withColumn("wrong", F.lit(1)),
                      targets["customer_loyalty"], refers)
    except ValueError:
        status["customer_loyalty"] = "misfit"
    keys = {n: _key_of(n) for n in names}
    out = None
    for n in names:
        null = F.col("o_orderpriority").isNull() if n == "order_header" else F.lit(False)
        part = spark.table(targets[n]).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(keys[n]).cast("bigint").alias("key_sum"),
            F.count_if(null).alias("n_null"),
        ).select(F.lit(n).alias("table_name"), F.lit(status[n]).alias("status"), "row_count",
                 "key_sum", "n_null")
        out = part if out is None else out.unionByName(part)
    return out


#: What the second save of ``failed_save`` does to a table: key shift, added columns.
_SECOND_SAVE = {"menu": (1_000_000, 0), "truck": (2_000_000, 1), "order_header": (0, 0)}


def _failed_save_sql() -> str:
    parts = []
    for name, (shift, added) in _SECOND_SAVE.items():
        status = "failed" if name == "order_header" else "saved"
        parts.append(
            f"SELECT '{name}' AS table_name, '{status}' AS status, count(*) AS row_count, "
            f"CAST(sum({_key_of(name)} + {shift}) AS BIGINT) AS key_sum, "
            f"(SELECT count(*) FROM (DESCRIBE {KEY_RENAMES[name][0]})) + {added} AS column_count "
            f"FROM {name}")
    return standin_sql_ctes() + "\n" + "\nUNION ALL\n".join(parts)


@register("failed_save", _failed_save_sql())
def failed_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog is saved twice; the second time one table's write breaks off.

    That table keeps its rows and columns; one table gets new rows in the same definition,
    one a new definition as well.
    """
    views.create_namespaces(spark, scratch_path(spark, "warehouse"))
    root = scratch_path(spark, "tables", "replaced")
    targets = {n: f"raw_pos.replaced_{n}" for n in _SECOND_SAVE}
    paths = {n: f"{root}/{n}" for n in _SECOND_SAVE}
    first = standin_tables(spark, sf_dir, list(_SECOND_SAVE))
    save_catalog(first, targets, paths)
    second = {}
    for name, (shift, added) in _SECOND_SAVE.items():
        key = _key_of(name)
        second[name] = first[name].withColumn(key, (F.col(key) + shift).cast("long"))
        for i in range(added):
            second[name] = second[name].withColumn(f"added_{i}", F.lit(i))
    # Most rows are written before the write meets the one that cannot be read.
    last = first["order_header"].agg(F.max("order_id")).first()[0]
    second["order_header"] = second["order_header"].filter(
        F.when(F.col("order_id") == last, F.raise_error(F.lit("unreadable content")).cast("boolean"))
        .otherwise(F.lit(True)))
    report = save_catalog(second, targets, paths)
    content = [
        spark.table(targets[n]).agg(F.count(F.lit(1)).alias("row_count"),
                                    F.sum(_key_of(n)).cast("bigint").alias("key_sum"))
        .select(F.lit(n).alias("table_name"), "row_count", "key_sum",
                F.lit(len(spark.table(targets[n]).columns)).cast("bigint").alias("column_count"))
        for n in _SECOND_SAVE]
    status = report.status(spark).select("table_name", "status")
    return status.join(content[0].unionByName(content[1]).unionByName(content[2]), "table_name")


@register("table_restore", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def table_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh is taken back: the table's name stands for the version before it again."""
    orders = _raw(spark, sf_dir, "orders")
    path = scratch_path(spark, "tables", "orders_restored")
    overwrite_table(orders.filter(F.col("o_orderstatus") == "F"), "orders_restored", path)
    overwrite_table(orders.withColumn("wrong", F.lit(1)), "orders_restored", path)
    restore_table(spark, "orders_restored")
    return spark.table("orders_restored")


# ---------------------------------------------------------------------------
# Incremental stage load
# ---------------------------------------------------------------------------


@register("stage_load", "SELECT * FROM orders")
def stage_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _raw(spark, sf_dir, "orders")
    source = scratch_path(spark, "stage", "orders_drop")
    load = StageLoad(
        source=source,
        schema=ddl_of(orders),
        target=scratch_path(spark, "tables", "orders_loaded"),
        checkpoint=scratch_path(spark, "checkpoints", "orders_loaded"),
    )
    # First drop: finished orders.  Load, load again (nothing new), then the
    # second drop (all other orders) arrives and is loaded.
    write_stage(orders.filter(F.col("o_orderstatus") == "F"), source, mode="append")
    run_stage_load(spark, load)
    run_stage_load(spark, load)
    write_stage(orders.filter(F.col("o_orderstatus") != "F"), source, mode="append")
    run_stage_load(spark, load)
    return read_loaded(spark, load)


def _recorded(spark: SparkSession, orders: DataFrame, name: str) -> RecordedLoad:
    root = scratch_path(spark, "recorded", name)
    return RecordedLoad(
        StageLoad(source=f"{root}/stage/*", schema=ddl_of(orders), target=f"{root}/rows",
                  checkpoint=f"{root}/checkpoint"),
        history=f"{root}/history")


def _drop_folder(load: RecordedLoad, state: str) -> str:
    return load.stage.source.replace("*", f"drop_{state}")


def _replace_files(spark: SparkSession, source: str, folder: str) -> None:
    """Put the data file of each folder ``name=<file>`` in the place of that file of ``folder``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(source)
    fs = at.getFileSystem(conf)
    for found in fs.listStatus(at):
        if not found.isDirectory():
            continue
        new = [f.getPath() for f in fs.listStatus(found.getPath())
               if f.getPath().getName().startswith("part-")]
        old = jvm.org.apache.hadoop.fs.Path(folder, found.getPath().getName().split("=", 1)[1])
        if len(new) != 1 or not (fs.delete(old, False) and fs.rename(new[0], old)):
            raise RuntimeError(f"cannot replace {old.toString()}")


def _arrive(orders: DataFrame, load: RecordedLoad, state: str) -> None:
    write_stage(orders.filter(F.col("o_orderstatus") == state), _drop_folder(load, state))


#: Column with the name of a row's file; a file's rows stay in it when it changes.
_FILE_NAME = "file_name"


def _change_in_place(load: RecordedLoad, orders: DataFrame, state: str) -> None:
    """Files of a drop get new content under their old names: amounts and customers change."""
    new = read_csv(orders.sparkSession, _drop_folder(load, state), schema=load.stage.schema) \
        .withColumn(_FILE_NAME, F.col("_metadata.file_name")) \
        .withColumn("o_totalprice", F.col("o_totalprice") * 2) \
        .withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
                    .cast(orders.schema["o_custkey"].dataType))
    changed = scratch_path(orders.sparkSession, "stage", "changed")
    write_stage(new.repartition(_FILE_NAME), changed, by=_FILE_NAME)
    _replace_files(orders.sparkSession, changed, _drop_folder(load, state))


_CHANGED_ORDERS = (
    "changed AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 "
    "ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 "
    "THEN 1 ELSE o_custkey END AS o_custkey) FROM orders)")


@register("load_history", """
SELECT 'drop_' || o_orderstatus AS folder, CAST(1 AS BIGINT) AS n_batches, false AS superseded,
       count(*) AS row_count, count(*) AS rows_read
FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'drop_P', 1, true, count(*), 0 FROM orders WHERE o_orderstatus = 'P'
""")
def load_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the history says of three drops, a batch written twice and a file that changed,
    beside the rows that the target then has of each folder."""
    orders = _raw(spark, sf_dir, "orders")
    load = _recorded(spark, orders, "history")
    for state in _DROPS:
        _arrive(orders, load, state)
        run_recorded_load(spark, load)
    run_recorded_load(spark, load)  # nothing new
    first = read_recorded(spark, load).filter(F.col(BATCH) == "s000000000").drop(BATCH)
    record_batch(spark, load, stored_rows(spark, first), "s000000000")  # as after a lost driver
    _change_in_place(load, orders, "P")
    reload_changed_files(spark, load)
    folder = F.element_at(F.split(FILE, "/"), -2)
    read = read_recorded(spark, load).groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n"))
    return load_history(spark, load).groupBy(folder.alias("folder"), "superseded").agg(
        F.countDistinct(BATCH).alias("n_batches"), F.sum("row_count").alias("row_count")
    ).join(read, "folder").select(
        "folder", "n_batches", "superseded", "row_count",
        F.when(F.col("superseded"), 0).otherwise(F.col("n")).alias("rows_read"))


def stored_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "tables", "copy")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _loyalty_after(states: int, orders: str = "orders") -> str:
    wanted = ", ".join(f"'{s}'" for s in _DROPS[:states])
    sql = ORACLES["loyalty_metrics"]
    select = sql[sql.rindex("SELECT cl."):]
    return (f"SELECT CAST({len(_DROPS) + 1 if orders == 'changed' else states} AS INTEGER) AS step, "
            f"* FROM ({select.replace('order_header', f'{orders}_{states}')})", wanted)


def _loyalty_steps_sql() -> str:
    ctes, parts = [_CHANGED_ORDERS], []
    for states, orders in ((1, "orders"), (2, "orders"), (3, "orders"), (3, "changed")):
        select, wanted = _loyalty_after(states, orders)
        ctes.append(f"{orders}_{states} AS (SELECT o_custkey AS customer_id, o_totalprice, "
                    f"o_orderpriority FROM {orders} WHERE o_orderstatus IN ({wanted}))")
        parts.append(select)
    return standin_sql_ctes() + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


@register("loyalty_kept_up", _loyalty_steps_sql())
def loyalty_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loyalty metrics after each of three drops and after a file changed in place.

    Each step reads its own files only; the state is compacted after the second drop.
    """
    orders = _raw(spark, sf_dir, "orders")
    members = standin_tables(spark, sf_dir, ["customer_loyalty"])["customer_loyalty"]
    load = _recorded(spark, orders, "loyalty")
    b = views.STANDIN_LOYALTY
    state = MemberState(scratch_path(spark, "tables", "member_state"), load, "o_custkey",
                        b.amount_col, b.set_col)
    steps = []
    for step, name in enumerate((*_DROPS, "changed"), 1):
        if name == "changed":
            _change_in_place(load, orders, _DROPS[-1])
            reload_changed_files(spark, load, state.on_batch)
        else:
            _arrive(orders, load, name)
            run_recorded_load(spark, load, state.on_batch)
        if step == 2:
            state.compact(spark)
        metrics = state.metrics(members, b.member_key, b.group_cols)
        steps.append(stored_rows(spark, metrics.select(F.lit(step).alias("step"), "*")))
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


# ---------------------------------------------------------------------------
# Type inference, semi-structured column
# ---------------------------------------------------------------------------

_ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority")
#: A flag and a code with leading zeros, the same expression in Spark and in SQL.
_DERIVED = {"is_open": "o_orderstatus = 'O'", "member_code": "lpad(CAST(o_custkey AS STRING), 12, '0')"}


def _infer_sql(values: dict[str, str] | None = None, source: str = "orders", extra: str = "") -> str:
    """Inference rules stated in SQL: first type no non-null value fails."""
    rules = {
        "int": "regexp_full_match(trim(s), '[+-]?(0|[1-9][0-9]*)') AND TRY_CAST(trim(s) AS INTEGER) IS NOT NULL",
        "bigint": "regexp_full_match(trim(s), '[+-]?(0|[1-9][0-9]*)') AND TRY_CAST(trim(s) AS BIGINT) IS NOT NULL",
        "double": "regexp_full_match(trim(s), '[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') "
                  "AND TRY_CAST(trim(s) AS DOUBLE) IS NOT NULL",
        "date": "regexp_full_match(trim(s), '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(trim(s) AS DATE) IS NOT NULL",
        "timestamp_ntz": "regexp_full_match(trim(s), "
                         "'[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?') "
                         "AND TRY_CAST(trim(s) AS TIMESTAMP) IS NOT NULL",
        "boolean": "regexp_full_match(lower(trim(s)), 'true|false')",
    }
    parts = []
    for c, value in (values or {c: c for c in _ORDERS_COLUMNS} | _DERIVED).items():
        cases = " ".join(
            f"WHEN count(*) FILTER (WHERE s IS NOT NULL AND NOT ({rule})) = 0 THEN '{t}'"
            for t, rule in rules.items()
        )
        parts.append(
            f"SELECT {extra}'{c}' AS column_name, CASE WHEN count(s) = 0 THEN 'string' {cases} "
            f"ELSE 'string' END AS inferred_type FROM (SELECT CAST({value} AS VARCHAR) AS s FROM {source})"
        )
    return "\nUNION ALL\n".join(parts)


@register("infer_types", _infer_sql())
def infer_types_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _raw(spark, sf_dir, "orders")
    as_text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    derived = [F.expr(f"CAST({value} AS STRING)").alias(c) for c, value in _DERIVED.items()]
    return infer_types(as_text.select("*", *derived))


@register(
    "variant_column",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def variant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _raw(spark, sf_dir, "events")
    return events.select(
        "event_id", variant_field(parse_variant("props"), "$.k", "int").alias("k")
    )


#: Text columns whose type widens, or which cease to be complete, as drops arrive; the same
#: expressions in Spark and SQL.
_DRIFTING = {
    "key": "CAST(o_orderkey AS VARCHAR(30))",
    "amount": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 1000 AS VARCHAR(30)) "
              "WHEN o_orderstatus = 'O' THEN concat(CAST(o_orderkey AS VARCHAR(30)), '5000000000') "
              "ELSE concat(CAST(o_orderkey AS VARCHAR(30)), '.25') END",
    "code": "CASE WHEN o_orderstatus = 'P' THEN concat('00', CAST(o_orderkey AS VARCHAR(30))) "
            "ELSE CAST(o_orderkey AS VARCHAR(30)) END",
    "day": "CASE WHEN o_orderstatus = 'O' THEN '2001-02-03 04:05:06' ELSE '2001-02-03' END",
    "note": "CASE WHEN o_orderstatus = 'F' OR o_orderkey % 5 <> 0 THEN 'x' END",
}


def _drifting_sql(select) -> str:
    """``select(rows of the drops so far, number of drops)`` for each number of drops."""
    ctes = ", ".join(
        f"upto_{n} AS (SELECT * FROM orders WHERE o_orderstatus IN "
        f"({', '.join(repr(s) for s in _DROPS[:n])}))" for n in range(1, len(_DROPS) + 1))
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(
        select(f"upto_{n}", n) for n in range(1, len(_DROPS) + 1))


def _drifting_load(spark: SparkSession, sf_dir: str, each):
    """Load the drops one after the other; the results of ``each(state, load)`` with ``step``."""
    orders = _raw(spark, sf_dir, "orders")
    text = orders.select("o_orderstatus", *[F.expr(v).alias(c) for c, v in _DRIFTING.items()])
    schema = ", ".join(f"{c} string" for c in _DRIFTING)
    root = scratch_path(spark, "recorded", "drifting")
    load = RecordedLoad(StageLoad(source=f"{root}/stage/*", schema=schema, target=f"{root}/rows",
                                  checkpoint=f"{root}/checkpoint"), history=f"{root}/history")
    state = ColumnState(f"{root}/columns", load, tuple(_DRIFTING))
    out = None
    for step, name in enumerate(_DROPS, 1):
        write_stage(text.filter(F.col("o_orderstatus") == name).drop("o_orderstatus"),
                    _drop_folder(load, name))
        run_recorded_load(spark, load, state.on_batch)
        one = stored_rows(spark, each(state, load).select(F.lit(step).alias("step"), "*"))
        out = one if out is None else out.unionByName(one)
    return out


@register("types_kept_up", _drifting_sql(
    lambda rows, n: _infer_sql(_DRIFTING, rows, f"CAST({n} AS INTEGER) AS step, ")))
def types_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types after each of three drops, as inference over all rows so far gives them."""
    return _drifting_load(spark, sf_dir, lambda state, load: state.types(spark))


@register("profile_kept_up", _drifting_sql(lambda rows, n: "\nUNION ALL\n".join(
    f"SELECT CAST({n} AS INTEGER) AS step, '{c}' AS column_name, "
    f"count(*) FILTER (WHERE {v} IS NULL) AS null_count, count(*) AS row_count FROM {rows}"
    for c, v in _DRIFTING.items())))
def profile_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The null profile after each of three drops, as one over all rows so far gives it."""
    return _drifting_load(spark, sf_dir, lambda state, load: state.profile(spark))


@register("type_changes", """
SELECT * FROM (VALUES
  (1, 'key', NULL, 'int', NULL, true), (1, 'amount', NULL, 'int', NULL, true),
  (1, 'code', NULL, 'int', NULL, true), (1, 'day', NULL, 'date', NULL, true),
  (1, 'note', NULL, 'string', NULL, true),
  (2, 'amount', 'int', 'bigint', true, true), (2, 'day', 'date', 'timestamp_ntz', true, true),
  (2, 'note', 'string', 'string', true, false),
  (3, 'amount', 'bigint', 'double', true, true), (3, 'code', 'int', 'string', true, true)
) AS t(load, column_name, old_type, new_type, was_complete, is_complete)
JOIN (SELECT count(DISTINCT o_orderstatus) AS n_loads FROM orders) ON true
""")
def type_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With which load a column's type widened or the column ceased to be complete."""
    found = _drifting_load(spark, sf_dir, lambda state, load: state.changes(spark).crossJoin(
        load_history(spark, load).agg(F.countDistinct(BATCH).alias("n_loads"))))
    return found.filter(F.col("step") == len(_DROPS)).drop("step") \
        .withColumn("sequence", F.col("sequence").cast("int")).withColumnRenamed("sequence", "load")


assert set(KEY_RENAMES) >= set(CATALOG_TABLES)


# ---------------------------------------------------------------------------
# Workbooks
# ---------------------------------------------------------------------------

# Sheets staged from the test tables (names carry blanks, as sheet names do).
WORKBOOK_SHEETS = {"Product data": "part", "Sales data": "lineitem"}


def _staged_books(spark: SparkSession, sf_dir: str, sheet: str) -> str:
    """Folder of workbooks holding ``sheet``, staged from its test table once."""
    table = WORKBOOK_SHEETS[sheet]

    def write() -> str:
        folder = scratch_path(spark, "stage", "workbooks", table)
        # One workbook per partition: spread the rows so every slot writes one.
        rows = _raw(spark, sf_dir, table).repartition(spark.sparkContext.defaultParallelism)
        stage_workbooks(rows, folder, sheet).agg(F.sum("rows")).collect()  # one row back
        return folder

    return _staged_once(spark, sf_dir, f"workbooks_{table}", write)


def _staged_workbook_cells(spark: SparkSession, sf_dir: str, sheets=None) -> DataFrame:
    folders = [_staged_books(spark, sf_dir, s) for s in WORKBOOK_SHEETS if not sheets or s in sheets]
    cells = read_workbook_cells(spark, folders)
    return stage_cells(cells, scratch_path(spark, "tables", "workbook_cells"))


# The two workbook flows are library functions, not registered queries: their input is
# a workbook that this package would have to write itself.
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheet_frame(_staged_workbook_cells(spark, sf_dir, ["Product data"]), "Product data")


def sheet_tables_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = workbook_sheet_tables(_staged_workbook_cells(spark, sf_dir))
    root = scratch_path(spark, "tables", "sheets")
    parts = []
    for name, df in tables.items():
        overwrite_table(df, name, f"{root}/{name}")
        parts.append(
            spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
