"""The end-to-end flows, as functions a scheduler calls in order.

1. ``csv_to_warehouse``  - stage folders -> typed raw tables in their layers.
2. ``warehouse_to_wide`` - raw tables -> complete columns -> prefixed names ->
   left-join chain -> row cap -> relational target.
3. ``workbook_to_star``  - workbooks -> one table per sheet -> sales star
   (inner chain with the role-playing ship date) -> writable names -> target.
4. ``csv_to_orders``     - the archived variant: stage folders -> inner chain
   with a left join to members -> one wide table.

Sinks are parameters (``Callable[[DataFrame, str], object]``), so the same
flow writes to a catalog table in tests and to a JDBC target in production.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import prefix_rename, writable_names
from quayside.operators.joins import FACT_HINT, Chain, Join, join_chain
from quayside.operators.limits import WIDE_TABLE_CAP, limit_rows
from quayside.operators.profile import catalog_null_profile
from quayside.plans.views import create_namespaces
from quayside.sinks.tables import SaveReport, save_catalog
from quayside.sources.catalog import CatalogLoad, load_catalog
from quayside.sources.workbook import read_workbook_cells, sheet_tables, stage_cells
from quayside.specs import PREFIX_RENAMES, REQUIRED_FOR_JOIN, TableSpec, pos_catalog

Sink = Callable[[DataFrame, str], object]

# Join keys of the point-of-sale model; complete-column filtering keeps them.
POS_KEYS = ("order_id", "truck_id", "menu_item_id", "franchise_id", "location_id", "customer_id")

# Left chain of the live pipeline (customers are loaded but not joined).
WIDE_LEFT_CHAIN = (
    Join("order_header", "order_id", how="left"),
    Join("truck", "truck_id", how="left"),
    Join("menu", "menu_item_id", how="left"),
    Join("franchise", "franchise_id", how="left"),
    Join("location", "location_id", how="left", key_type="bigint"),
)

# Inner chain with a left join to members (archived pipeline); the customer
# key is the order's.
INNER_LEFT_CHAIN = (
    Join("order_header", "order_id"),
    Join("truck", "truck_id"),
    Join("menu", "menu_item_id"),
    Join("franchise", "franchise_id"),
    Join("location", "location_id", key_type="bigint"),
    Join("customer_loyalty", "customer_id", how="left"),
)

# The same rows joined in another order: members meet the order headers
# before the headers meet the lines, so the wide line rows are never shuffled
# by customer (the left join reads header columns only).
INNER_LEFT_CHAIN_MEMBERS_FIRST = (
    Join(Chain("order_header", (Join("customer_loyalty", "customer_id", how="left"),)), "order_id"),
    *INNER_LEFT_CHAIN[1:5],
)

# Sales star over the sheet tables: fact first, role-playing ship date.
SALES_STAR = (
    Join("Sales_Order_data", "SALESORDERLINEKEY"),
    Join("Sales_Territory_data", "SALESTERRITORYKEY"),
    Join("Reseller_data", "RESELLERKEY"),
    Join("Date_data", "ShipDateKey", "DateKey"),
    Join("Product_data", "PRODUCTKEY"),
    Join("Customer_data", "CUSTOMERKEY"),
)


def complete_columns_catalog(
    tables: Mapping[str, DataFrame],
    keep: Sequence[str] = POS_KEYS,
    known_null_counts: Mapping[str, Mapping[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Drop every column holding a null, for all tables from one profile job.

    Keys in ``keep`` stay so that a null key cannot remove the column a later
    USING join needs.  Only one row per column reaches the driver.  Tables
    whose counts are already known (observed while they were written) are not
    scanned again.
    """
    if not tables:
        return {}
    keep_lower = {k.lower() for k in keep}
    known = known_null_counts or {}
    nulls: dict[str, set[str]] = {
        name: {c for c, n in known.get(name, {}).items() if n > 0} for name in tables
    }
    unknown = {n: df for n, df in tables.items() if n not in known}
    if unknown:
        for r in catalog_null_profile(unknown).filter(F.col("null_count") > 0).collect():
            nulls[r["table_name"]].add(r["column_name"])
    return {
        name: df.select(
            *[F.col(f"`{c}`") for c in df.columns if c not in nulls[name] or c.lower() in keep_lower]
        )
        for name, df in tables.items()
    }


@dataclass
class WarehouseLoad:
    load: CatalogLoad
    save: SaveReport


def csv_to_warehouse(
    spark: SparkSession,
    stage_root: str,
    tables_root: str,
    specs: Mapping[str, TableSpec] | None = None,
    paths: Mapping[str, str] | None = None,
    gzip_tables: Sequence[str] = (),
    buckets: int | None = None,
) -> WarehouseLoad:
    """Load every stage folder into its typed raw table; failures are returned."""
    specs = specs or pos_catalog()
    create_namespaces(spark, f"{tables_root.rstrip('/')}/_databases")
    loaded = load_catalog(spark, specs, stage_root, paths=paths, gzip_tables=gzip_tables)
    report = save_catalog(
        loaded.tables,
        target_of={n: f"{specs[n].namespace}.{n}" for n in loaded.tables},
        path_of={n: f"{tables_root.rstrip('/')}/{specs[n].namespace}/{n}" for n in loaded.tables},
        bucket_of={n: specs[n].bucket_key for n in loaded.tables},
        buckets=buckets,
        observe_nulls=True,
    )
    return WarehouseLoad(loaded, report)


def warehouse_to_wide(
    tables: Mapping[str, DataFrame],
    sink: Sink | None = None,
    target: str = "joined_data",
    cap: int | None = None,
    renames: Mapping[str, Mapping[str, str]] = PREFIX_RENAMES,
    chain: Sequence[Join] = WIDE_LEFT_CHAIN,
    null_counts: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Complete columns, prefixed names, left chain, cap; written if a sink is given.

    ``null_counts`` (from ``csv_to_warehouse``'s report) spares the profile scan.
    """
    needed = {"order_detail", *(s.table for s in chain)}
    complete = complete_columns_catalog(
        {n: tables[n] for n in needed if n in tables}, known_null_counts=null_counts
    )
    renamed = {n: prefix_rename(df, renames.get(n, {})) for n, df in complete.items()}
    wide = join_chain(renamed, "order_detail", chain, base_hint=FACT_HINT)
    if cap is not None:
        wide = limit_rows(wide, cap)
    if sink is not None:
        sink(wide, target)
    return wide


def csv_to_orders(
    spark: SparkSession,
    stage_root: str,
    sink: Sink | None = None,
    target: str = "orders_v",
    specs: Mapping[str, TableSpec] | None = None,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """Archived variant: load, prefix names, inner chain + left members."""
    loaded = load_catalog(spark, specs or pos_catalog(), stage_root, paths=paths)
    tables = loaded.require(REQUIRED_FOR_JOIN)
    renamed = {n: prefix_rename(tables[n], PREFIX_RENAMES.get(n, {})) for n in REQUIRED_FOR_JOIN}
    # Columns in the order of the chain as written (analysed, not run).
    columns = join_chain(renamed, "order_detail", INNER_LEFT_CHAIN).columns
    wide = join_chain(renamed, "order_detail", INNER_LEFT_CHAIN_MEMBERS_FIRST,
                      base_hint=FACT_HINT).select(*columns)
    if sink is not None:
        sink(wide, target)
    return wide


def workbook_to_star(
    spark: SparkSession,
    workbook_dir: str,
    cells_path: str,
    sink: Sink | None = None,
    target: str = "AdventureWorks",
    sheet_sink: Sink | None = None,
    star: Sequence[Join] = SALES_STAR,
    fact: str = "Sales_data",
) -> DataFrame:
    """Every sheet to a table, then the sales star with writable names."""
    cells = stage_cells(read_workbook_cells(spark, workbook_dir), cells_path)
    tables = sheet_tables(cells)
    if sheet_sink is not None:
        for name, df in tables.items():
            sheet_sink(df, name)
    joined = writable_names(join_chain(tables, fact, star, base_hint=FACT_HINT))
    if sink is not None:
        sink(joined, target)
    return joined
