"""The flows end to end on the point-of-sale fixture and a made-up sales star."""

import datetime as dt
import os

import pytest

from quayside.plans import flows
from quayside.plans.workbook_stage import write_workbook
from quayside.sinks.tables import overwrite_table
from quayside.sources.csv import write_stage
from quayside.specs import RAW_FOLDERS, pos_catalog


@pytest.fixture()
def staged(pos, tmp):
    root = f"{tmp}/stage"
    for name, df in pos.items():
        write_stage(df, f"{root}/{RAW_FOLDERS[name]}")
    return root


def test_csv_to_warehouse_then_wide(spark, staged, tmp):
    done = flows.csv_to_warehouse(spark, staged, f"{tmp}/tables", buckets=2)
    # ``country`` has no folder: reported, the seven others loaded and saved.
    assert set(done.load.failures) == {"country"}
    assert set(done.save.saved) == set(pos_catalog()) - {"country"}
    assert spark.table("raw_customer.customer_loyalty").count() == 3

    tables = {n: spark.table(t) for n, t in done.save.saved.items()}
    written = {}

    def sink(df, name):
        overwrite_table(df, name, f"{tmp}/out/{name}")
        written[name] = spark.table(name)

    # Null counts were observed during the load: no profile scan is needed.
    assert done.save.null_counts["order_detail"]["discount_id"] == 4
    wide = flows.warehouse_to_wide(tables, sink, null_counts=done.save.null_counts)
    out = written["joined_data"]
    profiled = flows.warehouse_to_wide(tables, None)
    assert profiled.columns == wide.columns
    assert out.columns[:5] == ["location_id", "franchise_id", "menu_item_id", "truck_id", "order_id"]
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    # Left chain: all four order lines stay, the unknown truck gives nulls.
    assert out.count() == 4 and wide.count() == 4
    # discount_id is null everywhere: dropped; the member key survives its null.
    assert "order_detail_discount_id" not in out.columns
    assert "customer_id" in out.columns
    # Prefixes from the rename maps.
    assert {"franchise_first_name", "location_city", "truck_country"} <= set(out.columns)


def test_csv_to_orders_inner_with_left_members(spark, staged):
    wide = flows.csv_to_orders(spark, staged)
    rows = wide.collect()
    assert len(rows) == 3  # line of the unknown truck dropped (inner chain)
    assert {r["customer_id"] for r in rows} == {500, None}
    assert len({c.lower() for c in wide.columns}) == len(wide.columns)
    # 73 columns, USING keys first in the order the chain was written, even
    # though members are joined to the order headers before the lines.
    assert len(wide.columns) == 73
    assert wide.columns[:6] == ["customer_id", "location_id", "franchise_id",
                                "menu_item_id", "truck_id", "order_id"]


def test_csv_to_orders_requires_customers(spark, staged):
    specs = dict(pos_catalog())
    specs["customer_loyalty"] = specs["customer_loyalty"].__class__(
        "customer_loyalty", "raw_customer/none/", specs["customer_loyalty"].schema)
    from quayside.operators.joins import MissingTablesError

    with pytest.raises(MissingTablesError):
        flows.csv_to_orders(spark, staged, specs=specs)


def _star_books(folder):
    os.makedirs(folder)
    sheets = {
        "Sales data": (["SALESORDERLINEKEY", "SALESTERRITORYKEY", "RESELLERKEY", "ShipDateKey",
                        "PRODUCTKEY", "CUSTOMERKEY", "Sales Amount"],
                       [(1, 1, 1, 20240101, 1, 1, 10.5), (2, 1, 1, 20240102, 2, 1, 3.0),
                        (3, 2, 1, 20240101, 1, 9, 1.0)]),
        "Sales Order data": (["SALESORDERLINEKEY", "Sales Order"], [(1, "SO1"), (2, "SO2"), (3, "SO3")]),
        "Sales Territory data": (["SALESTERRITORYKEY", "Region"], [(1, "West"), (2, "East")]),
        "Reseller data": (["RESELLERKEY", "Reseller"], [(1, "R1")]),
        "Date data": (["DateKey", "Date", "Region"], [(20240101, dt.date(2024, 1, 1), "x"),
                                                      (20240102, dt.date(2024, 1, 2), "y")]),
        "Product data": (["PRODUCTKEY", "Product"], [(1, "P1"), (2, "P2")]),
        "Customer data": (["CUSTOMERKEY", "Customer"], [(1, "C1")]),
    }
    for i, (sheet, (cols, rows)) in enumerate(sheets.items()):
        write_workbook(f"{folder}/book{i}.xlsx", sheet, cols, iter(rows))


def test_workbook_to_star(spark, tmp):
    _star_books(f"{tmp}/books")
    saved = []
    star = flows.workbook_to_star(
        spark, f"{tmp}/books", f"{tmp}/cells",
        sheet_sink=lambda df, name: saved.append(name),
    )
    assert sorted(saved) == sorted([
        "Customer_data", "Date_data", "Product_data", "Reseller_data", "Sales_Order_data",
        "Sales_Territory_data", "Sales_data"])
    # Customer 9 is unknown: its line drops out of the inner star.
    assert star.count() == 2
    cols = star.columns
    assert len({c.lower() for c in cols}) == len(cols)
    assert "Sales_Amount" in cols and "ShipDateKey" in cols and "DateKey" in cols
    # Region appears in territory and date sheets: every copy gets its position.
    assert sum(1 for c in cols if c.startswith("Region_")) == 2
