"""The layered views: harmonised orders and loyalty metrics, analytics on top.

Every view is a function of a table dictionary and a *binding* (join list,
select list, grouping columns).  ``POS`` is the binding of the point-of-sale
model; ``STANDIN`` the binding used on the TPC-H style test tables, where the
truck key sits on the order line and the location key on the franchise.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.aggregates import member_metrics
from quayside.operators.columns import select_list, with_date_first
from quayside.operators.joins import FACT_HINT, Chain, Join, join_chain
from quayside.specs import NAMESPACES


@dataclass(frozen=True)
class OrdersBinding:
    base: str
    base_alias: str
    joins: tuple[Join, ...]
    select: tuple
    ts_col: str


@dataclass(frozen=True)
class LoyaltyBinding:
    members: str
    orders: str
    member_key: str
    order_member_key: str
    group_cols: tuple[str, ...]
    amount_col: str
    set_col: str


# Order headers with their (optional) member: ``oh LEFT JOIN cl``.
_HEADERS_WITH_MEMBERS = Chain(
    "order_header",
    (Join("customer_loyalty", "oh.customer_id", "customer_id", "left", alias="cl"),),
    base_alias="oh",
)


# ---------------------------------------------------------------------------
# The harmonised orders view of the point-of-sale model - its
# join conditions and its 32-column select list in declared order - and the
# loyalty view's grouping columns and aggregated columns.
# ---------------------------------------------------------------------------
POS_ORDERS = OrdersBinding(
    base="order_detail",
    base_alias="od",
    joins=(
        # Members are joined to the order headers before the headers meet the
        # order lines: same result (the left join depends on header columns
        # only), but the line stream is not shuffled a fourth time by customer.
        Join(_HEADERS_WITH_MEMBERS, "od.order_id", "oh.order_id", "inner"),
        Join("truck", "oh.truck_id", "truck_id", "inner", alias="t"),
        Join("menu", "od.menu_item_id", "menu_item_id", "inner", alias="m"),
        Join("franchise", "t.franchise_id", "franchise_id", "inner", alias="f"),
        # Float location id against integer location id: compared as bigint.
        Join("location", "oh.location_id", "location_id", "inner", alias="l", key_type="bigint"),
    ),
    select=(
        "oh.order_id", "oh.truck_id", "oh.order_ts", "od.order_detail_id",
        "od.line_number", "m.truck_brand_name", "m.menu_type", "t.primary_city",
        "t.region", "t.country", "t.franchise_flag", "t.franchise_id",
        ("f.first_name", "franchisee_first_name"), ("f.last_name", "franchisee_last_name"),
        "l.location_id", "cl.customer_id", "cl.first_name", "cl.last_name",
        "cl.e_mail", "cl.phone_number", "cl.children_count", "cl.gender",
        "cl.marital_status", "od.menu_item_id", "m.menu_item_name", "od.quantity",
        "od.unit_price", "od.price", "oh.order_amount", "oh.order_tax_amount",
        "oh.order_discount_amount", "oh.order_total",
    ),
    ts_col="order_ts",
)

POS_LOYALTY = LoyaltyBinding(
    members="customer_loyalty",
    orders="order_header",
    member_key="customer_id",
    order_member_key="customer_id",
    group_cols=(
        "customer_id", "city", "country", "first_name", "last_name",
        "phone_number", "e_mail",
    ),
    amount_col="order_total",
    set_col="location_id",
)
# ---------------------------------------------------------------------------

# Same view shape over the stand-in tables.  Two columns are aliased, as in
# the point-of-sale view (franchisee and location names).
STANDIN_ORDERS = OrdersBinding(
    base="order_detail",
    base_alias="od",
    joins=(
        Join(_HEADERS_WITH_MEMBERS, "od.order_id", "oh.order_id", "inner"),
        Join("truck", "od.truck_id", "truck_id", "inner", alias="t"),
        Join("menu", "od.menu_item_id", "menu_item_id", "inner", alias="m"),
        Join("franchise", "t.franchise_id", "franchise_id", "inner", alias="f",
             max_broadcast_rows=1_000),
        Join("location", "f.location_id", "location_id", "inner", alias="l",
             max_broadcast_rows=1_000),
    ),
    select=(
        "oh.order_id", "od.truck_id", "oh.o_orderdate", "od.l_linenumber",
        "m.p_brand", "m.p_type", "t.s_name", "t.s_acctbal", "t.franchise_id",
        ("f.n_name", "franchisee_name"), "l.location_id", ("l.r_name", "location_name"),
        "cl.customer_id", "cl.c_name", "cl.c_acctbal", "cl.c_mktsegment",
        "od.menu_item_id", "m.p_name", "od.l_quantity", "od.l_extendedprice",
        "od.l_discount", "od.l_tax", "oh.o_totalprice", "oh.o_orderstatus",
        "oh.o_orderpriority",
    ),
    ts_col="o_orderdate",
)

STANDIN_LOYALTY = LoyaltyBinding(
    members="customer_loyalty",
    orders="order_header",
    member_key="customer_id",
    order_member_key="customer_id",
    group_cols=("customer_id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    amount_col="o_totalprice",
    set_col="o_orderpriority",
)


def orders_view(tables: Mapping[str, DataFrame], b: OrdersBinding = POS_ORDERS) -> DataFrame:
    """harmonized.orders_v: inner chain, left join to members, explicit list."""
    joined = join_chain(tables, b.base, b.joins, base_alias=b.base_alias, base_hint=FACT_HINT)
    return select_list(joined, b.select)


def loyalty_metrics_view(
    tables: Mapping[str, DataFrame], b: LoyaltyBinding = POS_LOYALTY
) -> DataFrame:
    """harmonized.customer_loyalty_metrics_v: totals and visited locations."""
    return member_metrics(
        tables[b.members],
        tables[b.orders],
        member_key=b.member_key,
        order_member_key=b.order_member_key,
        group_cols=b.group_cols,
        amount_col=b.amount_col,
        set_col=b.set_col,
    )


def orders_dated_view(
    tables: Mapping[str, DataFrame], b: OrdersBinding = POS_ORDERS
) -> DataFrame:
    """analytics.orders_v: ``DATE(order_ts) AS date, *`` over the orders view."""
    return with_date_first(orders_view(tables, b), b.ts_col)


def loyalty_pass_through(
    tables: Mapping[str, DataFrame], b: LoyaltyBinding = POS_LOYALTY
) -> DataFrame:
    """analytics.customer_loyalty_metrics_v: ``SELECT *`` over the metrics."""
    return loyalty_metrics_view(tables, b).select("*")


def setup_note() -> str:
    """Text of the literal completion row the setup script ends with."""
    return "setup is now complete"


def literal_row(spark: SparkSession, note: str | None = None) -> DataFrame:
    return spark.range(1).select(F.lit(note or setup_note()).alias("note"))


def create_namespaces(spark: SparkSession, location_root: str | None = None) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for the four layers."""
    for ns in NAMESPACES:
        if location_root:
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{location_root.rstrip('/')}/{ns}.db'"
            )
        else:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")
    return list(NAMESPACES)


def create_raw_tables(
    spark: SparkSession, specs: Mapping, tables_root: str, fmt: str = "parquet"
) -> list[str]:
    """Create (or replace) the typed, empty raw tables of a catalog in their layers.

    The tables are external (``LOCATION`` under ``tables_root``), so dropping
    and recreating one never touches another's files.
    """
    made = []
    for name, spec in specs.items():
        if spec.schema is None:
            continue
        table = f"{spec.namespace}.{name}"
        location = f"{tables_root.rstrip('/')}/{spec.namespace}/{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({spec.schema}) USING {fmt} LOCATION '{location}'")
        made.append(table)
    return made


def _relation(names: Mapping[str, str], base: str, steps, base_alias: str | None) -> str:
    """``FROM`` text of a join list with ON steps over catalog tables."""
    base_alias = base_alias or base
    out = f"{names[base]} AS {base_alias}"
    for s in steps:
        if isinstance(s.table, Chain):
            sub = s.table
            alias = sub.base_alias or sub.base
            right = f"({_relation(names, sub.base, sub.steps, sub.base_alias)})"
        else:
            alias = s.alias or s.table
            right = f"{names[s.table]} AS {alias}"
        keys = [s.left if "." in s.left else f"{base_alias}.{s.left}",
                s.right if "." in s.right else f"{alias}.{s.right}"]
        if s.key_type:  # only whole numbers match, as in ``join_chain``
            keys = [f"CASE WHEN {k} = floor({k}) THEN try_cast({k} AS {s.key_type}) END"
                    for k in keys]
        out += f"\n{s.how.upper()} JOIN {right} ON {keys[0]} = {keys[1]}"
    return out


def view_sql(
    names: Mapping[str, str],
    orders: OrdersBinding = POS_ORDERS,
    loyalty: LoyaltyBinding = POS_LOYALTY,
) -> dict[str, str]:
    """Text of the four views over catalog tables, in the order of their creation.

    Orders are summed by member key before they meet the members, as in
    ``member_metrics``.
    """
    columns = [c if isinstance(c, str) else f"{c[0]} AS {c[1]}" for c in orders.select]
    group = ", ".join(f"m.{c}" for c in loyalty.group_cols)
    money = "DECIMAL(38,4)"
    return {
        "harmonized.orders_v":
            f"SELECT {', '.join(columns)}\n"
            f"FROM {_relation(names, orders.base, orders.joins, orders.base_alias)}",
        "harmonized.customer_loyalty_metrics_v":
            f"SELECT {group}, CAST(sum(o.total) AS {money}) AS total_sales,\n"
            "array_sort(array_distinct(flatten(collect_list(o.visited)))) "
            "AS visited_location_ids_array\n"
            f"FROM {names[loyalty.members]} AS m JOIN (\n"
            f"SELECT {loyalty.order_member_key} AS member, "
            f"sum(CAST({loyalty.amount_col} AS {money})) AS total, "
            f"collect_set({loyalty.set_col}) AS visited\n"
            f"FROM {names[loyalty.orders]} GROUP BY {loyalty.order_member_key}) AS o\n"
            f"ON m.{loyalty.member_key} = o.member GROUP BY {group}",
        "analytics.orders_v":
            f"SELECT CAST({orders.ts_col} AS DATE) AS date, * FROM harmonized.orders_v",
        "analytics.customer_loyalty_metrics_v":
            "SELECT * FROM harmonized.customer_loyalty_metrics_v",
    }


def create_views(
    spark: SparkSession,
    names: Mapping[str, str],
    orders: OrdersBinding = POS_ORDERS,
    loyalty: LoyaltyBinding = POS_LOYALTY,
) -> list[str]:
    """Create (or replace) the four views in their namespaces; they outlive the session.

    ``names`` maps the tables of the model to catalog tables; the namespaces must exist.
    """
    texts = view_sql(names, orders, loyalty)
    for view, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
    return list(texts)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Register the four views as session views named after their layer."""
    views = {
        "harmonized_orders_v": orders_view(tables),
        "harmonized_customer_loyalty_metrics_v": loyalty_metrics_view(tables),
        "analytics_orders_v": orders_dated_view(tables),
        "analytics_customer_loyalty_metrics_v": loyalty_pass_through(tables),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
