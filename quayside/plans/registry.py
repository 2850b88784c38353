"""Query keys over the test tables and their SQL oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  The oracle of a key is plain SQL over the raw tables (lineitem,
orders, ...) that states the same result independently of the Spark code;
the stand-in projections are spelled out as common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names as N
from quayside.operators.aggregates import row_counts
from quayside.operators.columns import complete_columns
from quayside.operators.fanout import chain_bounds
from quayside.operators.joins import FACT_HINT, Chain, Join, join_chain
from quayside.operators.limits import (
    PREFIX_SLACK, QUERY_LOAD_CAP, WIDE_TABLE_CAP, limit_joined, limit_ordered, limit_rows,
)
from quayside.operators.profile import catalog_null_profile
from quayside.plans import views
from quayside.plans.standins import KEY_RENAMES, read_source, standin_sql_ctes, standin_tables
from quayside.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return wrap


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

_ORDERS_WIDE_SQL = """
SELECT oh.order_id, od.truck_id, oh.o_orderdate, od.l_linenumber,
       m.p_brand, m.p_type, t.s_name, t.s_acctbal, t.franchise_id,
       f.n_name AS franchisee_name, l.location_id, l.r_name AS location_name,
       cl.customer_id, cl.c_name, cl.c_acctbal, cl.c_mktsegment,
       od.menu_item_id, m.p_name, od.l_quantity, od.l_extendedprice,
       od.l_discount, od.l_tax, oh.o_totalprice, oh.o_orderstatus,
       oh.o_orderpriority
FROM order_detail od
JOIN order_header oh ON od.order_id = oh.order_id
JOIN truck t ON od.truck_id = t.truck_id
JOIN menu m ON od.menu_item_id = m.menu_item_id
JOIN franchise f ON t.franchise_id = f.franchise_id
JOIN location l ON f.location_id = l.location_id
LEFT JOIN customer_loyalty cl ON oh.customer_id = cl.customer_id
"""


@register("orders_wide", standin_sql_ctes() + _ORDERS_WIDE_SQL)
def orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.orders_view(standin_tables(spark, sf_dir), views.STANDIN_ORDERS)


@register(
    "orders_dated",
    standin_sql_ctes()
    + f"SELECT CAST(o.o_orderdate AS DATE) AS date, o.* FROM ({_ORDERS_WIDE_SQL}) o",
)
def orders_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.orders_dated_view(standin_tables(spark, sf_dir), views.STANDIN_ORDERS)


_LOYALTY_SQL = """
SELECT cl.customer_id, cl.c_name, cl.c_nationkey, cl.c_acctbal, cl.c_mktsegment,
       SUM(CAST(oh.o_totalprice AS DECIMAL(38,4))) AS total_sales,
       list_sort(array_agg(DISTINCT oh.o_orderpriority)
                 FILTER (WHERE oh.o_orderpriority IS NOT NULL)) AS visited_location_ids_array
FROM customer_loyalty cl
JOIN order_header oh ON cl.customer_id = oh.customer_id
GROUP BY cl.customer_id, cl.c_name, cl.c_nationkey, cl.c_acctbal, cl.c_mktsegment
"""


@register("loyalty_metrics", standin_sql_ctes() + _LOYALTY_SQL)
def loyalty_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.loyalty_metrics_view(standin_tables(spark, sf_dir), views.STANDIN_LOYALTY)


@register("loyalty_view", standin_sql_ctes() + f"SELECT * FROM ({_LOYALTY_SQL}) v")
def loyalty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.loyalty_pass_through(standin_tables(spark, sf_dir), views.STANDIN_LOYALTY)


# ---------------------------------------------------------------------------
# Join chains
# ---------------------------------------------------------------------------

# Stand-in counterpart of the prefix renames: name-like columns get their
# table as prefix; the customers' ``region`` does not exist and is skipped.
STANDIN_PREFIX_RENAMES = {
    "truck": {"s_name": "truck_name", "s_acctbal": "truck_acctbal"},
    "menu": {"p_name": "menu_item_name"},
    "franchise": {"n_name": "franchise_name"},
    "location": {"r_name": "location_name"},
    "customer_loyalty": {"c_name": "customer_name", "region": "customer_region"},
}

FINISHED_STATUS = "F"
ANONYMOUS_PRIORITY = "5-LOW"


def _chain_tables(spark, sf_dir, finished_only: bool):
    """All tables whole.  Misses come from keys: unfinished orders get a negative id (then
    their lines have no header), and orders of one priority get no customer."""
    t = standin_tables(spark, sf_dir)
    head = t["order_header"]
    if finished_only:
        head = head.withColumn("order_id", F.when(
            F.col("o_orderstatus") == FINISHED_STATUS, F.col("order_id"))
            .otherwise(-F.col("order_id") - 1))
    t["order_header"] = head.withColumn("customer_id", F.when(
        F.col("o_orderpriority") != ANONYMOUS_PRIORITY, F.col("customer_id")))
    return {k: N.prefix_rename(v, STANDIN_PREFIX_RENAMES.get(k, {})) for k, v in t.items()}


def _chain(how_first: str, customers: str | None):
    steps = [
        Join("order_header", "order_id", how=how_first),
        Join("truck", "truck_id", how=how_first),
        Join("menu", "menu_item_id", how=how_first),
        Join("franchise", "franchise_id", how=how_first, max_broadcast_rows=1_000),
        Join("location", "location_id", how=how_first, max_broadcast_rows=1_000),
    ]
    if customers:
        steps.append(Join(customers, "customer_id", how="left"))
    return steps


_CHAIN_CTES = ",\n".join(
    [
        standin_sql_ctes(),
        "oh_a AS (SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN customer_id END "
        "AS customer_id) FROM order_header)",
        "oh_f AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN order_id "
        "ELSE -order_id - 1 END AS order_id) FROM oh_a)",
        "truck_p AS (SELECT * EXCLUDE (s_name, s_acctbal), s_name AS truck_name, "
        "s_acctbal AS truck_acctbal FROM truck)",
        "menu_p AS (SELECT * EXCLUDE (p_name), p_name AS menu_item_name FROM menu)",
        "franchise_p AS (SELECT * EXCLUDE (n_name), n_name AS franchise_name FROM franchise)",
        "location_p AS (SELECT * EXCLUDE (r_name), r_name AS location_name FROM location)",
        "members_p AS (SELECT * EXCLUDE (c_name), c_name AS customer_name FROM customer_loyalty)",
    ]
)

_WIDE_LEFT_SQL = (
    _CHAIN_CTES
    + """
SELECT * FROM order_detail
LEFT JOIN oh_f USING (order_id)
LEFT JOIN truck_p USING (truck_id)
LEFT JOIN menu_p USING (menu_item_id)
LEFT JOIN franchise_p USING (franchise_id)
LEFT JOIN location_p USING (location_id)
"""
)


@register("wide_left", _WIDE_LEFT_SQL)
def wide_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_chain(_chain_tables(spark, sf_dir, True), "order_detail", _chain("left", None),
                      base_hint=FACT_HINT)


def _unbounded(steps: list[Join]) -> list[Join]:
    """The steps without row bounds, for plans that are only analysed."""
    return [replace(s, max_broadcast_rows=None) for s in steps]


@register(
    "wide_inner_left",
    _CHAIN_CTES
    + """
SELECT * FROM order_detail
JOIN oh_a USING (order_id)
JOIN truck_p USING (truck_id)
JOIN menu_p USING (menu_item_id)
JOIN franchise_p USING (franchise_id)
JOIN location_p USING (location_id)
LEFT JOIN members_p USING (customer_id)
""",
)
def wide_inner_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _chain_tables(spark, sf_dir, False)
    # Column order of the chain as written (USING keys lead, latest first).
    # Only analysed, never run.
    flat = _unbounded(_chain("inner", "customer_loyalty"))
    columns = join_chain(tables, "order_detail", flat).columns
    # Same rows, joined in another order: members meet the order headers
    # before the headers meet the lines (the left join reads header columns
    # only).  The wide line rows are then never shuffled by customer, and the
    # null keys of non-members stay on the narrower header side.
    headers = Chain("order_header", (Join("customer_loyalty", "customer_id", how="left"),))
    steps = [Join(headers, "order_id")] + _chain("inner", None)[1:]
    return join_chain(tables, "order_detail", steps, base_hint=FACT_HINT).select(*columns)


# A calendar holds one row per day: 100,000 rows are 270 years.  The bound is
# proven before the date dimension is broadcast, which keeps the wide fact from
# being shuffled by ship date.
CALENDAR_MAX_ROWS = 100_000


def _star_tables(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    fact = t["order_detail"].withColumn("ShipDateKey", F.to_date("l_shipdate"))
    # Role-playing date dimension: every day between the first and the last ship
    # date, from one scan of the date column.
    span = fact.agg(F.min("ShipDateKey").alias("lo"), F.max("ShipDateKey").alias("hi")).first()
    days = 0 if span["lo"] is None else (span["hi"] - span["lo"]).days + 1
    dates = (
        spark.range(days)
        .select(F.date_add(F.lit(span["lo"]).cast("date"), F.col("id").cast("int")).alias("DateKey"))
        .select(
            "DateKey",
            F.year("DateKey").alias("CalendarYear"),
            F.quarter("DateKey").alias("CalendarQuarter"),
            F.month("DateKey").alias("MonthNumber"),
        )
    )
    t["order_detail"] = fact
    t["date"] = dates
    return t


_STAR_CTES = ",\n".join(
    [
        standin_sql_ctes(),
        "fact AS (SELECT *, CAST(l_shipdate AS DATE) AS ShipDateKey FROM order_detail)",
        "dates AS (SELECT DateKey, year(DateKey) AS CalendarYear, "
        "quarter(DateKey) AS CalendarQuarter, month(DateKey) AS MonthNumber "
        "FROM (SELECT DISTINCT ShipDateKey AS DateKey FROM fact))",
    ]
)


@register(
    "star_inner",
    _STAR_CTES
    + """
SELECT * FROM fact
JOIN order_header USING (order_id)
JOIN truck USING (truck_id)
JOIN franchise USING (franchise_id)
JOIN dates ON fact.ShipDateKey = dates.DateKey
JOIN menu USING (menu_item_id)
JOIN customer USING (customer_id)
""",
)
def star_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [
        Join("order_header", "order_id"),
        Join("truck", "truck_id"),
        Join("franchise", "franchise_id", max_broadcast_rows=1_000),
        Join("date", "ShipDateKey", "DateKey", max_broadcast_rows=CALENDAR_MAX_ROWS),
        Join("menu", "menu_item_id"),
        Join("customer", "customer_id"),
    ]
    tables = _star_tables(spark, sf_dir)
    columns = join_chain(tables, "order_detail", _unbounded(steps)).columns
    # Same rows: customers meet the order headers first, so the wide line rows
    # are not shuffled by customer.
    headers = Chain("order_header", (steps[-1],))
    joined = join_chain(tables, "order_detail", [Join(headers, "order_id"), *steps[1:-1]],
                        base_hint=FACT_HINT)
    return N.writable_names(joined.select(*columns))


@register(
    "star_ship_date",
    _STAR_CTES + "\nSELECT * FROM fact JOIN dates ON fact.ShipDateKey = dates.DateKey",
)
def star_ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_chain(
        _star_tables(spark, sf_dir), "order_detail",
        [Join("date", "ShipDateKey", "DateKey", max_broadcast_rows=CALENDAR_MAX_ROWS)],
        base_hint=FACT_HINT,
    )


@register(
    "float_key_join",
    standin_sql_ctes()
    + """
SELECT * FROM (SELECT * EXCLUDE (franchise_id),
                      CAST(CAST(franchise_id AS FLOAT) AS BIGINT) AS franchise_id FROM truck) t
JOIN (SELECT * EXCLUDE (franchise_id), CAST(franchise_id AS BIGINT) AS franchise_id
      FROM franchise) f USING (franchise_id)
""",
)
def float_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = standin_tables(spark, sf_dir, ["truck", "franchise"])
    # The raw order header declares its location id FLOAT; here the truck's
    # franchise id is given that type to join it against an integer key.
    t["truck"] = t["truck"].withColumn("franchise_id", F.col("franchise_id").cast("float"))
    return join_chain(t, "truck", [Join("franchise", "franchise_id", key_type="bigint")])


@register(
    "prefix_rename",
    standin_sql_ctes()
    + """
SELECT * FROM (SELECT truck_id, franchise_id, s_name AS truck_name, s_acctbal FROM truck) t
JOIN (SELECT franchise_id, location_id, n_name AS franchise_name FROM franchise) f
USING (franchise_id)
""",
)
def prefix_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = standin_tables(spark, sf_dir, ["truck", "franchise"])
    # Both tables call their name column ``name``; prefixes keep them apart.
    # ``region`` is not a column of either table: its rename is a no-op.
    truck = N.prefix_rename(t["truck"].withColumnRenamed("s_name", "name"), {"name": "truck_name"})
    franchise = N.prefix_rename(
        t["franchise"].withColumnRenamed("n_name", "name"),
        {"name": "franchise_name", "region": "franchise_region"},
    )
    return join_chain({"truck": truck, "franchise": franchise}, "truck", [Join("franchise", "franchise_id")])


# ---------------------------------------------------------------------------
# Name rules
# ---------------------------------------------------------------------------


def _part(spark, sf_dir):
    return read_source(spark, sf_dir, "part")


@register(
    "underscore_names",
    "SELECT p_partkey AS part_key, p_name AS part_name, p_brand, p_type AS part_type, "
    "p_size, p_retailprice AS retail_price FROM part",
)
def underscore_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _part(spark, sf_dir).select(
        F.col("p_partkey").alias("part key"), F.col("p_name").alias("part name"),
        "p_brand", F.col("p_type").alias("part type"), "p_size",
        F.col("p_retailprice").alias("retail price"),
    )
    return N.apply_underscore(df)


@register(
    "sanitize_names",
    "SELECT p_partkey AS part_key, p_name AS pname, p_brand AS brand_code, "
    "p_type AS col_3, p_size AS size_class, p_retailprice FROM part",
)
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _part(spark, sf_dir).select(
        F.col("p_partkey").alias("part key"), F.col("p_name").alias('p"name'),
        F.col("p_brand").alias("brand-code"), F.col("p_type").alias(""),
        F.col("p_size").alias("size-class"), "p_retailprice",
    )
    return N.apply_sanitize(df)


@register(
    "dedupe_names",
    "SELECT p_partkey AS x_1, p_name AS y, p_brand AS x_2, p_type AS X_3, "
    "p_size AS x_0, p_retailprice FROM part",
)
def dedupe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _part(spark, sf_dir).select(
        F.col("p_partkey").alias("x"), F.col("p_name").alias("y"),
        F.col("p_brand").alias("x"), F.col("p_type").alias("X"),
        F.col("p_size").alias("x_0"), "p_retailprice",
    )
    return N.apply_dedupe(df)


# ---------------------------------------------------------------------------
# Data-dependent columns, profile, counts, limits
# ---------------------------------------------------------------------------

LOW_PRIORITY = "5-LOW"


def _orders_with_nulls(spark, sf_dir):
    o = read_source(spark, sf_dir, "orders")
    return o.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit(LOW_PRIORITY)))


@register(
    "complete_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
)
def complete_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_columns(_orders_with_nulls(spark, sf_dir))


_PROFILE_COLUMNS = {
    "order_detail": ["order_id", "menu_item_id", "truck_id", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                     "l_linestatus", "l_shipdate"],
    "order_header": ["order_id", "customer_id", "o_orderstatus", "o_totalprice",
                     "o_orderdate", "o_orderpriority"],
    "truck": ["truck_id", "s_name", "franchise_id", "s_acctbal"],
    "menu": ["menu_item_id", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "franchise": ["franchise_id", "n_name", "location_id"],
    "location": ["location_id", "r_name"],
    "customer_loyalty": ["customer_id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
}


def _profile_sql() -> str:
    parts = []
    for table, cols in _PROFILE_COLUMNS.items():
        src = "oh_n" if table == "order_header" else table
        for c in cols:
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count "
                f"FROM {src}"
            )
    return (
        standin_sql_ctes()
        + ",\noh_n AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) "
        "FROM order_header)\n"
        + "\nUNION ALL\n".join(parts)
    )


def _profiled_tables(spark, sf_dir):
    t = standin_tables(spark, sf_dir, list(_PROFILE_COLUMNS))
    t["order_header"] = t["order_header"].withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit(LOW_PRIORITY))
    )
    return t


@register("null_profile", _profile_sql())
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_null_profile(_profiled_tables(spark, sf_dir))


@register(
    "row_count",
    standin_sql_ctes()
    + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _PROFILE_COLUMNS
    ),
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(standin_tables(spark, sf_dir, list(_PROFILE_COLUMNS)))


@register(
    "limit_rows",
    f"SELECT count(*) AS row_count FROM ({_WIDE_LEFT_SQL} LIMIT 20000) capped",
)
def limit_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = limit_rows(wide_left(spark, sf_dir), 20_000)
    return capped.agg(F.count(F.lit(1)).alias("row_count"))


_LINE_ORDER = ("order_id", "menu_item_id", "truck_id", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
               "l_shipdate")


def _first_lines_sql(n: int) -> str:
    return standin_sql_ctes() + (
        f"\nSELECT * FROM order_detail ORDER BY {', '.join(_LINE_ORDER)} LIMIT {n}")


@register("limit_ordered", _first_lines_sql(WIDE_TABLE_CAP))
def limit_ordered_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = standin_tables(spark, sf_dir, ["order_detail"])["order_detail"]
    return limit_ordered(od, WIDE_TABLE_CAP, _LINE_ORDER)


@register("limit_query_load", _first_lines_sql(QUERY_LOAD_CAP))
def limit_query_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = standin_tables(spark, sf_dir, ["order_detail"])["order_detail"]
    return limit_ordered(od, QUERY_LOAD_CAP, _LINE_ORDER)


def _inner_chain(spark: SparkSession, sf_dir: str, odd_trucks: bool = False):
    """The fact and what the harmonised orders view joins to it.

    With ``odd_trucks`` all but one truck in 50 have keys that no line has.
    """
    tables = standin_tables(spark, sf_dir)
    if odd_trucks:
        tables["truck"] = tables["truck"].withColumn("truck_id", F.expr(
            "CASE WHEN truck_id % 50 = 1 THEN truck_id ELSE -truck_id - 1 END"))

    def join(lines: DataFrame) -> DataFrame:
        return views.orders_view({**tables, "order_detail": lines}, views.STANDIN_ORDERS)

    def read(files: list[str]) -> DataFrame:
        return spark.read.parquet(*files).withColumnsRenamed(KEY_RENAMES["order_detail"][1])

    return tables["order_detail"], join, read


@register("limit_joined", standin_sql_ctes() + f"""
SELECT least(count(*), {QUERY_LOAD_CAP}) AS row_count,
       least(count(*), {QUERY_LOAD_CAP}) AS rows_of_the_view,
       least(count(*), {PREFIX_SLACK * QUERY_LOAD_CAP}) AS fact_rows_joined
FROM ({_ORDERS_WIDE_SQL})
""")
def limit_joined_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap over the joined query: how many rows, how many of them are rows of the whole
    view, and how many fact rows were joined for that."""
    fact, join, read = _inner_chain(spark, sf_dir)
    capped = limit_joined(fact, join, QUERY_LOAD_CAP, scratch_path(spark, "tables", "capped"), read)
    key = ["order_id", "l_linenumber", "menu_item_id", "truck_id", "l_quantity", "l_extendedprice",
           "customer_id", "p_name", "s_name", "location_name"]
    found = capped.rows.select(*key).join(join(fact).select(*key).distinct(), key, "left_semi")
    return capped.rows.agg(F.count(F.lit(1)).alias("row_count")).crossJoin(
        found.agg(F.count(F.lit(1)).alias("rows_of_the_view"))
    ).withColumn("fact_rows_joined", F.lit(sum(n for _, n in capped.attempts)).cast("bigint"))


@register("limit_joined_few", standin_sql_ctes() + _ORDERS_WIDE_SQL.replace(
    "JOIN menu m", "AND t.truck_id % 50 = 1\nJOIN menu m"))
def limit_joined_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that drops nearly all rows: the cap is not reached, every row is returned."""
    fact, join, read = _inner_chain(spark, sf_dir, odd_trucks=True)
    return limit_joined(fact, join, QUERY_LOAD_CAP, scratch_path(spark, "tables", "capped"), read).rows


_TWICE = "CASE WHEN {key} % 10 = 0 THEN 3 ELSE 1 END"


def _fan_out_sql() -> str:
    """Exact outputs of the chain's steps when one key in ten of two dimensions stands thrice."""
    return standin_sql_ctes() + f""",
menu_3 AS (SELECT * FROM menu, range({_TWICE.format(key='menu_item_id')})),
truck_3 AS (SELECT * FROM truck, range({_TWICE.format(key='truck_id')}))
SELECT 1 AS step, 'order_header' AS table_name, count(*) AS exact, true AS holds, true AS close
FROM order_detail JOIN order_header USING (order_id)
UNION ALL SELECT 2, 'menu', count(*), true, true FROM order_detail JOIN menu_3 USING (menu_item_id)
UNION ALL SELECT 3, 'truck', count(*), true, true FROM order_detail JOIN truck_3 USING (truck_id)
UNION ALL SELECT 0, 'chain', count(*), true, true FROM order_detail JOIN order_header USING (order_id)
JOIN menu_3 USING (menu_item_id) JOIN truck_3 USING (truck_id)
"""


@register("fan_out_bounds", _fan_out_sql())
def fan_out_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of a chain over dimensions with duplicate keys, beside the exact numbers: no
    join gives more rows than its bound, and no single join's bound is twice too high."""
    tables = standin_tables(spark, sf_dir, ["order_detail", "order_header", "menu", "truck"])
    for name, key in (("menu", "menu_item_id"), ("truck", "truck_id")):
        times = F.expr(f"sequence(1, {_TWICE.format(key=key)})")
        tables[name] = tables[name].withColumn("copy", F.explode(times)).drop("copy")
    steps = [Join("order_header", "order_id"), Join("menu", "menu_item_id"), Join("truck", "truck_id")]
    bounds = chain_bounds(tables, "order_detail", steps)
    rows = []
    for i, ((name, bound, _), step) in enumerate(zip(bounds, steps), 1):
        exact = tables["order_detail"].select(step.left).join(
            tables[name].select(step.left), step.left).count()
        rows.append((i, name, exact, exact <= bound.rows, bound.rows <= 2 * exact))
    chain = join_chain({n: t.select(*[c for c in t.columns if c in ("order_id", "menu_item_id", "truck_id")])
                        for n, t in tables.items()}, "order_detail", steps).count()
    rows.append((0, "chain", chain, chain <= bounds[-1][2], True))
    return spark.createDataFrame(
        rows, "step int, table_name string, exact bigint, holds boolean, close boolean")


# Load-side keys register themselves on import.
from quayside.plans import load_queries  # noqa: E402,F401
