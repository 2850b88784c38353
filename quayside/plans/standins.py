"""Point-of-sale shaped tables over the TPC-H style test tables.

The pipelines are written against the point-of-sale model (keys
``order_id``, ``truck_id``, ``menu_item_id``, ``franchise_id``,
``location_id``, ``customer_id``).  The test data is a TPC-H style schema, so
each stand-in is a projection that renames the join keys and keeps the other
columns under their own names.  Projections cost nothing at run time: Catalyst
folds them into the parquet scan, which still reads only the columns a query
uses.

    order_detail     <- lineitem
    order_header     <- orders
    truck            <- supplier
    menu             <- part
    franchise        <- nation     (carries the location key, n_regionkey)
    location         <- region
    customer         <- customer   (every customer)
    customer_loyalty <- customer   (all customers are members)

The test tables have no nulls and no orphan keys; queries that need misses on the
right of a left join change keys (``plans.registry``), and leave out no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.parquet import read_parquet

# stand-in table -> (source table, {source column: point-of-sale key name})
KEY_RENAMES = {
    "order_detail": (
        "lineitem",
        {"l_orderkey": "order_id", "l_partkey": "menu_item_id", "l_suppkey": "truck_id"},
    ),
    "order_header": ("orders", {"o_orderkey": "order_id", "o_custkey": "customer_id"}),
    "truck": ("supplier", {"s_suppkey": "truck_id", "s_nationkey": "franchise_id"}),
    "menu": ("part", {"p_partkey": "menu_item_id"}),
    "franchise": ("nation", {"n_nationkey": "franchise_id", "n_regionkey": "location_id"}),
    "location": ("region", {"r_regionkey": "location_id"}),
    "customer": ("customer", {"c_custkey": "customer_id"}),
    "customer_loyalty": ("customer", {"c_custkey": "customer_id"}),
}

# Dimensions whose size does not grow with the data (25 nations, 5 regions
# at every scale factor); their bound is checked before a broadcast hint.
BOUNDED_ROWS = {"franchise": 1_000, "location": 1_000}


_SOURCES: dict = {}


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the test data, resolved once per session.

    Resolving lists the files and reads the footer (about 0.1 s); later
    queries of the same session reuse the DataFrame.  The test tables are
    read-only, so the cached listing cannot go stale.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SOURCES:
        # Not spread: at these sizes an extra exchange costs more than the
        # single-task scan (measured at sf0.1); see sources.parquet.
        _SOURCES[key] = read_parquet(spark, path, spread=False)
    return _SOURCES[key]


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, renames = KEY_RENAMES[name]
    df = read_source(spark, sf_dir, source)
    return df.withColumnsRenamed(renames)


def standin_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or list(KEY_RENAMES)
    return {n: standin(spark, sf_dir, n) for n in names}


def standin_sql_ctes(names=None) -> str:
    """The same stand-ins as SQL common table expressions (for oracles)."""
    names = names or list(KEY_RENAMES)
    # A CTE named like its source table shadows it for later CTEs, so the
    # members are defined before the ``customer`` stand-in.
    names = sorted(names, key=lambda n: n != "customer_loyalty")
    parts = []
    for name in names:
        source, renames = KEY_RENAMES[name]
        renamed = ", ".join(f"{src} AS {dst}" for src, dst in renames.items())
        keep = f"* EXCLUDE ({', '.join(renames)})"
        parts.append(f"{name} AS (SELECT {renamed}, {keep} FROM {source})")
    return "WITH " + ",\n".join(parts)
