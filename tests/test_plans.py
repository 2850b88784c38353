"""Plan shape: pushdown, pruning, limit placement, pre-aggregation."""

import re

from quayside.operators.limits import limit_ordered, limit_rows
from quayside.plans import views
from quayside.plans.registry import QUERIES
from quayside.plans.standins import standin_tables


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_limit_pushed_below_left_chain(spark, sf_small):
    capped = limit_rows(QUERIES["wide_left"](spark, sf_small), 100)
    plan = _optimized(capped)
    # A LocalLimit sits on the fact side below the first left join.
    assert plan.count("LocalLimit") >= 2
    assert capped.count() == 100


def test_ordered_limit_is_take_ordered(spark, sf_small):
    od = standin_tables(spark, sf_small, ["order_detail"])["order_detail"]
    assert "TakeOrderedAndProject" in _executed(limit_ordered(od, 10))


def test_scan_reads_only_used_columns(spark, sf_small):
    df = QUERIES["orders_wide"](spark, sf_small)
    plan = _executed(df)
    # lineitem's l_returnflag / l_linestatus / l_shipdate are not selected.
    assert "l_shipdate" not in plan and "l_returnflag" not in plan


def test_members_are_all_customers(spark, sf_small):
    plan = _executed(QUERIES["orders_wide"](spark, sf_small))
    assert "EqualTo(c_mktsegment" not in plan
    members = QUERIES["loyalty_metrics"](spark, sf_small).count()
    ordering = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_custkey").distinct()
    assert members == ordering.count()


def test_loyalty_aggregates_orders_before_the_join(spark, sf_small):
    t = standin_tables(spark, sf_small)
    df = views.loyalty_metrics_view(t, views.STANDIN_LOYALTY)
    plan = _optimized(df)
    join_at = plan.find("Join Inner")
    # The per-member aggregate of the orders is a child of the join.
    assert join_at >= 0 and plan.find("AS __key", join_at) > join_at


def test_fixed_dimensions_broadcast(spark, sf_small):
    plan = _executed(QUERIES["orders_wide"](spark, sf_small))
    assert plan.count("BroadcastHashJoin") >= 2


def test_fact_is_never_the_broadcast_side(spark, sf_small):
    # Even at toy size the line items meet the order headers in a shuffle
    # join, so the rest of the chain runs on as many tasks as there are.
    for key in ("orders_wide", "wide_left", "star_inner"):
        plan = _executed(QUERIES[key](spark, sf_small))
        assert re.search(r"SortMergeJoin \[order_id#\d+L?\], \[order_id#\d+L?\]", plan), key


def test_plan_at_scale_broadcasts_only_bounded_dimensions(spark, sf_small):
    # As if every table were huge: no size-based broadcast at plan or run time.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES["orders_wide"](spark, sf_small)
        plan = _executed(df)
        # franchise and location carry a proven row bound; the rest shuffle.
        assert plan.count("BroadcastHashJoin") == 2
        assert plan.count("SortMergeJoin") == 4
        # Members meet the order headers before the lines do: the left join is
        # the deepest sort-merge join, so the line stream is shuffled three
        # times (order, truck, menu item), never by customer.
        kinds = re.findall(r"SortMergeJoin \[[^\]]*\], \[[^\]]*\], (\w+)", plan)
        assert kinds == ["Inner", "Inner", "Inner", "LeftOuter"]
        assert df.count() > 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_star_at_scale_never_shuffles_the_fact_by_date(spark, sf_small):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES["star_inner"](spark, sf_small)
        plan = _executed(df)
        # The calendar's bound is proven, so it is broadcast; the fact keeps
        # its partitioning through the date join.
        assert re.search(r"BroadcastHashJoin \[ShipDateKey#\d+\], \[DateKey#\d+\]", plan)
        assert "hashpartitioning(ShipDateKey" not in plan
        assert df.count() > 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_inner_chain_joins_members_to_headers_first(spark, sf_small):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES["wide_inner_left"](spark, sf_small)
        plan = _executed(df)
        kinds = re.findall(r"SortMergeJoin \[[^\]]*\], \[[^\]]*\], (\w+)", plan)
        assert kinds == ["Inner", "Inner", "Inner", "LeftOuter"]
        # USING keys still lead in the order the chain was written.
        assert df.columns[:6] == ["customer_id", "location_id", "franchise_id",
                                  "menu_item_id", "truck_id", "order_id"]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_join_is_split_by_aqe(spark):
    from pyspark.sql import functions as F

    from quayside.operators.joins import Join, join_chain

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # One order id holds a third of all order lines.
        lines = spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
            F.col("id").alias("line"),
        )
        headers = spark.range(30_000).select(F.col("id").alias("order_id"), (F.col("id") % 5).alias("v"))
        joined = join_chain({"od": lines, "oh": headers}, "od", [Join("oh", "order_id", how="left")])
        assert len(joined.collect()) == 30_000  # runs this plan, finalising AQE
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_limit_ordered_cutoff_matches_plain_top_n(spark, sf_small):
    from pyspark.sql import functions as F

    from quayside.plans.standins import read_source

    li = read_source(spark, sf_small, "lineitem")
    # A null-heavy first key and a first key with few values (heavy ties).
    li = li.withColumn("l_shipdate", F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_shipdate")))
    for order in (["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                  ["l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey",
                   "l_suppkey", "l_quantity", "l_extendedprice"],
                  ["l_shipdate"] + [c for c in li.columns if c != "l_shipdate"]):
        for n in (1, 37, 500, 2_000):
            plain = li.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
            cut = limit_ordered(li, n, order, sample_rows=300)
            assert _rows(cut) == _rows(plain), (order[0], n)


def test_limit_ordered_returns_rows_in_order(spark):
    """Fewer rows than asked for, ties, a hot value, nulls: always sorted."""
    rows = [(None if i % 50 == 0 else 7 if i % 3 else i % 40, -i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k int, x int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (1, 60, 400, 1_500, 3_000, 5_000):
        for sample_rows in (100, 10_000):
            got = [tuple(r) for r in limit_ordered(df, n, ["k", "x"], sample_rows).collect()]
            assert got == want[:n], (n, sample_rows)
    assert limit_ordered(df.limit(0), 5, ["k", "x"]).collect() == []


def test_limit_ordered_filters_before_the_merge(spark, sf_small):
    from quayside.plans.standins import read_source

    li = read_source(spark, sf_small, "lineitem")
    plan = _executed(limit_ordered(li, 50, ["l_orderkey", "l_linenumber"], sample_rows=300))
    assert "TakeOrderedAndProject" in plan and "PushedFilters: [Or(IsNull(l_orderkey)" in plan


def test_limit_ordered_low_cutoff_is_placed_again(spark, sf_small, monkeypatch):
    from pyspark.sql import functions as F

    from quayside.operators import limits
    from quayside.plans.standins import read_source

    li = read_source(spark, sf_small, "lineitem")
    order = ["l_extendedprice", "l_orderkey", "l_linenumber"]
    plain = li.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(500)
    for slack in (0.3, 0.01):  # placed again once or twice / never high enough
        monkeypatch.setattr(limits, "CUTOFF_SLACK", slack)
        assert _rows(limit_ordered(li, 500, order, sample_rows=300)) == _rows(plain)
