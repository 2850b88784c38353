import pytest

from quayside.operators.joins import Join, MissingTablesError, bounded_broadcast, join_chain


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def pos(spark):
    od = spark.createDataFrame(
        [(1, 10, 100), (2, 10, 101), (3, 11, 102)], "order_detail_id int, order_id int, menu_item_id int"
    )
    oh = spark.createDataFrame([(10, 7), (11, 8)], "order_id int, truck_id int")
    truck = spark.createDataFrame([(7, 70)], "truck_id int, franchise_id int")
    menu = spark.createDataFrame([(100, "a"), (101, "b"), (102, "c")], "menu_item_id int, name string")
    fr = spark.createDataFrame([(70, "F")], "franchise_id int, fname string")
    return {"order_detail": od, "order_header": oh, "truck": truck, "menu": menu, "franchise": fr}


def test_using_chain_puts_latest_key_first(pos):
    steps = [Join("order_header", "order_id", how="left"), Join("truck", "truck_id", how="left"),
             Join("menu", "menu_item_id", how="left"), Join("franchise", "franchise_id", how="left")]
    out = join_chain(pos, "order_detail", steps)
    assert out.columns[:4] == ["franchise_id", "menu_item_id", "truck_id", "order_id"]
    assert len(set(c.lower() for c in out.columns)) == len(out.columns)


def test_left_chain_keeps_misses_inner_drops_them(pos):
    # H7: order 11 has truck 8, which is unknown.
    left = [Join("order_header", "order_id", how="left"), Join("truck", "truck_id", how="left")]
    inner = [Join("order_header", "order_id"), Join("truck", "truck_id")]
    assert join_chain(pos, "order_detail", left).count() == 3
    assert join_chain(pos, "order_detail", inner).count() == 2


def test_duplicate_dimension_key_fans_out(spark, pos):
    # H14: no uniqueness check; a duplicated menu item multiplies its lines.
    t = dict(pos)
    t["menu"] = pos["menu"].unionByName(spark.createDataFrame([(100, "a2")], "menu_item_id int, name string"))
    assert join_chain(t, "order_detail", [Join("menu", "menu_item_id")]).count() == 4


def test_on_join_keeps_both_keys(spark):
    fact = spark.createDataFrame([(1, 20240101)], "id int, ShipDateKey int")
    dates = spark.createDataFrame([(20240101, 2024)], "DateKey int, year int")
    out = join_chain({"f": fact, "d": dates}, "f", [Join("d", "ShipDateKey", "DateKey")])
    assert out.columns == ["id", "ShipDateKey", "DateKey", "year"]


def test_float_key_joined_as_exact_integer(spark):
    # H2: 16777217 is not representable as float; compared as doubles the
    # float 16777216.0 must not match 16777217, and as bigint it must match
    # exactly 16777216.
    oh = spark.createDataFrame([(1, 16777216.0)], "order_id int, location_id float")
    loc = spark.createDataFrame([(16777216, "a"), (16777217, "b")], "location_id int, name string")
    out = join_chain({"oh": oh, "l": loc}, "oh", [Join("l", "location_id", key_type="bigint")])
    assert [r["name"] for r in out.collect()] == ["a"]


def test_missing_table_stops_before_join(pos):
    # J8 / H10: a required table that failed to load is reported by name.
    with pytest.raises(MissingTablesError) as err:
        join_chain(pos, "order_detail", [Join("customer_loyalty", "customer_id", how="left")])
    assert err.value.missing == ["customer_loyalty"]


def test_bounded_broadcast_respects_bound(spark):
    big = spark.range(50).withColumnRenamed("id", "k")
    fact = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = fact.join(bounded_broadcast(big, 100), "k")
        unhinted = fact.join(bounded_broadcast(big, 10), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        assert "BroadcastHashJoin" not in _plan(unhinted)
        assert hinted.count() == unhinted.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_float_key_matches_equal_integers_only(spark):
    from quayside.operators.joins import Join, join_chain

    left = spark.createDataFrame(
        [(1, 1.0), (2, 1.7), (3, float("nan")), (4, None), (5, 3e38), (6, float("inf"))],
        "row int, k double")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    out = join_chain({"l": left, "r": right}, "l", [Join("r", "k", how="left", key_type="bigint")])
    assert {r["row"]: r["name"] for r in out.collect()} == {
        1: "a", 2: None, 3: None, 4: None, 5: None, 6: None}
