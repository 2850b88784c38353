"""Bounds of join outputs against the exact numbers, with duplicate keys on both sides."""

import random

import pytest

from quayside.operators.fanout import FanOutError, chain_bounds, check_fan_out, join_bound
from quayside.operators.joins import Join, join_chain


@pytest.fixture()
def rnd():
    return random.Random(5)


def keys(spark, values, kind="long"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, x int")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("buckets", [4, 1 << 10])
def test_the_bound_holds(spark, rnd, how, buckets):
    for _ in range(3):
        left = [rnd.choice([None, 1, 1, 1, rnd.randint(0, 60)]) for _ in range(300)]
        right = [rnd.choice([None, 1, rnd.randint(0, 90)]) for _ in range(200)]
        a, b = keys(spark, left), keys(spark, right)
        exact = a.join(b, "k", how).count()
        bound = join_bound(a, b, "k", "k", how, buckets)
        assert exact <= bound.rows
        assert (bound.left_rows, bound.right_rows) == (300, 200)
        assert bound.multiplicity == max(right.count(v) for v in right if v is not None)
        if buckets > 1000:
            assert bound.rows <= exact * 1.2 + (300 if how == "left" else 0)


def test_unique_keys_and_empty_sides(spark):
    a, b, none = keys(spark, range(100)), keys(spark, range(50, 150)), keys(spark, [])
    assert join_bound(a, b, "k", "k").rows in range(50, 101)
    assert join_bound(a, none, "k", "k").rows == 0 and join_bound(none, a, "k", "k").rows == 0
    assert join_bound(a, none, "k", "k", "left").rows == 100
    with pytest.raises(ValueError):
        join_bound(a, b, "k", "k", "full")


def test_guard(spark):
    a = keys(spark, [1] * 20)
    bound = join_bound(a, keys(spark, [1] * 30), "k", "k")
    assert bound.rows == 600
    assert check_fan_out(bound, 30) is bound
    with pytest.raises(FanOutError, match="600 rows of 20"):
        check_fan_out(bound, 2)


def test_chain(spark):
    tables = {
        "lines": spark.range(60).selectExpr("id AS line", "id % 6 AS a", "id % 4 AS b"),
        "a": spark.createDataFrame([(0, 9), (0, 8), (1, 9)], "a long, c long"),
        "b": spark.createDataFrame([(0,), (1,), (1,), (1,)], "b long"),
        "c": spark.createDataFrame([(9.0,), (9.0,), (8.5,)], "c double"),
    }
    steps = [Join("a", "a"), Join("b", "b"), Join("c", "c", key_type="bigint")]
    bounds = chain_bounds(tables, "lines", steps)
    for n, (_, bound, rows) in enumerate(bounds, 1):
        assert join_chain(tables, "lines", steps[:n]).count() <= rows
    assert [b.multiplicity for _, b, _ in bounds] == [2, 3, 2]
    assert [r for *_, r in bounds] == [30, 90, 180]
    left = [Join(s.table, s.left, how="left", key_type=s.key_type) for s in steps]
    for n, (_, _, rows) in enumerate(chain_bounds(tables, "lines", left), 1):
        assert join_chain(tables, "lines", left[:n]).count() <= rows
    with pytest.raises(FanOutError, match="lines to b"):
        chain_bounds(tables, "lines", [Join("b", "b")], most=0.9)
