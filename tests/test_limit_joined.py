"""The row cap over a joined query reads a bounded part of the fact."""

import pytest

from quayside.operators.limits import limit_joined


@pytest.fixture()
def fact(spark, tmp):
    spark.range(40_000).selectExpr("id", "id % 100 AS k", "uuid() AS wide").repartition(20, "id") \
        .write.parquet(f"{tmp}/fact")
    return spark.read.parquet(f"{tmp}/fact")


def joined_to(spark, keys):
    right = spark.createDataFrame([(k, f"name {k}") for k in keys], "k long, name string")
    return lambda part: part.join(right, "k")


@pytest.mark.parametrize("keys,n,attempts", [
    (range(100), 300, 1),      # keeps all: the first rows of one file
    (range(0, 100, 2), 500, 2),  # about half of 1,000 rows: a few may be missing
    (range(1), 300, 3),        # one row in a hundred: 400 rows, the whole fact is needed
    (range(1), 1000, 4),       # fewer rows than the cap
    ([], 10, 4),
])
def test_rows_and_attempts(spark, fact, tmp, keys, n, attempts):
    join = joined_to(spark, list(keys))
    capped = limit_joined(fact, join, n, f"{tmp}/out")
    whole = {r["id"] for r in join(fact).collect()}
    rows = capped.rows.collect()
    assert len(rows) == len({r["id"] for r in rows}) == min(n, len(whole))
    assert {r["id"] for r in rows} <= whole
    assert all(r["name"] == f"name {r['k']}" for r in rows)
    assert abs(len(capped.attempts) - attempts) <= 1
    assert capped.attempts[0][1] <= 2 * n
    read = sum(seen for _, seen in capped.attempts)
    if len(whole) == 40_000:
        assert read <= 2 * n
    assert read <= 40_000 * 1.4 + 2 * n


def test_rows_are_capped_once_and_empty_facts(spark, tmp):
    empty = spark.createDataFrame([], "id long, k long")
    empty.write.parquet(f"{tmp}/none")
    for fact in (spark.read.parquet(f"{tmp}/none"), empty):  # without files as well
        assert limit_joined(fact, joined_to(spark, [1]), 5, f"{tmp}/out").rows.count() == 0
    some = spark.range(50).selectExpr("id", "id % 10 AS k")
    assert limit_joined(some, joined_to(spark, [1, 2]), 7, f"{tmp}/out").rows.count() == 7


def test_the_scan_stops(spark, fact, tmp):
    """What the scan gives out, by Spark's own metrics: a bounded part of the fact."""
    capped = limit_joined(fact, joined_to(spark, range(100)), 20, f"{tmp}/out")
    assert capped.rows.count() == 20
    first = sorted(fact.inputFiles())[0]
    assert capped.attempts == ((1, 40),)
    assert spark.read.parquet(first).count() < 40_000 / 10


def test_a_fact_within_the_prefix_is_joined_once(spark, tmp):
    spark.range(50).selectExpr("id", "id % 10 AS k").coalesce(1).write.parquet(f"{tmp}/one")
    fact = spark.read.parquet(f"{tmp}/one")
    capped = limit_joined(fact, joined_to(spark, [1, 2]), 40, f"{tmp}/out")
    assert capped.rows.count() == 10
    assert capped.attempts == ((1, 50),)
