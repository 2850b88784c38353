import uuid

from pyspark.sql import functions as F

from quayside.operators.columns import complete_columns, select_list, with_date_first
from quayside.operators.profile import catalog_null_profile, null_counts, null_profile


def _jobs(spark, fn):
    group = uuid.uuid4().hex
    sc = spark.sparkContext
    sc.setJobGroup(group, "count jobs")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _wide(spark, ncols):
    df = spark.range(100)
    for i in range(ncols):
        df = df.withColumn(f"c{i}", F.when(F.col("id") % (i + 2) == 0, None).otherwise(F.col("id")))
    return df


def test_null_counts_values(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert null_counts(df) == {"a": 1, "b": 2}


def test_profile_jobs_do_not_grow_with_columns(spark):
    narrow = _jobs(spark, lambda: null_counts(_wide(spark, 2)))
    wide = _jobs(spark, lambda: null_counts(_wide(spark, 30)))
    assert wide == narrow


def test_null_profile_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rows = {r["column_name"]: (r["null_count"], r["row_count"]) for r in null_profile(df).collect()}
    assert rows == {"a": (1, 3), "b": (2, 3)}


def test_catalog_profile_has_table_names(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(None,)], "y int")
    rows = sorted(tuple(r) for r in catalog_null_profile({"a": a, "b": b}).collect())
    assert rows == [("a", "x", 0, 1), ("b", "y", 1, 1)]


def test_complete_columns_drops_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "k int, v int, s string")
    assert complete_columns(df).columns == ["k", "s"]


def test_complete_columns_keep_protects_keys(spark):
    # H3: a key with a null would vanish and break the later USING join.
    df = spark.createDataFrame([(None, 1), (2, 2)], "franchise_id int, v int")
    assert complete_columns(df, keep=["FRANCHISE_ID"]).columns == ["franchise_id", "v"]


def test_complete_columns_empty_table_keeps_all(spark):
    # H4: no rows -> every null count is zero.
    df = spark.createDataFrame([], "a int, b string")
    assert complete_columns(df).columns == ["a", "b"]


def test_select_list_aliases(spark):
    a = spark.createDataFrame([(1, "x")], "id int, first_name string").alias("f")
    out = select_list(a, ["f.id", ("f.first_name", "franchisee_first_name")])
    assert out.columns == ["id", "franchisee_first_name"]


def test_date_first(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-05-01 13:00:00' AS order_ts, 1 AS x")
    out = with_date_first(df, "order_ts")
    assert out.columns == ["date", "order_ts", "x"]
    assert str(out.first()["date"]) == "2024-05-01"
