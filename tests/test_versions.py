"""Replacing tables: failures, new definitions, lost drivers, versions kept."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.sinks import versions as V
from quayside.sinks.tables import save_catalog


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def folders(root):
    return sorted(f for f in os.listdir(root) if f.startswith("v"))


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("bad row")).cast("long"))
                         .otherwise(F.col("id")))


@pytest.mark.parametrize("change", ["same", "column", "buckets"])
def test_a_failing_write_leaves_the_old_table(spark, tmp, change):
    table, root = f"kept_{change}", f"{tmp}/{change}"
    V.replace_table(spark.range(5), table, root, bucket_key="id", buckets=2)
    before = V.definition(spark, table)
    new = failing(spark.range(10))
    options = dict(bucket_key="id", buckets=2 if change != "buckets" else 4)
    with pytest.raises(Exception, match="bad row"):
        V.replace_table(new.withColumn("x", F.lit(1)) if change == "column" else new, table, root,
                        **options)
    assert rows(spark, table) == [(i,) for i in range(5)]
    assert V.definition(spark, table) == before and len(folders(root)) == 1
    V.replace_table(spark.range(3).withColumn("x", F.lit(1)), table, root, **options)
    assert rows(spark, table) == [(i, 1) for i in range(3)]


def test_versions_are_kept_and_restored(spark, tmp):
    for n in range(1, 6):
        V.replace_table(spark.range(n), "many", f"{tmp}/many", keep=3)
    assert [rows(spark, "many")[-1][0], len(folders(f"{tmp}/many"))] == [4, 3]
    assert len(V.versions(spark, "many")) == 3
    V.restore_table(spark, "many", back=2)
    assert len(rows(spark, "many")) == 3
    V.restore_table(spark, "many")  # what was present before
    assert len(rows(spark, "many")) == 5
    with pytest.raises(ValueError):
        V.restore_table(spark, "many", back=3)
    V.replace_table(spark.range(9), "many", f"{tmp}/many", keep=3)
    assert folders(f"{tmp}/many")[-1].startswith("v000006") and len(folders(f"{tmp}/many")) == 3


def test_restore_of_another_definition_and_buckets(spark, tmp):
    V.replace_table(spark.range(4), "both", f"{tmp}/b", bucket_key="id", buckets=2)
    V.replace_table(spark.sql("SELECT 'a' AS s"), "both", f"{tmp}/b")
    V.restore_table(spark, "both")
    assert rows(spark, "both") == [(i,) for i in range(4)]
    assert ("Num Buckets", "2") in V.definition(spark, "both")


def test_a_plan_may_write_the_table_that_it_reads(spark, tmp):
    V.replace_table(spark.range(4), "own", f"{tmp}/own")
    before = spark.table("own")
    V.replace_table(before.filter("id > 1"), "own", f"{tmp}/own")
    assert rows(spark, "own") == [(2,), (3,)]
    assert before.count() == 4  # the plan's version is still there


@pytest.mark.parametrize("lost_at", ["written", "renamed", "swapped"])
def test_a_lost_driver(spark, tmp, lost_at):
    table = f"lost_{lost_at}"
    V.replace_table(spark.range(4), table, f"{tmp}/{lost_at}")
    spark.range(6).write.option("path", f"{tmp}/{lost_at}/v000002_0").saveAsTable(f"{table}__next")
    if lost_at != "written":
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__previous")
    if lost_at == "swapped":
        spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
    V.finish_replacement(spark, table)
    assert len(rows(spark, table)) == (6 if lost_at == "swapped" else 4)
    V.replace_table(spark.range(2), table, f"{tmp}/{lost_at}")
    assert len(rows(spark, table)) == 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}__")]


def test_a_table_that_was_not_versioned_is_taken_over(spark, tmp):
    spark.range(3).write.option("path", f"{tmp}/plain").saveAsTable("plain")
    spark.range(3).write.mode("overwrite").saveAsTable("owned")
    for table in ("plain", "owned"):
        V.replace_table(spark.range(8), table)
        assert len(rows(spark, table)) == 8
    assert spark.read.parquet(f"{tmp}/plain").count() == 3
    assert V.versions(spark, "owned")[0].path.startswith(V.version_root(spark, "owned"))


def test_paths_with_quotes_and_names_of_a_database(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS versioned LOCATION '{tmp}/db'")
    for n in (2, 3):
        V.replace_table(spark.range(n), "versioned.t", f"{tmp}/it's")
    assert len(rows(spark, "versioned.t")) == 3


def test_save_catalog_keeps_a_table_that_fails(spark, tmp):
    targets = {"good": "cat_good", "bad": "cat_bad"}
    paths = {n: f"{tmp}/{n}" for n in targets}
    save_catalog({n: spark.range(5) for n in targets}, targets, paths)
    report = save_catalog({"good": spark.range(9), "bad": failing(spark.range(9))}, targets, paths,
                          observe_nulls=True)
    assert list(report.saved) == ["good"] and "bad row" in report.failed["bad"]
    assert (len(rows(spark, "cat_good")), len(rows(spark, "cat_bad"))) == (9, 5)
    assert report.null_counts == {"good": {"id": 0}}
