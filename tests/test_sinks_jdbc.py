"""Sinks.  JDBC targets are exercised without a database: no server or
embedded database is started in the tests, so the JDBC calls are checked
through the options they hand to Spark's writer and reader."""

import pytest

from quayside.sinks import tables as sinks
from quayside.sources import jdbc


class _FakeWriter:
    def __init__(self, log, fail_on_truncate):
        self.log, self.fail, self.opts = log, fail_on_truncate, {}

    def format(self, fmt):
        self.opts["format"] = fmt
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def mode(self, m):
        self.opts["mode"] = m
        return self

    def save(self):
        self.log.append(dict(self.opts))
        if self.fail and self.opts.get("truncate") == "true":
            raise RuntimeError("column mismatch")


class _FakeReader:
    def __init__(self, columns):
        self.columns = columns

    def format(self, fmt):
        return self

    def options(self, **kw):
        return self

    def load(self):
        return self


class _FakeFrame:
    columns = ["id", "v"]

    def __init__(self, fail_on_truncate=False, target=("ID", "V")):
        self.log = []
        self.fail = fail_on_truncate
        self.sparkSession = type("Session", (), {"read": _FakeReader(list(target))})

    @property
    def write(self):
        return _FakeWriter(self.log, self.fail)


def test_truncate_load_options():
    df = _FakeFrame()
    assert sinks.jdbc_truncate_load(df, "jdbc:x://h/db", "AdventureWorks", {"user": "u"}) == "truncate"
    (opts,) = df.log
    assert opts["truncate"] == "true" and opts["cascadeTruncate"] == "true"
    assert opts["mode"] == "overwrite" and opts["dbtable"] == "AdventureWorks" and opts["user"] == "u"


def test_truncate_load_falls_back_to_recreate():
    # H11: a target whose columns no longer fit is dropped and recreated.
    df = _FakeFrame(fail_on_truncate=True, target=("id", "v", "old"))
    assert sinks.jdbc_truncate_load(df, "jdbc:x://h/db", "t") == "recreate"
    assert [o.get("truncate") for o in df.log] == [None]


def test_truncate_load_keeps_the_target_when_the_write_fails():
    # A lost connection or a bad row is no reason to drop a target that fits.
    df = _FakeFrame(fail_on_truncate=True)
    with pytest.raises(RuntimeError):
        sinks.jdbc_truncate_load(df, "jdbc:x://h/db", "t")
    assert [o.get("truncate") for o in df.log] == ["true"]


def test_jdbc_overwrite_reraises():
    class Boom(_FakeFrame):
        @property
        def write(self):
            w = _FakeWriter(self.log, False)
            w.save = lambda: (_ for _ in ()).throw(RuntimeError("down"))
            return w

    with pytest.raises(RuntimeError):
        sinks.jdbc_overwrite(Boom(), "jdbc:x://h/db", "joined_data")


def test_clean_query_strips_semicolon():
    assert jdbc.clean_query("SELECT 1 ;\n") == "SELECT 1"


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc.read_jdbc_table(spark, "jdbc:x://h/db", "t", partition_column="id")


def test_options_merge():
    opts = jdbc.jdbc_options("jdbc:x://h/db", {"user": "u"}, dbtable="t", fetchsize=10, numPartitions=None)
    assert opts == {"url": "jdbc:x://h/db", "user": "u", "dbtable": "t", "fetchsize": "10"}


def test_overwrite_table_replaces_content_and_schema(spark, tmp):
    sinks.overwrite_table(spark.range(5), "ow_t", f"{tmp}/ow")
    sinks.overwrite_table(spark.sql("SELECT 'a' AS s"), "ow_t", f"{tmp}/ow")
    assert [tuple(r) for r in spark.table("ow_t").collect()] == [("a",)]


def test_bucketed_tables_join_without_exchange(spark, tmp):
    a = spark.range(1000).selectExpr("id AS order_id", "id % 7 AS v")
    b = spark.range(1000).selectExpr("id AS order_id", "id % 5 AS w")
    sinks.overwrite_table(a, "bk_a", f"{tmp}/a", bucket_key="order_id", buckets=4)
    sinks.overwrite_table(b, "bk_b", f"{tmp}/b", bucket_key="order_id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bk_a").join(spark.table("bk_b"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_save_catalog_isolates_failures(spark, tmp):
    good = spark.range(3)
    bad = spark.sql("SELECT CAST('x' AS INT) AS broken")  # fails only when written
    report = sinks.save_catalog(
        {"good": good, "bad": bad},
        target_of={"good": "sc_good", "bad": "sc_bad"},
        path_of={"good": f"{tmp}/g", "bad": f"{tmp}/b"},
    )
    assert set(report.saved) == {"good"} and set(report.failed) == {"bad"}
    assert report.status(spark).count() == 2


def test_bucketed_write_splits_a_hot_key(spark, tmp):
    """A key holding a third of the rows is written by several tasks (several
    files in its bucket), and the bucketed table still reads back whole."""
    import glob

    from pyspark.sql import functions as F

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
        (F.col("id") * 31 % 1000).alias("v"),
    )
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sinks.overwrite_table(rows, "bk_hot", f"{tmp}/hot", bucket_key="order_id", buckets=4)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    hot_bucket = spark.range(1).select(F.expr("pmod(hash(CAST(7 AS BIGINT)), 4)")).first()[0]
    files = glob.glob(f"{tmp}/hot/*/*_{hot_bucket:05d}.c000*.parquet")
    assert len(files) > 1, (hot_bucket, sorted(glob.glob(f"{tmp}/hot/*/*")))
    assert spark.table("bk_hot").count() == 60_000
    assert spark.table("bk_hot").filter("order_id = 7").count() == 20_001  # every third id, and id 7
