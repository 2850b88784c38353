"""Staged files of the load queries: bounded compressed files, drops of several files."""

import glob

from pyspark.sql import functions as F

from quayside.plans import load_queries as q
from quayside.session import local_dir_of
from quayside.sources.catalog import load_catalog
from quayside.streaming.recorded_load import read_recorded, reload_changed_files, run_recorded_load


def _parts(folder):
    return sorted(glob.glob(f"{local_dir_of(folder)}/part-*"))


def test_catalog_is_staged_in_small_compressed_files(spark, sf_small, monkeypatch):
    rows = spark.range(0, 25, 1, 1).select(
        "id", F.when(F.col("id") % 7 != 0, F.concat(F.lit('a "b", '), "id")).alias("name"))
    monkeypatch.setattr(q, "standin_tables", lambda *_: {n: rows for n in ("truck", "menu")})
    monkeypatch.setitem(q._PACKED, "maxRecordsPerFile", "10")
    root, specs = q._stage_catalog_files(spark, sf_small)
    loaded = load_catalog(spark, specs, root)
    assert "country" in loaded.failures
    for name in ("truck", "menu"):
        files = _parts(specs[name].path(root))
        assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
        assert sorted(loaded.tables[name].collect()) == sorted(rows.collect())


def test_every_file_of_a_drop_changes_in_place(spark):
    orders = spark.range(0, 40, 1, 4).select(
        F.col("id").alias("o_orderkey"), (F.col("id") + 100).alias("o_custkey"),
        F.lit("P").alias("o_orderstatus"), F.col("id").cast("double").alias("o_totalprice"))
    load = q._recorded(spark, orders, "several")
    q._arrive(orders, load, "P")
    folder = q._drop_folder(load, "P")
    run_recorded_load(spark, load)
    names = _parts(folder)
    assert len(names) == 4
    q._change_in_place(load, orders, "P")
    assert _parts(folder) == names
    assert len(reload_changed_files(spark, load)) == 4
    read = read_recorded(spark, load).select("o_orderkey", "o_custkey", "o_totalprice").collect()
    assert sorted(tuple(r) for r in read) == [
        (i, 1 if i % 3 == 0 else i + 100, 2.0 * i) for i in range(40)]
