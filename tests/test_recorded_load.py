"""Recorded stage loads and the member state that they keep up to date."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from quayside.operators.aggregates import member_metrics
from quayside.streaming.member_state import MemberState
from quayside.streaming.recorded_load import (
    BATCH, FILE, RecordedLoad, changed_files, load_history, read_recorded, record_batch,
    reload_changed_files, run_recorded_load,
)
from quayside.streaming.stage_load import StageLoad

SCHEMA = "order_id int, member int, amount double, place string"


@pytest.fixture()
def load(tmp):
    os.makedirs(f"{tmp}/stage")
    return RecordedLoad(StageLoad(f"{tmp}/stage", SCHEMA, f"{tmp}/rows", f"{tmp}/checkpoint",
                                  header=False), f"{tmp}/history")


@pytest.fixture()
def state(load, tmp):
    return MemberState(f"{tmp}/state", load, "member", "amount", "place")


def put(load, name, rows):
    with open(f"{load.stage.source}/{name}", "w") as f:
        f.writelines(",".join("" if v is None else str(v) for v in r) + "\n" for r in rows)


def read(spark, load):
    return sorted((tuple(r) for r in read_recorded(spark, load).drop(
        FILE, "file_modified", "file_bytes", BATCH).collect()), key=str)


def history(spark, load):
    return sorted((os.path.basename(r[FILE]), r["row_count"], r["superseded"])
                  for r in load_history(spark, load).collect())


A = [(1, 10, 1.5, "x"), (2, 10, 2.25, "y"), (3, 11, 4.0, "x")]
B = [(4, 10, 1.0, "x"), (5, 12, None, None), (6, None, 9.0, "z")]
C = [(7, 11, 0.5, "q")]


def test_history_and_rows(spark, load):
    assert load_history(spark, load).count() == 0 and read(spark, load) == []
    put(load, "a.csv", A)
    run_recorded_load(spark, load)
    put(load, "b.csv", B)
    put(load, "c.csv", C)
    run_recorded_load(spark, load)
    run_recorded_load(spark, load)
    assert history(spark, load) == [("a.csv", 3, False), ("b.csv", 3, False), ("c.csv", 1, False)]
    assert read(spark, load) == sorted(A + B + C, key=str)
    rows = load_history(spark, load).collect()
    assert len({r[BATCH] for r in rows}) == 2 and all(r["loaded_at"] for r in rows)
    assert all(r["file_bytes"] == os.path.getsize(r[FILE].removeprefix("file:")) for r in rows)


def test_a_batch_that_runs_again_replaces_itself(spark, load, tmp):
    put(load, "a.csv", A)
    run_recorded_load(spark, load)
    put(load, "b.csv", B)
    run_recorded_load(spark, load)
    # The driver is lost after the rows and the history, before the stream commits.
    os.remove(f"{load.stage.checkpoint}/commits/1")
    crc = f"{load.stage.checkpoint}/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run_recorded_load(spark, load)
    assert read(spark, load) == sorted(A + B, key=str)
    assert history(spark, load) == [("a.csv", 3, False), ("b.csv", 3, False)]


def test_rows_without_a_history_are_not_read(spark, load):
    put(load, "a.csv", A)

    def lost(rows, old, batch):
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run_recorded_load(spark, load, lost)
    assert spark.read.parquet(load.target).count() == 3 and read(spark, load) == []
    run_recorded_load(spark, load)
    assert read(spark, load) == sorted(A, key=str)


def test_changed_files_are_loaded_again(spark, load):
    put(load, "a.csv", A)
    put(load, "b.csv", B)
    run_recorded_load(spark, load)
    assert reload_changed_files(spark, load) == [] and changed_files(spark, load).count() == 0
    put(load, "a.csv", A[:1] + C)
    put(load, "new.csv", C)  # not loaded yet: the next run's
    assert [os.path.basename(f) for f in reload_changed_files(spark, load)] == ["a.csv"]
    assert reload_changed_files(spark, load) == []
    assert read(spark, load) == sorted(A[:1] + C + B, key=str)
    run_recorded_load(spark, load)
    assert read(spark, load) == sorted(A[:1] + C + B + C, key=str)
    put(load, "a.csv", A)
    reload_changed_files(spark, load)
    assert history(spark, load) == [("a.csv", 2, True), ("a.csv", 3, False), ("a.csv", 3, True),
                                    ("b.csv", 3, False), ("new.csv", 1, False)]


MEMBERS = [(10, "ann"), (11, "bob"), (11, "bob"), (12, "cy"), (13, "di"), (None, "no one")]


def metrics(spark, state, load):
    """The kept-up metrics, and those over all rows loaded so far."""
    members = spark.createDataFrame(MEMBERS, "id int, name string")
    kept = state.metrics(members, "id", ["id", "name"])
    whole = member_metrics(members, read_recorded(spark, load), member_key="id",
                           order_member_key="member", group_cols=["id", "name"],
                           amount_col="amount", set_col="place")
    return [sorted((tuple(r) for r in df.collect()), key=str) for df in (kept, whole)]


@pytest.mark.parametrize("compacted", [False, True])
def test_kept_up_metrics(spark, load, state, compacted):
    for name, rows in (("a.csv", A), ("b.csv", B), ("c.csv", C * 5)):
        put(load, name, rows)
        run_recorded_load(spark, load, state.on_batch)
        if compacted:
            state.compact(spark)
        kept, whole = metrics(spark, state, load)
        assert kept == whole and kept
    put(load, "a.csv", A[2:])  # member 10 loses two orders and a place
    reload_changed_files(spark, load, state.on_batch)
    if compacted:
        state.compact(spark)
    kept, whole = metrics(spark, state, load)
    assert kept == whole
    put(load, "b.csv", [(9, 99, 1.0, "x")])  # and all of its orders
    reload_changed_files(spark, load, state.on_batch)
    kept, whole = metrics(spark, state, load)
    assert kept == whole and [k[0] for k in kept] == [11]


def test_old_orders_are_not_read_again(spark, load, state):
    put(load, "a.csv", A)
    run_recorded_load(spark, load, state.on_batch)
    put(load, "b.csv", B)
    shutil.move(f"{load.target}/{BATCH}=s000000000", f"{load.target}_moved")
    run_recorded_load(spark, load, state.on_batch)
    state.compact(spark)
    shutil.move(f"{load.target}_moved", f"{load.target}/{BATCH}=s000000000")
    kept, whole = metrics(spark, state, load)
    assert kept == whole


def test_a_snapshot_that_was_not_finished_does_not_count(spark, load, state):
    put(load, "a.csv", A)
    run_recorded_load(spark, load, state.on_batch)
    state.compact(spark)
    put(load, "b.csv", B)
    run_recorded_load(spark, load, state.on_batch)
    number = state.compact(spark)
    shutil.rmtree(f"{state.path}/listed/number={number}")
    kept, whole = metrics(spark, state, load)
    assert kept == whole
    assert state.compact(spark) == number
    kept, whole = metrics(spark, state, load)
    assert kept == whole


def test_parts_of_a_batch_that_was_not_committed(spark, load, state, monkeypatch):
    put(load, "a.csv", A)
    run_recorded_load(spark, load, state.on_batch)
    put(load, "b.csv", B)

    def lost(rows, old, batch):
        state.on_batch(rows, old, batch)
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run_recorded_load(spark, load, lost)
    for _ in range(2):
        kept, whole = metrics(spark, state, load)
        assert kept == whole
        state.compact(spark)
        run_recorded_load(spark, load, state.on_batch)
    assert [k[0] for k in kept] == [10, 11, 12]


def test_nothing_loaded_yet(spark, load, state):
    kept, whole = metrics(spark, state, load)
    assert kept == whole == []
