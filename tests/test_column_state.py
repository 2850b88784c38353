"""Types and null counts kept up by load batches, against one pass over all rows."""

import itertools
import os

import pytest

from quayside.functions.types import infer_types
from quayside.operators.profile import null_profile
from quayside.streaming.column_state import ColumnState
from quayside.streaming.recorded_load import (
    RecordedLoad, read_recorded, reload_changed_files, run_recorded_load,
)
from quayside.streaming.stage_load import StageLoad

COLUMNS = ("a", "b", "c")
FILES = {
    "small.csv": ["1,2001-01-01,x", "2,2001-01-02,"],
    "big.csv": ["99999999999,2001-01-01 05:00,true"],
    "real.csv": ["1.5,,false", ",,"],
    "text.csv": ["007,2001-01-01,true"],
}


@pytest.fixture()
def make(tmp):
    def build(name):
        os.makedirs(f"{tmp}/{name}/stage")
        load = RecordedLoad(
            StageLoad(f"{tmp}/{name}/stage", "a string, b string, c string", f"{tmp}/{name}/rows",
                      f"{tmp}/{name}/checkpoint", header=False), f"{tmp}/{name}/history")
        return load, ColumnState(f"{tmp}/{name}/columns", load, COLUMNS)
    return build


def put(load, name, lines):
    with open(f"{load.stage.source}/{name}", "w") as f:
        f.writelines(line + "\n" for line in lines)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def same_as_one_pass(spark, load, state):
    whole = read_recorded(spark, load).select(*COLUMNS)
    assert rows(state.types(spark), "column_name", "inferred_type") == rows(
        infer_types(whole), "column_name", "inferred_type")
    found = rows(state.profile(spark), "column_name", "null_count", "row_count")
    assert found == rows(null_profile(whole), "column_name", "null_count", "row_count")
    assert state.complete_columns(spark) == [c for c, n, _ in found if not n]


@pytest.mark.parametrize("order", [list(p) for p in itertools.permutations(FILES)][::7])
def test_any_order_of_drops(spark, make, order):
    load, state = make("x")
    for name in order:
        put(load, name, FILES[name])
        run_recorded_load(spark, load, state.on_batch)
        same_as_one_pass(spark, load, state)
    assert dict(rows(state.types(spark), "column_name", "inferred_type")) == {
        "a": "string", "b": "timestamp_ntz", "c": "string"}


def test_reloads_typed_rows_and_changes(spark, make):
    load, state = make("y")
    assert state.types(spark).count() == 0 and state.complete_columns(spark) == []
    for name in ("small.csv", "real.csv", "text.csv"):
        put(load, name, FILES[name])
        run_recorded_load(spark, load, state.on_batch)
    changes = [tuple(r) for r in state.changes(spark).orderBy("sequence", "column_name").collect()]
    assert changes == [
        (1, "a", None, "int", None, True), (1, "b", None, "date", None, True),
        (1, "c", None, "string", None, False),
        (2, "a", "int", "double", True, False), (2, "b", "date", "date", True, False),
        (3, "a", "double", "string", False, False)]
    put(load, "text.csv", ["8,2002-01-01,z"])  # the code with zeros is gone again
    reload_changed_files(spark, load, state.on_batch)
    same_as_one_pass(spark, load, state)
    typed = state.typed(read_recorded(spark, load))
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["double", "date", "string"]
    assert sorted(r[0] for r in typed.collect() if r[0]) == [1.0, 1.5, 2.0, 8.0]
