"""Incremental load: two files, run, run again, add a third, run."""

import os

from quayside.streaming.stage_load import StageLoad, read_loaded, run_stage_load


def test_each_file_loaded_once(spark, tmp):
    src = f"{tmp}/stage"
    os.makedirs(src)
    for name, row in (("a", "1,x"), ("b", "2,y")):
        with open(f"{src}/{name}.csv", "w") as fh:
            fh.write(f"id,v\n{row}\n")
    load = StageLoad(source=src, schema="id int, v string", target=f"{tmp}/out",
                     checkpoint=f"{tmp}/ckpt")
    run_stage_load(spark, load)
    assert read_loaded(spark, load).count() == 2
    run_stage_load(spark, load)
    assert read_loaded(spark, load).count() == 2
    with open(f"{src}/c.csv", "w") as fh:
        fh.write("id,v\n3,z\n")
    run_stage_load(spark, load)
    assert sorted(r["id"] for r in read_loaded(spark, load).collect()) == [1, 2, 3]


def test_a_late_file_with_an_old_date_is_loaded(spark, tmp):
    src = f"{tmp}/stage"
    os.makedirs(src)
    load = StageLoad(source=src, schema="id int, v string", target=f"{tmp}/out",
                     checkpoint=f"{tmp}/ckpt")
    for i, name in enumerate("abc", 1):
        path = f"{src}/{name}.csv"
        with open(path, "w") as fh:
            fh.write(f"id,v\n{i},x\n")
        if name == "b":
            old = os.path.getmtime(path) - 30 * 86_400
            os.utime(path, (old, old))
        if name != "b":
            run_stage_load(spark, load)
    assert sorted(r["id"] for r in read_loaded(spark, load).collect()) == [1, 2, 3]
