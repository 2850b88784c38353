"""Lines that a typed scan cannot take: reasons, counts, and the load left as it is."""

import pytest

from quayside.sources.csv import read_csv
from quayside.sources.rejects import (
    load_catalog_with_rejects, load_with_rejects, read_with_rejects, reject_counts,
)
from quayside.specs import TableSpec

SCHEMA = "id int, price double, day date, note string"
LINES = [
    ("1,2.5,2024-01-02,fine", None),
    ("2,x,2024-01-02,bad price", ["bad price"]),
    ("3,2.5,2024-13-45,bad day", ["bad day"]),
    ("x,y,z,all bad", ["bad id", "bad price", "bad day"]),
    ("4,2.5", ["short"]),
    ("5,n/a", ["short", "bad price"]),
    ("6,2.5,2024-01-02,long,more,and more", ["long"]),
    ("7,,,", None),
    ('8,1,2024-01-02,"quoted, with comma"', None),
    ('9,1,2024-01-02,"quoted, with ""quotes"" , and comma",more', ["long"]),
    ('10,bad,2024-01-02,"a, b"', ["bad price"]),
    ("11,1e400,2024-01-02,infinite", None),
    ('12,"",2024-01-02,empty', None),
    ("13,1,2024-01-02,ünïcode,", ["long"]),
    ("99999999999,1,2024-01-02,too large", ["bad id"]),
]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.csv").write_text(
            "id,price,day,note\n" + "".join(line + "\n" for line, _ in LINES[k::2]))
    return str(tmp_path / "in")


def by_line(rows):
    return sorted((r["line"], r["reasons"]) for r in rows)


def test_reasons_and_the_same_rows(spark, folder):
    rows = read_with_rejects(spark, folder, SCHEMA)
    found = by_line(r["rejected"] for r in rows.collect() if r["rejected"])
    assert found == sorted((line, why) for line, why in LINES if why)
    plain = read_csv(spark, folder, SCHEMA).collect()
    assert sorted(map(str, plain)) == sorted(map(str, rows.drop("rejected").collect()))


def test_load_counts_and_tables(spark, folder, tmp):
    load = load_with_rejects(spark, folder, SCHEMA, f"{tmp}/out")
    assert (load.rows, load.rejected) == (len(LINES), sum(bool(w) for _, w in LINES))
    assert load.reasons == {"short": 2, "long": 3, "bad id": 2, "bad price": 4, "bad day": 2}
    assert load.table(spark).columns == ["id", "price", "day", "note"]
    assert load.table(spark).count() == len(LINES)
    assert by_line(load.rejects(spark).collect()) == sorted((x, w) for x, w in LINES if w)
    plan = load.rejects(spark)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<rejected" in plan and "price" not in plan.split("ReadSchema")[1]


def test_other_separators_and_escapes(spark, tmp_path):
    lines = ['1;2.5;2024-01-02;"a; \\"b; c"', '2;2.5;2024-01-02;"a\\\\";more', "3;2.5;2024-01-02"]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    rows = read_with_rejects(spark, str(tmp_path), SCHEMA, header=False,
                             options={"sep": ";", "escape": "\\"}).collect()
    assert by_line(r["rejected"] for r in rows if r["rejected"]) == [
        (lines[1], ["long"]), (lines[2], ["short"])]


def test_an_empty_folder_and_a_catalog(spark, folder, tmp, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("id,price,day,note\n")
    specs = {name: TableSpec(name=name, folder=name, schema=SCHEMA)
             for name in ("in", "none", "missing")}
    loads = load_catalog_with_rejects(spark, specs, tmp, f"{tmp}/loaded")
    assert isinstance(loads.pop("missing"), Exception)
    assert (loads["none"].rows, loads["none"].rejected, loads["none"].reasons) == (0, 0, {})
    counts = {(r["table_name"], r["reason"]): r["row_count"]
              for r in reject_counts(spark, loads).collect()}
    assert counts[("in", "rejected")] == 10 and counts[("none", "rows")] == 0
