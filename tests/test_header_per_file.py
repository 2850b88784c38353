"""Files with and without a header line in one folder."""

import gzip

import pytest

from quayside.sources.catalog import load_catalog
from quayside.sources.csv import read_csv
from quayside.sources.rejects import read_with_rejects
from quayside.specs import TableSpec

TYPED = "id int, name string, day date"
TEXT = "id string, name string, day string"
FILES = {
    "with.csv": "id,name,day\n1,a,2024-01-01\n2,b,2024-01-02\n",
    "without.csv": "3,c,2024-01-03\n4,d,2024-01-04\n",
    "quoted.csv": '"ID"," Name ","day"\n5,e,2024-01-05\n',
    "mark.csv": "\ufeffid,name,day\n6,f,2024-01-06\n",
    "only.csv": "id,name,day\n",
    "none.csv": "",
    "alike.csv": "7,name,\nid,g,day\n",
}


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "t").mkdir()
    for name, text in FILES.items():
        (tmp_path / "t" / name).write_text(text)
    with gzip.open(tmp_path / "t" / "packed.csv.gz", "wt") as f:
        f.write("id,name,day\n8,h,2024-01-08\n")
    return str(tmp_path / "t")


@pytest.mark.parametrize("schema", [TYPED, TEXT])
def test_every_row_and_no_header(spark, folder, schema):
    rows = read_csv(spark, folder, schema, "auto").collect()
    assert sorted(str(r["id"]) for r in rows if r["id"] not in (None, "id")) == list("12345678")
    assert len(rows) == 9  # the line "id,g,day" is a row
    assert {r["name"] for r in rows} == {*"abcdefgh", "name"}
    names = read_csv(spark, folder, schema, "auto").select("name").collect()  # pruned columns
    assert len(names) == 9 and read_csv(spark, folder, schema, "auto").count() == 9


def test_rejects_do_not_hold_headers(spark, folder):
    rows = read_with_rejects(spark, folder, TYPED, "auto").collect()
    assert len(rows) == 9
    assert [r["rejected"]["line"] for r in rows if r["rejected"]] == ["id,g,day"]


def test_a_catalog_table(spark, folder, tmp_path):
    spec = TableSpec(name="t", folder="t", schema=TYPED, header="auto")
    assert load_catalog(spark, {"t": spec}, str(tmp_path)).tables["t"].count() == 9
