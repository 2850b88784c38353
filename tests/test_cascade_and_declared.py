"""Truncate-and-load in cascade, and tables with declared types."""

import pytest
from pyspark.sql import functions as F

from quayside.plans.views import create_namespaces
from quayside.sinks import versions as V
from quayside.sinks.cascade import DependencyCycle, dependants, truncate_load
from quayside.sinks.tables import declared_columns, save_catalog
from quayside.specs import DECLARED_TYPES, ddl_columns, pos_catalog

REFERS = {"a": ["b", "c"], "b": ["d"], "c": ["d"], "x": ["y"]}


def test_order_of_dependants():
    assert dependants("d", REFERS) == [] and dependants("x", REFERS) == ["y"]
    order = dependants("a", REFERS)
    assert set(order) == {"b", "c", "d"} and order[0] == "d"
    with pytest.raises(DependencyCycle):
        dependants("a", {"a": ["b"], "b": ["c"], "c": ["a"]})


@pytest.fixture()
def tables(spark, tmp):
    names = {n: f"casc_{n}" for n in "abcdx"}
    for n, t in names.items():
        V.replace_rows(spark.range(5).withColumn("v", F.lit("old")), t, "id INT, v VARCHAR(4)",
                       f"{tmp}/{n}")
    return names


def refers(names):
    return {names.get(k, k): [names.get(c, c) for c in v] for k, v in REFERS.items()}


def counts(spark, names):
    return {n: spark.table(t).count() for n, t in names.items()}


def test_load_and_cascade(spark, tables):
    before = {n: V.definition(spark, t) for n, t in tables.items()}
    emptied = truncate_load(spark.sql("SELECT 'new' AS v, 7L AS ID"), tables["a"], refers(tables))
    assert set(emptied) == {tables[n] for n in "bcd"}
    assert counts(spark, tables) == {"a": 1, "b": 0, "c": 0, "d": 0, "x": 5}
    assert spark.table(tables["a"]).first() == (7, "new")
    assert {n: V.definition(spark, t) for n, t in tables.items()} == before
    truncate_load(spark.range(2), tables["a"])  # without v: null
    assert {tuple(r) for r in spark.table(tables["a"]).collect()} == {(0, None), (1, None)}
    V.restore_table(spark, tables["d"])  # the emptied rows are a version
    assert spark.table(tables["d"]).count() == 5


@pytest.mark.parametrize("rows,error", [
    ("SELECT 1 AS id, 'x' AS v, 2 AS w", "no column"),
    ("SELECT 1 AS id, 'too long' AS v", "EXCEED_LIMIT_LENGTH"),
    ("SELECT 99999999999 AS id, 'x' AS v", "OVERFLOW|out of range"),
    ("SELECT current_date() AS id, 'x' AS v", "INCOMPATIBLE|CANNOT"),
])
def test_what_does_not_fit_changes_nothing(spark, tables, rows, error):
    before = counts(spark, tables)
    with pytest.raises(Exception, match=error):
        truncate_load(spark.sql(rows), tables["a"], refers(tables))
    assert counts(spark, tables) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.endswith("__next")]


def test_without_cascade(spark, tables):
    with pytest.raises(ValueError, match="hold rows"):
        truncate_load(spark.range(1), tables["a"], refers(tables), cascade=False)
    truncate_load(spark.range(1), tables["x"], refers({"x": tables["x"]}) | {tables["x"]: []},
                  cascade=False)
    assert counts(spark, tables)["x"] == 1


def test_declared_tables_of_the_catalog(spark, tmp):
    create_namespaces(spark, f"{tmp}/warehouse")
    specs = pos_catalog()
    assert set(DECLARED_TYPES) == set(specs)
    columns = {n: declared_columns(s.schema, DECLARED_TYPES[n]) for n, s in specs.items()}
    for name, ddl in columns.items():
        assert {c for c, _ in ddl_columns(specs[name].schema)} >= set(DECLARED_TYPES[name])
        V.replace_rows(None, f"raw_pos.decl_{name}", ddl, f"{tmp}/{name}")
        known = dict(V.definition(spark, f"raw_pos.decl_{name}"))
        for column, kind in DECLARED_TYPES[name].items():
            assert known[column] == kind.lower()


def test_money_codes_and_json(spark, tmp):
    schema = "id INT, price DOUBLE, code STRING, obj STRING"
    columns = declared_columns(schema, {"price": "DECIMAL(38,4)", "code": "VARCHAR(3)",
                                        "obj": "VARIANT"})
    targets, paths = {"t": "decl_t"}, {"t": f"{tmp}/t"}

    def save(values):
        df = spark.createDataFrame(values, schema)
        return save_catalog({"t": df}, targets, paths, columns_of={"t": columns})

    good = [(1, 0.1, "EUR", '{"n": 5}'), (2, None, None, None), (3, 1.23455, "", "[1]")]
    assert save(good).saved == targets
    found = spark.table("decl_t").selectExpr(
        "id", "CAST(price AS STRING)", "code", "variant_get(obj, '$.n', 'int')").collect()
    assert sorted(map(tuple, found)) == [(1, "0.1000", "EUR", 5), (2, None, None, None),
                                         (3, "1.2346", "", None)]
    for bad in ((4, 1.0, "EURO", "1"), (4, 1.0, "EUR", "{not json"), (4, 1e300, "EUR", "1")):
        report = save([*good, bad])
        assert not report.saved and report.failed["t"]
        assert spark.table("decl_t").count() == 3
