from quayside.functions import names as N


def test_underscore_names():
    assert N.underscore_names(["a b", "c", "d  e"]) == ["a_b", "c", "d__e"]


def test_sanitize_names():
    assert N.sanitize_names(["a b", 'q"x', "k-1", "", "ok"]) == ["a_b", "qx", "k_1", "col_3", "ok"]


def test_sanitize_name_empty_after_cleaning():
    assert N.sanitize_names(['"']) == ["col_0"]


def test_dedupe_every_copy_gets_its_position():
    assert N.dedupe_names(["x", "y", "x"]) == ["x_0", "y", "x_2"]


def test_dedupe_collision_keeps_counting():
    # The plain rule would produce x_0 twice.
    out = N.dedupe_names(["x", "y", "x", "x_0"])
    assert out == ["x_1", "y", "x_2", "x_0"]
    assert len({n.lower() for n in out}) == len(out)


def test_dedupe_ignores_case():
    assert N.dedupe_names(["x", "X"]) == ["x_0", "X_1"]


def test_dedupe_unique_untouched():
    assert N.dedupe_names(["a", "b"]) == ["a", "b"]


def test_sheet_table_name():
    assert N.sheet_table_name("Sales Order data") == "Sales_Order_data"


def test_apply_on_dataframe(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a-b", 'a"b'])
    assert N.apply_sanitize(df).columns == ["a_b", "a_b", "ab"]
    assert N.writable_names(df).columns == ["a_b_0", "a_b_1", "ab"]


def test_prefix_rename_absent_is_noop(spark):
    df = spark.createDataFrame([(1, "x")], ["id", "city"])
    out = N.prefix_rename(df, {"city": "truck_city", "region": "truck_region"})
    assert out.columns == ["id", "truck_city"]


def test_prefix_rename_matches_case_insensitively(spark):
    df = spark.createDataFrame([(1, "x")], ["id", "City"])
    assert N.prefix_rename(df, {"city": "truck_city"}).columns == ["id", "truck_city"]
