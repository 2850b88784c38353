"""The four views on a small point-of-sale fixture with the declared schemas."""

import datetime as dt

from quayside.plans import views


def test_orders_view_shape_and_rows(pos):
    out = views.orders_view(pos)
    assert len(out.columns) == 32
    assert out.columns[12:14] == ["franchisee_first_name", "franchisee_last_name"]
    rows = out.collect()
    # Line 4 belongs to order 12 whose truck is unknown: dropped by the inner chain.
    assert sorted(r["order_detail_id"] for r in rows) == [1, 2, 3]
    by_line = {r["order_detail_id"]: r for r in rows}
    # Order 11 has no member: the customer columns are null (left join).
    assert by_line[3]["customer_id"] is None and by_line[3]["first_name"] is None
    assert by_line[1]["customer_id"] == 500 and by_line[1]["first_name"] == "Bo"


def test_orders_dated_view(pos):
    out = views.orders_dated_view(pos)
    assert out.columns[0] == "date" and len(out.columns) == 33
    assert {r["date"] for r in out.collect()} == {dt.date(2024, 5, 1)}


def test_loyalty_metrics(pos):
    out = views.loyalty_metrics_view(pos)
    assert out.columns == [
        "customer_id", "city", "country", "first_name", "last_name", "phone_number", "e_mail",
        "total_sales", "visited_location_ids_array",
    ]
    rows = {r["customer_id"]: r for r in out.collect()}
    # Member 502 has no orders: not in the result (inner join).
    assert set(rows) == {500, 501}
    # Orders 10, 12, 13: location 1 three times -> one distinct id; exact sum.
    assert str(rows[500]["total_sales"]) == "14.5000"
    assert rows[500]["visited_location_ids_array"] == [1.0]
    # Member 501's only order has a null location: empty array, not null.
    assert rows[501]["visited_location_ids_array"] == []


def test_loyalty_duplicate_member_rows_multiply_like_the_join(spark, pos):
    t = dict(pos)
    t["customer_loyalty"] = pos["customer_loyalty"].unionByName(pos["customer_loyalty"].filter("customer_id = 501"))
    rows = {r["customer_id"]: r for r in views.loyalty_metrics_view(t).collect()}
    assert str(rows[501]["total_sales"]) == "4.0000"


def test_loyalty_pass_through_equal(pos):
    a = sorted(map(tuple, views.loyalty_metrics_view(pos).collect()))
    b = sorted(map(tuple, views.loyalty_pass_through(pos).collect()))
    assert a == b


def test_register_views(spark, pos):
    views.register_views(spark, pos)
    assert spark.sql("SELECT count(*) FROM analytics_orders_v").first()[0] == 3


def test_persistent_views_equal_the_frames(spark, pos, tmp):
    from quayside.sinks.tables import overwrite_table

    views.create_namespaces(spark, f"{tmp}/db")
    names = {n: overwrite_table(df, f"raw_pos.{n}", f"{tmp}/views/{n}") for n, df in pos.items()}
    made = views.create_views(spark, names)
    frames = [views.orders_view(pos), views.loyalty_metrics_view(pos),
              views.orders_dated_view(pos), views.loyalty_pass_through(pos)]
    for name, frame in zip(made, frames):
        got = spark.table(name)
        assert got.dtypes == frame.dtypes, name
        key = lambda r: str(tuple(r))
        assert sorted(map(key, got.collect())) == sorted(map(key, frame.collect())), name
    spark.catalog.setCurrentDatabase("default")
    assert {t.name for t in spark.catalog.listTables("analytics")} >= {
        "orders_v", "customer_loyalty_metrics_v"}


def test_literal_row(spark):
    assert views.literal_row(spark).collect()[0]["note"] == views.setup_note()


def test_create_raw_tables(spark, tmp):
    from quayside.specs import pos_catalog

    views.create_namespaces(spark, f"{tmp}/db")
    made = views.create_raw_tables(spark, pos_catalog(), f"{tmp}/tables")
    assert len(made) == 8
    t = spark.table("raw_pos.order_header")
    assert t.count() == 0
    assert dict(t.dtypes)["location_id"] == "float"
    assert dict(spark.table("raw_pos.country").dtypes)["country_id"] == "decimal(18,0)"


def test_preview_and_object_store_conf(spark):
    from quayside.operators.limits import preview
    from quayside.session import anonymous_object_store_conf

    assert len(preview(spark.range(100))) == 20
    assert "spark.hadoop.fs.s3a.aws.credentials.provider" in anonymous_object_store_conf()
