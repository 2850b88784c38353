import gzip
import os

from quayside.functions.variant import parse_variant, variant_field
from quayside.sources.catalog import MISSING, load_catalog
from quayside.sources.csv import ddl_of, read_csv, read_csv_gz, write_stage
from quayside.specs import TableSpec, pos_catalog


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as fh:
            fh.write(text)
    else:
        with open(path, "w") as fh:
            fh.write(text)


def test_header_per_file(spark, tmp):
    # H1: two gzip files of three rows; with header=true each loses its first line.
    _write(f"{tmp}/h/a.csv.gz", "1,a\n2,b\n3,c\n", gz=True)
    _write(f"{tmp}/h/b.csv.gz", "4,d\n5,e\n6,f\n", gz=True)
    assert read_csv(spark, f"{tmp}/h", "id int, v string", header=True).count() == 4
    assert read_csv(spark, f"{tmp}/h", "id int, v string", header=False).count() == 6


def test_bad_text_short_and_long_rows(spark, tmp):
    _write(f"{tmp}/b/x.csv", "id,v\nabc,a\n1.0,b\n99999999999,c\n7\n8,h,extra\n")
    rows = [tuple(r) for r in read_csv(spark, f"{tmp}/b", "id int, v string").collect()]
    assert rows == [(None, "a"), (None, "b"), (None, "c"), (7, None), (8, "h")]


def test_schema_wins_by_position(spark, tmp):
    _write(f"{tmp}/p/x.csv", "v,id\n1,2\n")
    row = read_csv(spark, f"{tmp}/p", "id int, v int").first()
    assert (row["id"], row["v"]) == (1, 2)


def test_untyped_scan_is_all_strings(spark, tmp):
    _write(f"{tmp}/s/x.csv", "a,b\n1,2024-01-01\n")
    df = read_csv(spark, f"{tmp}/s")
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]


def test_json_in_csv_needs_quote_escape(spark, tmp):
    # H8: doubled quotes inside a quoted field.
    _write(f"{tmp}/j/x.csv", 'id,obj\n1,"{""a"": 1, ""b"": [1,2]}"\n')
    menu = pos_catalog()["menu"]
    assert menu.options["escape"] == '"'
    df = read_csv(spark, f"{tmp}/j", "id int, obj string", options={"escape": '"'})
    assert df.first()["obj"] == '{"a": 1, "b": [1,2]}'
    v = df.select(variant_field(parse_variant("obj"), "$.a", "int").alias("a")).first()
    assert v["a"] == 1


def test_gzip_scan_is_redistributed(spark, tmp):
    _write(f"{tmp}/g/one.csv.gz", "id\n" + "\n".join(str(i) for i in range(1000)) + "\n", gz=True)
    df = read_csv_gz(spark, f"{tmp}/g/one.csv.gz", "id int", partitions=4)
    assert "RoundRobinPartitioning(4)" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1000


def test_stage_round_trip(spark, tmp):
    src = spark.sql(
        "SELECT id, CAST(id AS DOUBLE) / 3 AS d, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS ts "
        "FROM range(50)"
    )
    path = write_stage(src, f"{tmp}/rt")
    back = read_csv(spark, path, ddl_of(src))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))


def test_catalog_isolates_missing_table(spark, tmp):
    # H9: a folder that does not exist fails at read time, the rest loads.
    _write(f"{tmp}/cat/raw_pos/location/x.csv", "location_id,placekey\n1,a\n")
    specs = {
        "location": TableSpec("location", "raw_pos/location/", "location_id int, placekey string"),
        "truck": TableSpec("truck", "raw_pos/truck/", "truck_id int"),
    }
    loaded = load_catalog(spark, specs, f"{tmp}/cat")
    assert set(loaded.tables) == {"location"} and set(loaded.failures) == {"truck"}
    status = {r["table_name"]: (r["status"], r["row_count"]) for r in loaded.status(spark).collect()}
    assert status == {"location": ("loaded", 1), "truck": (MISSING, None)}


def test_pos_catalog_specs():
    cat = pos_catalog()
    assert len(cat) == 8
    assert cat["customer_loyalty"].namespace == "raw_customer"
    assert cat["order_detail"].bucket_key == "order_id"
    assert cat["order_header"].schema.startswith("order_id INT, truck_id INT, location_id FLOAT")


def test_spread_narrow_scan(spark, tmp):
    from quayside.sources.parquet import read_parquet, spread_narrow_scan

    spark.range(100).coalesce(1).write.parquet(f"{tmp}/one")
    df = read_parquet(spark, f"{tmp}/one")
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 16)
    assert spread_narrow_scan(wide, 4) is wide


def test_stage_round_trip_of_quotes_and_fractions(spark, tmp):
    src = spark.sql(
        """SELECT * FROM VALUES
           (1, 'say "hi", ok', TIMESTAMP_NTZ '2024-01-02 10:00:00.123456'),
           (2, '{"a": 1, "b": "c\\\\d"}', TIMESTAMP_NTZ '2024-01-02 10:00:00.5'),
           (3, 'back\\\\slash', TIMESTAMP_NTZ '2024-01-02 10:00:00') AS t(id, s, ts)""")
    path = write_stage(src, f"{tmp}/quotes")
    back = read_csv(spark, path, ddl_of(src))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))


def test_timestamps_without_a_pattern(spark, tmp):
    _write(f"{tmp}/ts/x.csv", "id,ts\n1,2022-10-16T20:06:55\n2,2022-10-16\n3,2022-10-16 20:06:55.25\n")
    rows = read_csv(spark, f"{tmp}/ts", "id int, ts timestamp_ntz").collect()
    assert [str(r["ts"]) for r in rows] == [
        "2022-10-16 20:06:55", "2022-10-16 00:00:00", "2022-10-16 20:06:55.250000"]


def test_catalog_isolates_any_error(spark, tmp, monkeypatch):
    from quayside.sources import catalog

    def denied(*args, **kwargs):
        raise PermissionError("access denied")

    monkeypatch.setattr(catalog, "read_csv", denied)
    loaded = load_catalog(spark, {"t": TableSpec("t", "t/", "id int")}, tmp)
    assert loaded.failures == {"t": "access denied"}
