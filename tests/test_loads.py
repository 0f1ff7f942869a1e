"""Sources, sinks, loads and ETL chains on small files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merclake.functions.columns import moment
from merclake.plans import etl
from merclake.sources import readers, star_load, writers
from merclake.sources.readers import FileSpec

AT = datetime(2025, 2, 1, 8)
CSV = """order_id,order_timestamp,total_amount,note
1,2025-01-01 10:00:00,10.5,NA
2,bad date,20,None
3,2025-01-03 10:00:00,,x

3,2025-01-03 11:00:00,30,dup
"""


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV)
    return tmp_path


def test_csv_nulls_and_inference(spark, folder):
    df = readers.read_file(spark, FileSpec(f"{folder}/in/a.csv", "csv"))
    assert dict(df.dtypes) == {"order_id": "bigint", "order_timestamp": "string", "total_amount": "double", "note": "string"}
    assert [r.note for r in df.orderBy("order_id", "note").collect()][:2] == [None, None]
    with pytest.raises(ValueError):
        readers.read_file(spark, FileSpec("x", "xml"))


def test_skip_rows(spark, tmp_path):
    (tmp_path / "p.csv").write_text('made by\n"x"\na;b\n1;"u;v"\n2;w\n')
    df = readers.read_csv(spark, FileSpec(f"{tmp_path}/p.csv", "csv", delimiter=";", skip_rows=2))
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "u;v"), (2, "w")]


def test_json_and_jsonl(spark, tmp_path):
    rows = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    (tmp_path / "d.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, rows)))
    for kind, name in (("json", "d.json"), ("jsonl", "l.jsonl")):
        got = readers.read_file(spark, FileSpec(f"{tmp_path}/{name}", kind))
        assert sorted(r.a for r in got.collect()) == [1, 2]


def test_directory_and_fingerprints(spark, folder):
    (folder / "in" / "b.csv").write_text(CSV)
    (folder / "in" / "c.txt").write_text("no")
    df = readers.read_directory(spark, f"{folder}/in", "csv")
    assert sorted(r.rows for r in readers.file_row_counts(df).collect()) == [4, 4]
    prints = readers.file_fingerprints(spark, f"{folder}/in", "*.csv")
    assert len({r.file_hash for r in prints.collect()}) == 1
    one = writers.folder_digest(prints.limit(1)).first().h
    assert one == prints.first().file_hash != writers.folder_digest(prints).first().h


def test_validate_schema(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a bigint, b string, c double")
    assert writers.validate_schema(df, {"a": "Int64", "b": "Utf8", "c": "float"}) == []
    assert writers.validate_schema(df, {"z": "int", "b": "int"}) == ["Missing column: z", "Column b: expected int, got string"]


def test_load_batch(spark, folder):
    spec = FileSpec(f"{folder}/in", "csv", date_columns=["order_timestamp"])
    run = lambda: writers.load_batch(
        spark, spec, f"{folder}/orders", f"{folder}/history", f"{folder}/dead", AT, ["order_id"], {"total_amount": "float"}
    ).first()
    first = run()
    assert (first.status, first.rows_loaded, first.rows_failed) == ("partial", 2, 1)
    assert run().status == "skipped"
    dead = spark.read.parquet(f"{folder}/dead").collect()
    assert [r.order_timestamp for r in dead] == ["bad date"] and dead[0]._failed_at == AT
    (folder / "in" / "b.csv").write_text(CSV.replace("1,2025-01-01", "7,2025-01-01"))
    again = run()  # order 7 is new, 3 is known
    assert (again.status, again.rows_loaded) == ("partial", 1)
    assert spark.read.parquet(f"{folder}/orders").count() == 3
    spec = FileSpec(f"{folder}/in", "csv")
    bad = writers.load_batch(spark, spec, f"{folder}/t", f"{folder}/h2", f"{folder}/d2", AT, ["order_id"], {"zip": "int"}).first()
    assert bad.status == "failed" and "Missing column: zip" in bad.error_message
    done = spark.read.parquet(f"{folder}/history")
    prints = readers.file_fingerprints(spark, f"{folder}/in").withColumn("file_hash", F.lit(first.file_hash))
    assert writers.unseen_files(prints, done).count() == 0


def test_upsert_takes_newest(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    batch = spark.createDataFrame([(2, "y", 0, 1), (2, "z", 0, 2), (3, "c", 30, 1)], "k int, s string, n int, v int")
    out = writers.upsert(target, batch, ["k"], ["s"], "v")
    assert sorted(out.collect()) == [(1, "a", 10), (2, "z", 20), (3, "c", 30)]


def test_incremental(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert writers.filter_incremental(df, "v", 2).count() == 1 and writers.filter_incremental(df, "v", None).count() == 3
    assert writers.high_water_mark(df, "v").first().high_water_mark == 3


def test_scd2(spark):
    schema = "k int, city string, tier string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
    day = lambda d: datetime(2025, 1, d)
    current = spark.createDataFrame(
        [(1, "old", "x", day(1), day(5), False), (1, "new", "x", day(5), None, True), (2, "b", "x", day(1), None, True), (3, None, "x", day(1), None, True)], schema
    )
    changes = spark.createDataFrame([(1, "newer", "x"), (2, "b", "y"), (3, None, "x"), (4, "d", "x")], "k int, city string, tier string")
    out = writers.apply_scd2(current, changes, ["k"], ["city"], day(9))
    got = sorted(((r.k, r.city, r.effective_from.day, r.effective_to and r.effective_to.day, r.is_current) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, "old", 1, 5, False), (1, "new", 5, 9, False), (1, "newer", 9, None, True), (2, "b", 1, None, True), (3, None, 1, None, True), (4, "d", 9, None, True)],
        key=str,
    )


def test_dim_date(spark):
    rows = star_load.dim_date(spark, "2024-12-28", "2025-01-02").orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [20241228, 20241229, 20241230, 20241231, 20250101, 20250102]
    assert (rows[0].day_of_week, rows[0].is_weekend, rows[4].month_name, rows[3].quarter) == (5, True, "January", 4)


def test_etl_results(spark, tmp_path, orders, customers, products):
    out = etl.run_full_etl(orders.unionByName(orders), customers, products, str(tmp_path), AT, reference_date="2025-02-01")
    rows = {r.transformation: r for r in out.collect()}
    assert (rows["orders"].input_rows, rows["orders"].output_rows, rows["orders"].rows_dropped) == (6, 3, 3)
    people = spark.read.parquet(rows["customers"].output_path)
    assert "email" not in people.columns and {"email_hash", "rfm_combined_score", "acquisition_cohort"} <= set(people.columns)
    goods = spark.read.parquet(rows["products"].output_path)
    assert goods.where("product_id = 9002").first().margin_percent == pytest.approx(49 / 119 * 100)
    assert etl.etl_summary(out).first().failed == 0
    broken = etl.transform_orders(orders.withColumn("total_amount", F.array("total_amount")), str(tmp_path), datetime(2025, 2, 2)).first()
    assert broken.errors and broken.output_path is None and broken.input_rows == 3


def test_transform_data_dispatch(spark, tmp_path, products):
    products.write.parquet(f"{tmp_path}/raw")
    assert etl.transform_data(spark, "products", f"{tmp_path}/raw", f"{tmp_path}/out", AT).first().output_rows == 3
    with pytest.raises(ValueError):
        etl.transform_data(spark, "weather", f"{tmp_path}/raw", f"{tmp_path}/out", AT)
    assert etl.validate_data(products, "weather") is None


def test_daily_aggregate(spark, tmp_path, orders):
    path = f"{tmp_path}/daily"
    facts = etl.orders_frame(orders)
    etl.write_daily_aggregate(facts, path)
    etl.update_daily_aggregate(facts.withColumn("total_amount", F.lit(1.0)), "2024-03-09", path)
    etl.update_daily_aggregate(facts, "2024-03-08", path)  # no orders: nothing changes
    got = {r.date_key: r.total_revenue for r in spark.read.parquet(path).collect()}
    assert got == {20240229: 80.0, 20240309: 1.0, 20240310: 0.0}


def test_quality_check_of_last_day(orders):
    facts = etl.orders_frame(orders)
    parts = etl.data_quality_check(facts, datetime(2024, 3, 11), hours=24)
    assert parts["summary"].first().total_checks == 8
    assert parts["report"].first().anomalies_found == 1  # an order of nothing
    assert [(r.metric_name, r.severity) for r in parts["alerts"].collect()] == [("order_revenue", "high")]


def test_curated_partitions(spark, tmp_path, orders):
    path = writers.write_curated(orders, str(tmp_path), "orders", AT, ["status"])
    assert path.endswith("orders_20250201_080000.parquet")
    scan = spark.read.parquet(path).where("status = 'pending'")
    assert scan.count() == 1 and "PartitionFilters: [isnotnull(status" in scan._jdf.queryExecution().toString()


def test_moment_of_values():
    assert str(moment("2025-01-01")) and str(moment(AT))


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(i, i % 4, "old") for i in range(40)]
    spark.createDataFrame(rows, "id long, part int, state string").write.partitionBy("part").parquet(path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    batch = spark.createDataFrame([(2, 2, "new"), (2, 2, "new"), (102, 2, "added")], "id long, part int, state string")
    assert writers.upsert_partitions(path, batch, ["id"], ["state"], "part") == 1
    got = {r.id: r.state for r in spark.read.parquet(path).collect()}
    assert got == {**{i: "old" for i in range(40)}, 2: "new", 102: "added"}
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    assert all(after.get(f) == t for f, t in before.items() if "part=2" not in str(f))


def test_new_files_only(spark, tmp_path):
    """A second run reads only the new file; content under another name and files of other columns are noticed."""
    source, root = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text("id,at\n1,2024-01-01 00:00:00\n2,soon\nN/A,\n")
    spec = FileSpec(str(source), "csv", schema="id BIGINT, at STRING", date_columns=["at"])
    load = lambda: writers.load_directory(spark, spec, f"{root}/t", f"{root}/h", f"{root}/d", AT, ["id"], pattern="*.csv")
    shown = lambda df: sorted((r.source_file.rsplit("/", 1)[1], r.status, r.rows_loaded, r.rows_failed) for r in df.collect())
    assert shown(load()) == [("a.csv", "partial", 1, 1)]
    assert load().count() == 0
    (source / "b.csv").write_text("id,at\n1,2024-02-02 00:00:00\n3,2024-02-03 00:00:00\n")
    (source / "c.csv").write_text((source / "a.csv").read_text())
    assert shown(load()) == [("b.csv", "completed", 1, 0), ("c.csv", "skipped", 0, 0)]
    rows = spark.read.parquet(f"{root}/t").collect()
    assert sorted(r.id for r in rows) == [1, 3] and {r._source_file.rsplit("/", 1)[1] for r in rows} == {"a.csv", "b.csv"}


def test_preamble_files_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text('top\n"id";"name";"v"\n1;x;2\n')
    (tmp_path / "b.csv").write_text("top\nv;id;name\n9;7;y\n")
    spec = FileSpec(f"{tmp_path}/*.csv", "csv", delimiter=";", skip_rows=1, schema="id INT, name STRING, v INT")
    assert sorted((r.id, r.name, r.v) for r in readers.read_file(spark, spec).collect()) == [(1, "x", 2), (7, "y", 9)]
    (tmp_path / "c.csv").write_text("top\nid;other\n1;2\n")
    with pytest.raises(ValueError):
        readers.read_file(spark, spec)


def test_broken_table_is_no_empty_table(spark, tmp_path):
    assert writers.read_table(spark, f"{tmp_path}/none", "id long").count() == 0
    assert writers.drop_all_null_rows(spark.createDataFrame([(None, None), (1, None)], "a int, b int")).count() == 1
