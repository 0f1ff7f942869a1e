"""Loads of folders: files that fail alone, runs that stop between their writes, content hashes."""

from datetime import datetime

import pytest

from merclake.plans import etl
from merclake.sources import loads, readers, writers
from merclake.sources.keyed import Keyed
from merclake.sources.ledger import Ledger
from merclake.sources.readers import FileSpec

AT = datetime(2025, 2, 1, 8)
TARGET = Keyed("t", ("id",), buckets=4, blocks=8)


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,at\n1,2025-01-01 00:00:00\n2,soon\n")
    (tmp_path / "in" / "b.csv").write_text("id,at\n2,2025-01-02 00:00:00\n3,2025-01-03 00:00:00\n")
    (tmp_path / "in" / "wrong.csv").write_text("id,when\n9,2025-01-02 00:00:00\n")
    (tmp_path / "in" / "empty.csv").write_text("\n")
    return tmp_path


def spec_of(folder, kind="csv"):
    return FileSpec(f"{folder}/in", kind, schema="id BIGINT, at STRING", date_columns=["at"])


def shown(df):
    return sorted((r.source_file.rsplit("/", 1)[1], r.status, r.rows_loaded, r.rows_failed, (r.error_message or "")[:40]) for r in df.collect())


WANT = [
    ("a.csv", "partial", 1, 1, ""), ("b.csv", "completed", 2, 0, ""), ("empty.csv", "failed", 0, 0, "the file is empty"),
    ("wrong.csv", "failed", 0, 0, "schema validation failed: Missing column"),
]


def test_bad_files_fail_alone(spark, folder):
    load = lambda: writers.load_directory(spark, spec_of(folder), f"{folder}/t", f"{folder}/h", f"{folder}/d", AT, ["id"], {"at": "str"}, "*.csv")
    assert shown(load()) == WANT
    (folder / "in" / "wrong.csv").write_text("at,id\n2025-01-04 00:00:00,9\n")  # mended, with its columns in another order
    assert shown(load()) == [WANT[2], ("wrong.csv", "completed", 1, 0, "")]  # only what failed is tried again
    assert sorted((r.id, r.at.day) for r in spark.read.parquet(f"{folder}/t").collect()) == [(1, 1), (2, 2), (3, 3), (9, 4)]


def test_damaged_files_fail_alone(spark, tmp_path):
    for i in range(7):
        spark.createDataFrame([(i,)], "id bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    victim = sorted((tmp_path / "in").glob("part-*.parquet"))[4]
    victim.write_bytes(b"PAR1 not a table PAR1")
    (victim.parent / f".{victim.name}.crc").unlink()
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    out = loads.load_files(ledger, FileSpec(f"{tmp_path}/in", "parquet"), TARGET, AT, pattern="*.parquet").collect()
    assert sorted(r.status for r in out) == ["completed"] * 6 + ["failed"]
    assert [r.source_file.rsplit("/", 1)[1] for r in out if r.status == "failed"] == [victim.name]
    assert ledger.read("t").count() == 6


@pytest.mark.parametrize("stop_at", ["t", "t_keys", "t_dead_letters", "load_history", "commit"])
def test_a_run_that_stops_has_loaded_nothing(spark, folder, monkeypatch, stop_at):
    """Whatever the last write before the crash was, the next run loads all, once, with its dead letters and counts."""
    ledger = Ledger(spark, f"{folder}/ledger")
    write, commit = ledger.write, ledger.commit

    def stop_write(table, *args, **more):
        done = write(table, *args, **more)
        if table == stop_at:
            raise RuntimeError("power cut")
        return done

    def stop_commit(*args):
        if stop_at == "commit":
            raise RuntimeError("power cut")
        return commit(*args)

    monkeypatch.setattr(ledger, "write", stop_write)
    monkeypatch.setattr(ledger, "commit", stop_commit)
    load = lambda on: loads.load_files(on, spec_of(folder), TARGET, AT, {"at": "str"}, "*.csv")
    with pytest.raises(RuntimeError):
        load(ledger)
    fresh = Ledger(spark, f"{folder}/ledger")
    assert fresh.state().version == 0
    assert shown(load(fresh)) == WANT
    assert sorted(r.id for r in fresh.read("t").collect()) == [1, 2, 3]
    assert [r["at"] for r in fresh.read("t_dead_letters").collect()] == ["soon"]
    assert fresh.read("load_history").count() == 4
    assert shown(load(fresh)) == WANT[2:]


def test_json_lines_in_another_order_are_other_content(spark, tmp_path):
    texts = {"a": "[{\"a\":\n1},\n{\"a\":\n2}]\n", "b": "[{\"a\":\n2},\n{\"a\":\n1}]\n", "c": "[{\"a\":\n1},\n{\"a\":\n2}]\n", "d": "[{\"a\":\n1},\n{\"a\":\n2}]"}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    prints = {r.path.rsplit("/", 1)[1][0]: r.file_hash for r in readers.file_fingerprints(spark, str(tmp_path)).collect()}
    assert prints["a"] == prints["c"] and len(set(prints.values())) == 3


def test_hash_does_not_depend_on_splits(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("x", "y"):
        (tmp_path / "in" / name).write_text("".join(f"{i * 7919 % 1000},{i}\n" for i in range(40_000)))
    lines = (tmp_path / "in" / "y").read_text().split("\n")
    (tmp_path / "in" / "z").write_text("\n".join([lines[1], lines[0], *lines[2:]]))
    whole = {r.path: r.file_hash for r in readers.file_fingerprints(spark, f"{tmp_path}/in").collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        assert {r.path: r.file_hash for r in readers.file_fingerprints(spark, f"{tmp_path}/in").collect()} == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(set(whole.values())) == 2


def test_second_day_reads_one_file(spark, tmp_path, monkeypatch):
    for name in ("orders", "customers"):
        (tmp_path / "in" / name).mkdir(parents=True)
    rows = lambda day, ids: "order_id,customer_id,order_timestamp,total_amount,item_count\n" + "".join(f"{i},1,2025-01-0{day} 10:00:00,5.0,1\n" for i in ids)
    (tmp_path / "in" / "orders" / "d1.csv").write_text(rows(1, range(1, 6)))
    (tmp_path / "in" / "customers" / "c.csv").write_text("customer_id,name\n1,x\n")
    asked = []
    real = writers.read_directory
    monkeypatch.setattr(writers, "read_directory", lambda spark, paths, *a, **k: asked.append([p.rsplit("/", 1)[1] for p in paths]) or real(spark, paths, *a, **k))
    run = lambda day: {r.target_table: (r.status, r.files, r.rows_loaded) for r in etl.daily_batch_etl(spark, f"{tmp_path}/in", f"{tmp_path}/w", f"2025-01-0{day}", AT).collect()}
    assert run(1) == {"staging_orders": ("completed", 1, 5), "staging_customers": ("completed", 1, 1)}
    (tmp_path / "in" / "orders" / "d2.csv").write_text(rows(2, range(4, 9)))
    asked.clear()
    assert run(2) == {"staging_orders": ("completed", 1, 3), "staging_customers": ("skipped", 0, 0)} and asked == [["d2.csv"]]
    (tmp_path / "in" / "orders" / "d3.csv").write_text("order_id\n77\n")
    with pytest.raises(RuntimeError, match="d3.csv"):
        run(3)
    assert spark.read.parquet(f"{tmp_path}/w/agg_daily_sales").count() == 2
