"""Disk of the writes: denser files, shuffle files that go with their write, rounds."""

from __future__ import annotations

import datetime
import os
import threading
import time

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from test_journal import Broken, base, break_at, check_tables, copied, early, staged, stored  # noqa: F401
from test_sizes import small_lineitem
from taxiframe import queries, session
from taxiframe.operators import model
from taxiframe.plans import trips, warehouse
from taxiframe.sources import folders, journal, sinks


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def left_by(spark, before):
    """Shuffle files that came after ``before``; Spark removes them in the background."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def codecs(folder):
    files = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    return {parquet.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files
            if parquet.ParquetFile(f).metadata.num_row_groups}


def test_settings_of_stored_tables_end_with_the_write(spark):
    before = {k: spark.conf.get(k) for k in session.STORING}
    with session.storing(spark):
        assert {k: spark.conf.get(k) for k in session.STORING} == session.STORING
    assert {k: spark.conf.get(k) for k in session.STORING} == before


def test_warehouse_leaves_no_shuffle_files(spark, tmp_path):
    sf_dir, before = small_lineitem(spark, tmp_path, 62), shuffle_files(spark)
    root = warehouse.build(spark, sf_dir).removeprefix("file:")
    assert not left_by(spark, before)
    assert all(codecs(f"{root}/{t}") == {"ZSTD"} for t in ("load", *warehouse.TABLES))


def test_large_tables_are_written_one_after_another():
    """The widest first; small ones side by side."""
    open_now, most, order, lock = [], [], [], threading.Lock()

    def write(name):
        with lock:
            open_now.append(name), order.append(name), most.append(len(open_now))
        time.sleep(0.2)
        open_now.remove(name)

    model.table_by_table(write, {"a": 1, "b": 3, "c": 2}, model.SIDE_BYTES + 1)
    assert order == ["b", "c", "a"] and max(most) == 1
    model.table_by_table(write, {"a": 1, "b": 3, "c": 2}, model.SIDE_BYTES)
    assert max(most) == 3


def test_rounds_are_bounded():
    assert [model.rounds(n) for n in (0, 1, model.ROUND_BYTES + 1, 1 << 50)] == [1, 1, 2, model.MOST_ROUNDS]


def test_append_load_in_rounds(spark, staged, tmp):  # noqa: F811
    """Rows and reruns are those of one write, also rows of no part."""
    rows = staged.withColumn("source_part", F.when(F.col("source_part") != "02", F.col("source_part")))
    before = shuffle_files(spark)
    sinks.append_load(rows, tmp, n_bytes=1 << 40)
    assert not left_by(spark, before) and codecs(tmp) == {"ZSTD"}
    want = stored(model.conform_schema(rows))
    read = lambda: stored(spark.read.parquet(tmp).drop("source_part"))
    assert read() == want
    sinks.append_load(rows.where("source_part = '00'"), tmp, n_bytes=1 << 40)
    assert read() == want


def test_append_tmp_leaves_no_shuffle_files(spark, tmp_path):
    sf_dir, before = small_lineitem(spark, tmp_path, 63), shuffle_files(spark)
    got = queries.append_tmp(spark, sf_dir)
    assert not left_by(spark, before)
    assert stored(got) == stored(trips.load_table(spark, sf_dir))


@pytest.mark.parametrize("rounds", [1, 4])
def test_loads_in_rounds(spark, staged, base, tmp, monkeypatch, rounds):  # noqa: F811
    """A load's rows by months give the tables of a single write, and its copy of
    the rows is gone before the model tables are made."""
    monkeypatch.setattr(model, "ROUND_BYTES", 1 if rounds > 1 else 1 << 40)
    written, seen, write, rebuild = [], [], model.write_table, journal._rebuild_days

    def counted(rows, path, *args):
        written.append(path.split("/")[-1])
        write(rows, path, *args)

    def looked(spark, root, load_id, name):
        seen.append(folders.exists(spark, f"{root}/journal/{load_id}/rows"))
        rebuild(spark, root, load_id, name)

    monkeypatch.setattr(model, "write_table", counted)
    monkeypatch.setattr(journal, "_rebuild_days", looked)
    root, before = copied(base, tmp), shuffle_files(spark)
    none = staged.withColumn("tpep_pickup_datetime", F.when(F.col("source_part") == "02", None).otherwise(
        F.col("tpep_pickup_datetime")))
    journal.load(none, root, ["01", "02"], run_ts=trips.RUN_TS)
    assert not left_by(spark, before)
    assert seen == [False] * 3
    assert all((written.count(t) > 1) == (rounds > 1) for t in ("load", *journal.TABLES))
    assert journal.read(spark, root, "trips_pickup").where("day IS NULL").count() > 0
    check_tables(spark, root, none, tmp)
    journal.load(staged, root, ["02"], run_ts=trips.RUN_TS)
    check_tables(spark, root, staged, tmp)
    first = f"{tmp}/first"
    journal.load(none, first, run_ts=trips.RUN_TS)
    check_tables(spark, first, none, tmp)


@pytest.mark.parametrize("step", ["index:trips_data", "before:_CLEAN"])
def test_load_in_rounds_broken(spark, staged, base, tmp, monkeypatch, step):  # noqa: F811
    monkeypatch.setattr(model, "ROUND_BYTES", 1)
    root = copied(base, tmp)
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, step)
        journal.load(staged, root, ["01", "02"], run_ts=trips.RUN_TS)
    journal.resume(spark, root)
    check_tables(spark, root, staged, tmp)


def test_rows_of_early_years_are_in_a_round(spark, staged, tmp, monkeypatch):  # noqa: F811
    """Years whose names are of another form in the driver."""
    monkeypatch.setattr(model, "ROUND_BYTES", 1)
    old = F.when(F.col("source_part") == "01", F.lit("0900-03-01 10:00:00")).otherwise(F.col("tpep_pickup_datetime"))
    rows = staged.withColumn("tpep_pickup_datetime", old)
    journal.load(rows, tmp, run_ts=trips.RUN_TS)
    check_tables(spark, tmp, rows, tmp)


def test_record_of_an_older_version(spark, tmp):
    """A record that doesn't say how many bytes its rows take."""
    at = f"{tmp}/journal/000001"
    spark.createDataFrame([("2024-01-15 13:45:00", None)], "run_ts string, key string").write.parquet(f"{at}/info")
    spark.range(10).write.parquet(f"{at}/rows")
    assert journal._n_bytes(spark, tmp, "000001") == folders.n_bytes(spark, f"{at}/rows") > 0


def test_loaded_files_leave_the_quarantine_only(spark, tmp_path):
    sf_dir = small_lineitem(spark, tmp_path, 64)
    spark.createDataFrame(
        [(i, 3 * i, 5 * i, i % 7, datetime.datetime(1996, 1 + i % 12, 1 + i % 28)) for i in range(400)],
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema).write.mode("append").parquet(f"{sf_dir}/lineitem.parquet")
    root = queries.incremental_warehouse(spark, sf_dir).removeprefix("file:")
    sides = {d.split("/")[-1] for d, _, names in os.walk(f"{root}/staged") for f in names if f.endswith(".parquet")}
    assert sides == {"status=quarantined"}
    assert journal.read(spark, root, "trips_data").count() == trips.load_table(spark, sf_dir).count()
