"""Journaled loads: broken runs, the file index, the ledger, the stream and the
tables by name."""
import datetime
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from test_files import GOOD, line, write_text
from test_sizes import small_lineitem
from taxiframe import queries
from taxiframe.operators import clean, model
from taxiframe.plans import trips
from taxiframe.sources import catalog, file_index, files, folders, journal, sinks
from taxiframe.streaming import incremental


@pytest.fixture(scope="module")
def staged(spark):
    """Staged trips of two months and the parts 00 to 02."""
    part = F.regexp_extract("source_file", "_([0-9]+)[.]csv", 1)
    rows = trips.classified(spark, SF01).where("tpep_pickup_datetime < '1995-03'").withColumn("source_part", part)
    rows = clean.staged_view(rows, ("source_part",)).where("source_part IN ('00', '01', '02')").cache()
    assert rows.count() > 30
    return rows


def early(staged):
    """The rows with pickups nine days early."""
    moved = F.to_timestamp("tpep_pickup_datetime") - F.expr("INTERVAL 9 DAYS")
    return staged.withColumn("tpep_pickup_datetime", F.date_format(moved, "yyyy-MM-dd HH:mm:ss"))


def stored(frame):
    return sorted(tuple(map(str, r)) for r in frame.collect())


def check_tables(spark, root, staged, tmp):
    """All tables as one load of ``staged`` gives them, by index and by listing."""
    load = model.conform_schema(staged, keep=("source_part",))
    want = {"load": stored(load)} | {n: stored(t) for n, t in model.model_tables(load, trips.RUN_TS).items()}
    for name, rows in want.items():
        columns = journal.table_schema(name).fieldNames()
        assert stored(journal.read(spark, root, name)) == rows, name
        listed = spark.read.schema(journal.table_schema(name)).parquet(f"{root}/{name}").select(columns)
        assert stored(listed) == rows, name
        index = journal.index(spark, root, name)
        assert sum(r["n_rows"] for r in index.collect()) == len(rows)
        found = {os.path.relpath(os.path.join(d, f), f"{root}/{name}") for d, _, names in os.walk(f"{root}/{name}")
                 for f in names if f.endswith(".parquet")}
        assert found == {r["file"] for r in index.collect()}, name
        days = {(r["part"], r["n"]) for r in index.groupBy("part").agg(F.sum("n_rows").alias("n")).collect()}
        column = journal.partition_of(name)
        assert days == {(v and str(v), sum(str(r[-1]) == str(v) for r in rows)) for v in {
            r[column] for r in journal.read(spark, root, name).select(column).collect()}}
        kept = {f for f in os.listdir(f"{root}/{name}") if "=" in f}
        assert kept == {f.split("/")[0] for f in found}  # no empty folder is left


@pytest.fixture(scope="module")
def base(spark, staged, tmp_path_factory):
    """A warehouse with parts 00 and 01, whose part 01 is wrong."""
    root = str(tmp_path_factory.mktemp("base"))
    journal.load(staged.where("source_part = '00'"), root, run_ts=trips.RUN_TS)
    journal.load(early(staged.where("source_part = '01'")), root, run_ts=trips.RUN_TS)
    return root


def copied(base, tmp):
    shutil.copytree(base, f"{tmp}/warehouse")
    return f"{tmp}/warehouse"


def test_loads_of_parts_keep_every_row(spark, staged, base, tmp):
    root = copied(base, tmp)
    moved = {r["part"] for r in journal.index(spark, root, "trips_pickup").collect()}
    journal.load(staged, root, ["01"], run_ts=trips.RUN_TS)
    journal.load(staged, root, ["00"], run_ts=trips.RUN_TS)  # a repeat
    check_tables(spark, root, staged.where("source_part < '02'"), tmp)
    assert moved - {r["part"] for r in journal.index(spark, root, "trips_pickup").collect()}
    journal.load(staged.where("false"), root, ["01"], run_ts=trips.RUN_TS)  # a part that ends empty
    check_tables(spark, root, staged.where("source_part = '00'"), tmp)


class Broken(Exception):
    pass


def break_at(monkeypatch, step):
    """Break a load where ``step`` says."""
    place, what = step.split(":")
    mark, write, delete = folders.mark, file_index.write, folders.delete

    def marked(spark, name):
        if place == "before" and name.endswith(what):
            raise Broken(step)
        mark(spark, name)
        if place == "after" and name.endswith(what):
            raise Broken(step)

    def written(index, table, version):
        if place == "index" and table.endswith("/" + what):
            raise Broken(step)  # the rows are written, the index is not
        write(index, table, version)

    def deleted(spark, *names):
        if place == "clean" and names and any(n.endswith(what) for n in names):
            raise Broken(step)
        delete(spark, *names)

    monkeypatch.setattr(folders, "mark", marked)
    monkeypatch.setattr(file_index, "write", written)
    monkeypatch.setattr(folders, "delete", deleted)


STEPS = ["before:_PLANNED", "after:_PLANNED", "index:load", "after:_DONE-load", "index:trips_pickup",
         "after:_DONE-trips_data", "before:_DONE-ledger", "before:_CLOSED", "after:_CLOSED", "clean:/rows"]


@pytest.mark.parametrize("step", STEPS)
def test_load_broken_at_every_step(spark, staged, base, tmp, monkeypatch, step):
    root = copied(base, tmp)
    before = {n: stored(journal.read(spark, root, n)) for n in journal.TABLES}
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, step)
        journal.load(staged, root, ["01", "02"], run_ts=trips.RUN_TS)
    if step not in ("after:_CLOSED", "clean:/rows"):  # readers see what was before
        assert {n: stored(journal.read(spark, root, n)) for n in journal.TABLES} == before
    if step == "before:_PLANNED":
        assert journal.resume(spark, root) == []
        journal.load(staged, root, ["01", "02"], run_ts=trips.RUN_TS)
    elif step == "index:trips_pickup":  # the next load, of something else, finishes the broken one
        journal.load(staged, root, ["00"], run_ts=trips.RUN_TS)
    else:
        journal.resume(spark, root)
    check_tables(spark, root, staged, tmp)


def test_first_load_broken_and_repeated(spark, staged, tmp, monkeypatch):
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, "index:trips_data")
        journal.load(staged, tmp, run_ts=trips.RUN_TS)
    assert journal.read(spark, tmp, "trips_data").count() == 0
    journal.load(staged, tmp, run_ts=trips.RUN_TS)
    check_tables(spark, tmp, staged, tmp)


def test_null_id_stops_the_load_before_it_shows(spark, staged, base, tmp):
    root = copied(base, tmp)
    bad = staged.withColumn("id", F.when(F.col("pickup_latitude") > 0, F.lit(None).cast("string")))
    before = {n: stored(journal.read(spark, root, n)) for n in journal.TABLES}
    with pytest.raises(Exception, match="custom_id must not be null"):
        journal.load(bad, root, ["01"], run_ts=trips.RUN_TS)
    assert {n: stored(journal.read(spark, root, n)) for n in journal.TABLES} == before


def test_load_of_no_row(spark, staged, tmp):
    journal.load(staged.where("false"), tmp, run_ts=trips.RUN_TS)
    assert all(journal.read(spark, tmp, n).count() == 0 for n in ("load", *journal.TABLES))
    journal.load(staged, tmp, run_ts=trips.RUN_TS)
    check_tables(spark, tmp, staged, tmp)


def test_rows_without_a_pickup_time(spark, staged, tmp):
    """Their day is null; a later load of the part replaces them too."""
    none = staged.withColumn("tpep_pickup_datetime", F.when(F.col("source_part") == "01", None).otherwise(
        F.col("tpep_pickup_datetime")))
    journal.load(none, tmp, run_ts=trips.RUN_TS)
    assert journal.read(spark, tmp, "trips_pickup").where("day IS NULL").count() > 0
    journal.load(staged, tmp, ["01"], run_ts=trips.RUN_TS)
    check_tables(spark, tmp, staged, tmp)


def test_range_opens_the_named_files_only(spark, base):
    days, zones = ("1995-01-20", "1995-02-10"), ("dr5rd", "dr5rz")
    got = journal.read_range(spark, base, "trips_pickup", days, zones)
    index = journal.index(spark, base, "trips_pickup")
    named = index.where(f"part BETWEEN '{days[0]}' AND '{days[1]}' AND max_geohash >= '{zones[0]}' "
                        f"AND min_geohash <= '{zones[1]}'").select("file").collect()
    opened = {"/".join(f.split("/")[-2:]) for f in got.inputFiles()}
    files_ = index.select("file").distinct().count()
    assert opened == {r["file"] for r in named} and 0 < len(opened) <= files_
    day = min(r["part"] for r in index.collect())
    assert 0 < len(journal.read_range(spark, base, "trips_pickup", (day, day)).inputFiles()) < files_
    want = journal.read(spark, base, "trips_pickup").where(
        f"day BETWEEN '{days[0]}' AND '{days[1]}' AND geohash BETWEEN '{zones[0]}' AND '{zones[1]}'")
    assert stored(got) == stored(want)
    assert journal.read_range(spark, base, "trips_data", ("1900-01-01", "1900-01-02")).count() == 0
    passengers = journal.read_range(spark, base, "trips_data", keys=(2, 3))
    assert stored(passengers) == stored(journal.read(spark, base, "trips_data").where("passenger_count BETWEEN 2 AND 3"))


def test_corrected_file_of_same_size_is_new(spark, staged, tmp):
    folder = f"{tmp}/raw"
    for part in ("00", "01"):
        write_text(f"{folder}/yellow_tripdata_1995-01_{part}.csv", [line(GOOD)] * 2)
    listing = files.list_files(spark, f"{folder}/*.csv").withColumnRenamed("modificationTime", "modified")
    root = f"{tmp}/warehouse"
    assert files.new_files(listing, journal.loaded_files(spark, root)).count() == 2
    journal.load(staged.where("source_part = '00'"), root, files=listing, run_ts=trips.RUN_TS)
    noted = journal.ledger(spark, root).collect()
    assert {(r["file_name"], r["state"], r["load"]) for r in noted} == {
        (f"yellow_tripdata_1995-01_{p}.csv", "loaded", "000001") for p in ("00", "01")}
    assert files.new_files(listing, journal.loaded_files(spark, root)).count() == 0
    os.utime(f"{folder}/yellow_tripdata_1995-01_01.csv", (time.time() + 60, time.time() + 60))
    again = files.list_files(spark, f"{folder}/*.csv").withColumnRenamed("modificationTime", "modified")
    new = files.new_files(again, journal.loaded_files(spark, root)).collect()
    assert [r["file_name"] for r in new] == ["yellow_tripdata_1995-01_01.csv"]


def test_stream_into_the_warehouse(spark, tmp, monkeypatch):
    """A stream that stops after staging goes on with the same batch; tables equal a batch load."""
    def trip(day, extra):
        times = [f"2015-04-{day} 10:{minutes}:00" for minutes in ("00", "20")]
        return line([GOOD[0], *times, *GOOD[3:13], extra, *GOOD[14:]])

    folder, root, checkpoint = f"{tmp}/in", f"{tmp}/warehouse", f"{tmp}/checkpoint"
    write_text(f"{folder}/yellow_tripdata_2015-04_00.csv", [trip("01", "0.5"), trip("02", "1"), "broken"])
    with monkeypatch.context() as patch, pytest.raises(Exception, match="stopped"):
        def stopped(*args):
            raise RuntimeError("stopped after staging")
        patch.setattr(journal, "replay", stopped)
        incremental.load_new_files(spark, folder, root, checkpoint, trips.RUN_TS)
    assert journal.ledger(spark, root).count() == 0
    incremental.load_new_files(spark, folder, root, checkpoint, trips.RUN_TS)
    assert journal.read(spark, root, "trips_data").count() == 2 and len(journal.loads(spark, root)) == 1
    write_text(f"{folder}/yellow_tripdata_2015-04_01.csv", [trip("02", "0"), trip("03", "0")])
    for _ in range(2):  # the second run finds nothing new
        incremental.load_new_files(spark, folder, root, checkpoint, trips.RUN_TS)
    assert len(journal.loads(spark, root)) == 2
    assert sorted(r["file_name"] for r in journal.ledger(spark, root).collect()) == [
        "yellow_tripdata_2015-04_00.csv", "yellow_tripdata_2015-04_01.csv"]
    rows = sinks.read_staged(spark, f"{root}/staged/files", extra=["source_path"])
    rows = rows.withColumn("source_part", incremental.part_of_file(F.col("source_path"))).drop("source_path")
    check_tables(spark, root, rows, tmp)
    journal.load(rows, f"{tmp}/batch", run_ts=trips.RUN_TS)
    for name in journal.TABLES:
        assert stored(journal.read(spark, f"{tmp}/batch", name)) == stored(journal.read(spark, root, name))


def test_tables_by_name(spark, staged, tmp):
    db = "trips_by_name"
    catalog.drop_tables(spark, db)
    assert catalog.create_tables(spark, db, tmp) == list(catalog.FOLDERS)
    assert catalog.create_tables(spark, db, tmp) == []  # the second time nothing happens
    load = model.conform_schema(staged, keep=("source_part",))
    catalog.append(load.where("source_part = '00'"), f"{db}.tripdata_tmp")
    catalog.append(load.where("source_part <> '00'"), f"{db}.tripdata_tmp")
    catalog.fill_model(spark, db, trips.RUN_TS)
    assert catalog.create_tables(spark, db, tmp) == []
    want = {t: load.count() for t in catalog.FOLDERS}
    assert {r["table_name"]: r["n_rows"] for r in catalog.row_counts(spark, db).collect()} == want
    assert {c.name for c in spark.catalog.listColumns(f"{db}.trips_data") if c.isPartition} == {"month"}
    # A null id stops the write; nothing of it shows, also not to a later session.
    points = model.pickup_points(load, trips.RUN_TS)
    bad = points.withColumn("custom_id", F.when(F.col("geohash") < "dr5rk", F.col("custom_id")))
    with pytest.raises(Exception, match="custom_id"):
        catalog.append(bad, f"{db}.trips_pickup")
    with pytest.raises(ValueError, match="has the columns"):
        catalog.append(points.drop("geom"), f"{db}.trips_pickup")
    catalog.drop_tables(spark, db)
    assert not spark.catalog.databaseExists(db)
    catalog.create_tables(spark, db, tmp)  # the files stay and are found again
    assert {r["table_name"]: r["n_rows"] for r in catalog.row_counts(spark, db).collect()} == want
    assert stored(spark.table(f"{db}.trips_pickup").drop("month")) == stored(points)
    catalog.drop_tables(spark, db)


def test_tables_by_name_fills_every_table(spark, tmp):
    """The query inserts all three model tables, not only the one that it returns."""
    small_lineitem(spark, tmp)
    got = queries.tables_by_name(spark, tmp)
    load = trips.load_table(spark, tmp)
    for name, want in model.model_tables(load, trips.RUN_TS).items():
        assert stored(spark.table(f"taxiframe.{name}").drop(model.FOLDER)) == stored(want), name
    assert spark.table(f"taxiframe.{catalog.LOAD_TABLE}").count() == got.count() == load.count() > 0
    catalog.drop_tables(spark, "taxiframe")


def test_columns_absent_by_file(spark, staged, tmp):
    rows = staged.select(*sinks.STAGED_COLUMNS).limit(6)
    rows.drop("improvement_surcharge", "VendorID", "pickup_geom").coalesce(1).write.parquet(f"{tmp}/old")
    gaps = rows.withColumns({"improvement_surcharge": F.lit(None).cast("double"), "VendorID": F.lit(None).cast("string")})
    gaps.coalesce(1).write.parquet(f"{tmp}/new")
    got = sinks.read_conformed(spark, [f"{tmp}/old", f"{tmp}/new"])
    assert got.columns == model.conform_schema(rows).columns
    kinds = {(r["improvement_surcharge"], r["VendorID"], r["pickup_geom"] == "POINT(0 0)") for r in got.collect()}
    assert kinds == {(0.0, ":", True), (None, None, False)}
    assert got.count() == 12 and dict(got.dtypes)["store_and_fwd_flag"] == "boolean"


def test_rebuilt_days_open_only_files_that_can_hold_them(spark):
    """Days far apart: a file between them that has none of them stays closed."""
    rows = [("a", "1995-01-01", "1995-01-31"), ("b", "1995-02-01", "1995-02-28"), ("c", "1995-03-01", "1995-03-31"),
            ("d", None, None)]
    index = spark.createDataFrame(rows, "file string, x string, y string").select(
        "file", F.col("x").cast("date").alias("min_pickup_day"), F.col("y").cast("date").alias("max_pickup_day"))
    days = [datetime.date(1995, 1, 31), datetime.date(1995, 3, 1)]
    kept = lambda values: sorted(r["file"] for r in file_index.holding(values, "pickup_day")(index).collect())
    assert kept(days) == ["a", "c"]
    assert kept([]) == []
