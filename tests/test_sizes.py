"""Tasks of a bounded size, and one open file per task."""

from __future__ import annotations

import datetime
import os

from pyspark.sql import functions as F

from taxiframe import queries, session
from taxiframe.operators import model
from taxiframe.plans import warehouse
from taxiframe.schemas import RAW_COLUMNS
from taxiframe.sources import derived, files, sinks


def test_large_tables_have_more_landing_files(spark):
    rows = spark.range(derived.LANDING_ROWS * 10 + 1).coalesce(1)
    assert derived.landing_parts(rows) == max(11, spark.sparkContext.defaultParallelism)


def test_sorted_rows_are_written_with_one_open_file(spark, tmp_path):
    """Open files hold their rows in memory, so a write by folder has one."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    assert spark.conf.get(key) == "0"
    with session.open_files(spark, 2):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == "0"
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), "id")
    model.write_table(rows, f"{tmp_path}/t", F.col("k"), ["k", "id"], 1)
    got = spark.read.parquet(f"{tmp_path}/t")
    assert got.count() == 1000 and len(got.inputFiles()) == 7


def test_stage_write_is_not_sorted(spark, tmp_path):
    """Accepted and rejected lines go to two open files, whatever the session says."""
    raw = spark.createDataFrame([(None,) * 19], ", ".join(f"{c} string" for c in sinks.RAW_COLUMNS))
    sinks.write_stage(raw, f"{tmp_path}/s")
    assert sinks.read_quarantine(spark, f"{tmp_path}/s").count() == 1


def test_scans_are_narrow_for_trips_only(spark):
    key, size = session.SCAN_BYTES
    session.narrow_scans(spark, False)  # as the session began, whatever ran before
    before = spark.conf.get(key)
    session.narrow_scans(spark, True)
    session.narrow_scans(spark, True)
    assert spark.conf.get(key) == size
    session.narrow_scans(spark, False)
    assert spark.conf.get(key) == before


LINEITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp"


def small_lineitem(spark, path, n=60):
    """Rows of three months, one of them twice, one with null keys."""
    rows = [(i, 3 * i, 5 * i, i % 7, datetime.datetime(1995, 1 + i % 3, 1 + i % 28)) for i in range(n)]
    rows += [rows[0], (None, None, None, 1, datetime.datetime(1995, 1, 1))]
    spark.createDataFrame(rows, LINEITEM).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_raw_files_come_from_narrow_rows(spark, tmp_path):
    """Rows are dealt to the raw files before their lines are made: the landing
    table is neither built nor shuffled for it, and the lines are those it has."""
    sf_dir = small_lineitem(spark, tmp_path)
    before = set(os.listdir(session.shared_dir(spark).removeprefix("file:")))
    root = warehouse.raw_files(spark, sf_dir)
    new = set(os.listdir(session.shared_dir(spark).removeprefix("file:"))) - before
    assert not [f for f in new if f.startswith("landing")]
    got = files.read_raw(spark, f"{root}/source_file=*", base_path=root).select(*RAW_COLUMNS, "source_file")
    want = derived.raw_trips(spark, sf_dir)
    rows = lambda df: sorted(tuple(str(v or "") for v in r) for r in df.collect())
    # A row of no file is in the folder of the null name.
    assert [r[:-1] for r in rows(got)] == [r[:-1] for r in rows(want.select(*RAW_COLUMNS, "source_file"))]


def test_only_the_named_files_are_staged(spark, tmp_path):
    sf_dir = small_lineitem(spark, tmp_path)
    name = derived.raw_trips(spark, sf_dir).where("source_file LIKE '%1995-02%'").first()["source_file"]
    part = name.removesuffix(files.ZIP_SUFFIX)
    staged = queries._stage_files(spark, sf_dir, f"{tmp_path}/staged", [part])
    lines = spark.read.parquet(f"{tmp_path}/staged")
    assert [r[0] for r in lines.select("source_file").distinct().collect()] == [name]
    whole = queries._staged_parts(spark, sf_dir).where(F.col("source_part") == part)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(staged) == rows(whole)


def test_staging_some_files_reads_these_files(spark, tmp_path):
    """A batch opens the raw files that it takes: no landing table is built for it."""
    sf_dir = small_lineitem(spark, tmp_path, 61)
    root = warehouse.raw_files(spark, sf_dir)
    name = sorted(f for f in os.listdir(root.removeprefix("file:")) if "1995-02" in f)[0].removeprefix("source_file=")
    before = set(os.listdir(session.shared_dir(spark).removeprefix("file:")))
    staged = queries._stage_files(spark, sf_dir, f"{tmp_path}/staged", [name.removesuffix(files.ZIP_SUFFIX), "no_such_part"])
    new = set(os.listdir(session.shared_dir(spark).removeprefix("file:"))) - before
    assert not [f for f in new if f.startswith("landing")]
    assert {r[0] for r in staged.select("source_part").distinct().collect()} <= {name.removesuffix(files.ZIP_SUFFIX)}
