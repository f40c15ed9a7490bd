"""File layer: edge lines through the real reader, globs, manifest, zip, stream."""
import os
import random
import zipfile

from pyspark.sql import functions as F

from taxiframe.operators import clean
from taxiframe.schemas import RAW_COLUMNS
from taxiframe.sources import files, sinks, zipped
from taxiframe.streaming import incremental

GOOD = ["1", "2015-04-01 00:00:00", "2015-04-01 00:10:00", "1", "1.50", "-73.98", "40.75", "1",
        "N", "-73.95", "40.77", "1", "10", "0.5", "0.5", "2", "0", "0.3", "13.3"]


def line(fields):
    return "\t".join(fields)


def edge_lines():
    one_zero = GOOD.copy()
    one_zero[5] = "0"
    outlier = GOOD.copy()
    outlier[5], outlier[6] = "-86", "50"
    return [
        line(RAW_COLUMNS),                       # header inside a part
        "1\t2015-04-01 00:00:00",                # short line
        line(GOOD + ["extra"]),                  # long line
        "",                                      # blank line
        line(GOOD[:8] + ['"a\tb"'] + GOOD[9:]),  # quoted field holding a tab
        line(one_zero),                          # one coordinate 0: kept
        line(outlier),                           # outlier: kept by the ETL
    ]


def write_text(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_reader_edge_lines(spark, tmp):
    write_text(f"{tmp}/raw/yellow_tripdata_2015-04_00.csv", edge_lines())
    raw = files.read_raw(spark, f"{tmp}/raw")
    rows = raw.collect()
    assert len(rows) == 6  # blank line skipped
    assert rows[1]["VendorID"] == "1" and rows[1]["passenger_count"] is None
    assert rows[2]["total_amount"] == "13.3"
    assert rows[3]["store_and_fwd_flag"] == "a\tb"
    reasons = [r["reject_reason"] for r in clean.classify(raw).collect()]
    assert reasons == ["header", "zero_pickup", None, None, None, None]


def test_month_patterns_and_regex():
    assert files.month_patterns("/src/*.csv.zip", "2015-01|2015-02") == [
        "/src/yellow_tripdata_2015-01_*.csv.zip", "/src/yellow_tripdata_2015-02_*.csv.zip"]
    assert files.month_patterns("/src/*.csv.zip", None) == ["/src/yellow_tripdata_*.csv.zip"]
    import re
    rx = files.glob_regex("yellow_tripdata_2015-01_*.csv.zip")
    assert re.match(rx, "yellow_tripdata_2015-01_07.csv.zip")
    assert not re.match(rx, "yellow_tripdata_2015-01_07.csv")


def test_globs_reach_the_reader(spark, tmp):
    for m in ("2015-01", "2015-02", "2015-03"):
        write_text(f"{tmp}/src/yellow_tripdata_{m}_00.csv", [line(GOOD)])
    globs = files.month_patterns(f"{tmp}/src/*.csv", "2015-01|2015-03")
    df = files.read_raw(spark, globs, with_path=True)
    names = sorted(os.path.basename(r["source_path"]) for r in df.collect())
    assert names == ["yellow_tripdata_2015-01_00.csv", "yellow_tripdata_2015-03_00.csv"]


def test_manifest_and_new_files(spark, tmp):
    for name in ("yellow_tripdata_2015-04_00.csv.zip", "yellow_tripdata_2015-04_01.csv.zip",
                 "yellow_tripdata_2015-05_00.csv.zip", "notes.txt"):
        with open(f"{tmp}/{name}", "wb") as fh:
            fh.write(b"x" * 10)
    listing = files.list_files(spark, f"{tmp}/*")
    man = files.file_manifest(listing, "2015-04", root="gs://b")
    got = {r["name"]: (r["month"], r["part"], r["raw_path"]) for r in man.collect()}
    assert got == {"yellow_tripdata_2015-04_00": ("2015-04", "00", "gs://b/raw/yellow_tripdata_2015-04_00.csv"),
                   "yellow_tripdata_2015-04_01": ("2015-04", "01", "gs://b/raw/yellow_tripdata_2015-04_01.csv")}
    loaded = man.filter(F.col("part") == "00").select("file_name", "length", "modificationTime")
    new = files.new_files(man, loaded, ("file_name", "length", "modificationTime"))
    assert [r["part"] for r in new.collect()] == ["01"]


def make_zip(path, member, lines):
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(member, "\n".join(lines) + "\n")


def test_unzip_to_text_with_bad_archive(spark, tmp):
    os.makedirs(f"{tmp}/zips")
    make_zip(f"{tmp}/zips/yellow_tripdata_2015-04_00.csv.zip", "a.csv", [line(GOOD)] * 3)
    make_zip(f"{tmp}/zips/yellow_tripdata_2015-04_01.csv.zip", "b.csv", [line(GOOD)] * 2)
    with open(f"{tmp}/zips/x.csv.zip", "wb") as fh:
        fh.write(os.urandom(64))
    out = zipped.unzip_to_text(spark, f"{tmp}/zips/*.csv.zip", f"{tmp}/unzipped")
    raw = files.read_raw(spark, out["lines"])
    assert raw.count() == 5
    errors = spark.read.text(out["errors"]).collect()
    assert len(errors) == 1 and "x.csv.zip" in errors[0][0]
    inv = {os.path.basename(r["archive"]): r["n_entries"]
           for r in zipped.archive_inventory(spark, f"{tmp}/zips/*.csv.zip").collect()}
    assert inv == {"yellow_tripdata_2015-04_00.csv.zip": 1,
                   "yellow_tripdata_2015-04_01.csv.zip": 1, "x.csv.zip": None}


def test_broken_archives_give_no_lines(spark, tmp):
    """An archive that breaks after many lines gives one error row only."""
    os.makedirs(f"{tmp}/zips")
    rnd = random.Random(1)
    lines = [f"{rnd.random()}\t{i}" for i in range(100_000)]
    make_zip(f"{tmp}/zips/yellow_tripdata_2015-04_00.csv.zip", "a.csv", lines)
    whole = open(f"{tmp}/zips/yellow_tripdata_2015-04_00.csv.zip", "rb").read()
    for i, at in enumerate((len(whole) // 2, len(whole) * 3 // 4, len(whole) - 400)):
        broken = bytearray(whole)
        broken[at:at + 40] = bytes(40)
        with open(f"{tmp}/zips/yellow_tripdata_2015-05_0{i}.csv.zip", "wb") as fh:
            fh.write(broken)
    out = zipped.unzip_to_text(spark, f"{tmp}/zips/*.csv.zip", f"{tmp}/unzipped")
    assert spark.read.text(f"{out['lines']}/file=yellow_tripdata_2015-04_*").count() == 100_000
    assert spark.read.text(out["lines"]).count() == 100_000
    assert spark.read.text(out["errors"]).count() == 3


def test_restaging_replaces_both_sides(spark, tmp):
    write_text(f"{tmp}/raw/p0.csv", edge_lines())
    sinks.write_stage(files.read_raw(spark, f"{tmp}/raw"), f"{tmp}/staged")
    write_text(f"{tmp}/raw/p0.csv", [line(GOOD)] * 2)
    spark.catalog.clearCache()
    sinks.write_stage(files.read_raw(spark, f"{tmp}/raw"), f"{tmp}/staged")
    assert spark.read.parquet(f"{tmp}/staged").groupBy("status").count().collect() == [("staged", 2)]


def test_part_that_ends_empty_is_removed(spark, tmp):
    st = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("c", "p2")], "id string, source_part string")
    sinks.append_load(st, f"{tmp}/load")
    sinks.append_load(st.where("false"), f"{tmp}/load", parts=["p1"])
    assert [r["id"] for r in spark.read.parquet(f"{tmp}/load").collect()] == ["c"]


def test_one_pass_stage_sink(spark, tmp):
    write_text(f"{tmp}/raw/p0.csv", edge_lines())
    raw = files.read_raw(spark, f"{tmp}/raw")
    sinks.write_stage(raw, f"{tmp}/staged")
    assert sinks.read_staged(spark, f"{tmp}/staged").count() == 4
    q = sinks.read_quarantine(spark, f"{tmp}/staged").collect()
    assert sorted(r["reject_reason"] for r in q) == ["header", "zero_pickup"]


def test_load_append_rerun_replaces_part(spark, tmp):
    st = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("c", "p2")], "id string, source_part string")
    sinks.append_load(st, f"{tmp}/load")
    sinks.append_load(st.filter("source_part = 'p1'"), f"{tmp}/load")
    assert spark.read.parquet(f"{tmp}/load").count() == 3


def test_stream_picks_up_only_new_files(spark, tmp):
    write_text(f"{tmp}/in/a.csv", [line(GOOD)] * 2)
    ck = f"{tmp}/ck"
    incremental.stage_new_files(spark, f"{tmp}/in", f"{tmp}/out", checkpoint=ck)
    assert sinks.read_staged(spark, f"{tmp}/out").count() == 2
    write_text(f"{tmp}/in/b.csv", [line(GOOD)] * 3)
    incremental.stage_new_files(spark, f"{tmp}/in", f"{tmp}/out", checkpoint=ck)
    per_file = {os.path.basename(r["source_path"]): r["count"] for r in
                sinks.read_staged(spark, f"{tmp}/out", extra=["source_path"])
                .groupBy("source_path").count().collect()}
    assert per_file == {"a.csv": 2, "b.csv": 3}


def test_create_table_if_absent_and_raw_parquet(spark, tmp):
    df = spark.createDataFrame([("1", "x")], "VendorID string, id string")
    files.write_raw_parquet(df, f"{tmp}/rawpq")
    spark.sql(f"CREATE TABLE IF NOT EXISTS trips_raw_t USING parquet LOCATION '{tmp}/rawpq'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS trips_raw_t USING parquet LOCATION '{tmp}/rawpq'")
    assert spark.table("trips_raw_t").count() == 1
    spark.sql("DROP TABLE trips_raw_t")
