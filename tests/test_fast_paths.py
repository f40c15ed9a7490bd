"""Texts in the usual form take short ways; all texts give what the long ways give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from taxiframe.functions import datetimes, geo, numbers
from taxiframe.sources import file_index
from taxiframe.streaming import incremental


def number_texts(n=20_000):
    rnd = random.Random(7)
    odd = ["", " ", ".", "+", "-", "-0", "-0.0", "0", "00", "007", "007.5", "5.", ".5", "-.5", "+5", "1.2.3", "1e5", "1e400",
           "9" * 19, "9" * 20, "0x1p3", "0x1.8p1", "1d", "1.5f", "nan", "-inf", "Infinity", "1_0", "\t1", "1\t", "1.5\x01", "1 ",
           "12345678.1234567", "0.0001", "0.00005", "0.001", "10.0", "10.50", "1.00000005", "-73.9749999949", "1000000.5",
           "123456789012345.5", "0.1234567890123456", "٣", "1٣", "15300000.0", "1.5\n", "7\n"]
    usual = [f"{rnd.choice(['', '-'])}{rnd.randrange(200)}.{rnd.randrange(10 ** rnd.randrange(1, 12))}" for _ in range(n // 2)]
    return odd + usual + ["".join(rnd.choices("0123456789.+-eEdxnaf _\t", k=rnd.randrange(1, 9))) for _ in range(n // 2)]


def same(frame, **pairs):
    """Columns that are equal to the bit, null where the other is null."""
    differ = {k: ~a.cast("string").eqNullSafe(b.cast("string")) for k, (a, b) in pairs.items()}
    for name, condition in differ.items():
        assert frame.where(condition).limit(5).collect() == [], name


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "t")
    spark.createDataFrame([(t,) for t in [*number_texts(), None]], "t string").write.parquet(path)
    return spark.read.parquet(path)


def test_rounding_keeps_what_is_rounded(texts, spark):
    values = texts.select(F.col("t").try_cast("double").alias("v")).unionAll(spark.range(100_000).select(
        (F.col("id") / 1000).alias("v"))).unionAll(spark.createDataFrame([(x,) for x in (
            -0.0, 1.005, 2.675, 1e300, -1e17, 4503599627370497.5, float("nan"), float("inf"), -float("inf"))], "v double"))
    same(values, two=(numbers.round_to(F.col("v"), 2), F.round("v", 2)), seven=(numbers.round_to(F.col("v"), 7), F.round("v", 7)))


def test_times_without_formats(spark, tmp_path):
    rnd = random.Random(3)
    odd = ["2015-04-01 00:00:00", "2015-4-1 0:0:0", "2015-02-30 00:00:00", "2015-04-01 24:00:00", "2015-04-01 00:00:60", "0000-01-01 00:00:00",
           "2015-04-01T00:00:00", "2015-04-01 00:00+08", "2015-4-01 00:00:00Z", "2015-04-01 00:00:5Z", "2015-04-01 0:0+8:00", "2015-4-1 0:0:0+1:00",
           "2015-4-1 00:00:00.1", "12015-4-01 00:00:00", "+2015-4-1 00:00:00", "2015/04/01 00:00:00", "2015-04-01 00:00:5 ", " 015-04-01 00:00:00",
           "2015-4-01 000:00:00", "2015-04-01 00:+1:00", "2015-04-01 00:00:.5", "9999-12-31 23:59:59", "0001-01-01 00:00:00", "2015-04-01 00:00:00\n", "", None]
    usual = [f"{rnd.randrange(1, 9999):04d}-{rnd.randrange(14):02d}-{rnd.randrange(33):02d} {rnd.randrange(26):02d}:{rnd.randrange(62):02d}:30"
             for _ in range(5000)]
    cut = ["".join(c if rnd.random() < 0.95 else rnd.choice("0 :-+TZ.") for c in t) for t in usual]
    spark.createDataFrame([(t,) for t in odd + usual + cut], "t string").write.parquet(f"{tmp_path}/t")
    times = spark.read.parquet(f"{tmp_path}/t")
    same(times, time=(datetimes.parse_datetime("t"), F.try_to_timestamp("t", F.lit(datetimes.PARSE_FORMAT))))
    assert times.where(F.col("t").rlike(datetimes.CANONICAL_TEXT)).count() > 4000


def test_plain_amounts_and_coordinates(texts, spark):
    """Amounts and coordinates in the usual form are read without the long expressions."""
    more = spark.createDataFrame([(f"{i}.{j}",) for i in (0, 1, 10, 250, 999, 1000, 999999999, 1234567890)
                                  for j in ("0", "00", "5", "50", "05", "0005", "0001", "0000", "00005", "1234567", "12345678")], "t string")
    coords = spark.createDataFrame([(f"{s}{t}",) for s in ("", "-") for t in ("0", "0.0", "73.9749999", "73.97499995", "86", "180", "0.5", "40.",
                                                                            "007.5", "100.0000000", "1000.5", "73.9 ", "5.0000001")], "t string")
    all_texts = texts.unionAll(more).unionAll(coords)
    c = F.trim("t")
    value = F.when(F.col("t").rlike(numbers.LITERAL_TEXT), c.try_cast("double"))
    long_text = (F.when(c.rlike(numbers.INT_TEXT), numbers.int_text(c))
                 .when(c.rlike(numbers.LITERAL_TEXT), numbers.float_text(c.try_cast("double"))).otherwise(F.lit("0")))
    rounded = F.round(numbers.parse_float("t"), geo.COORD_DIGITS)
    same(all_texts, number=(numbers.try_number("t"), F.when(F.abs(value) < F.lit(float("inf")), value)),
         text=(numbers.number_text("t"), long_text),
         coord=(geo.parse_coord("t"), F.coalesce(rounded, F.lit(0.0))),
         finite=(geo.finite_coord("t"), F.when(geo.is_finite(rounded), rounded)))
    for reads in (numbers.try_number, numbers.number_text, geo.parse_coord, geo.finite_coord):
        plan = all_texts.select(reads("t"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("9]{") < plan.index("9]*"), reads  # the short form is tried first


def test_parts_of_files(spark):
    """The part of a path, as regular expressions over the whole path give it."""
    paths = spark.createDataFrame([(p,) for p in (
        "file:/a/source_file=y_1995-01_02.csv.zip/part-0.txt", "/a/source_file=/x.txt", "source_file=b/x.txt", "/source_file=b/x.txt", "x.csv.zip",
        "/a/x.csv", "/a/x.txt", "/a/.csv.gz", "/a/source_file=b.csv/c/x.gz", "/source_file=q/source_file=/x.csv", "/a/source_file=a=b.zip/x", "", None)], "p string")
    named = F.regexp_extract("p", r"/source_file=([^/]+)/[^/]*$", 1)
    name = F.when(named != "", named).otherwise(F.regexp_extract("p", r"([^/]+)$", 1))
    same(paths, part=(incremental.part_of_file(F.col("p")), F.regexp_replace(name, r"(\.csv)?(\.zip|\.txt|\.gz)?$", "")))


def test_index_names_are_made_of_groups(spark, tmp_path):
    """A file's name is made once, not for each of its rows."""
    spark.range(100).selectExpr("id", "id % 3 AS day").write.parquet(f"{tmp_path}/t/month=a+b c")
    found = file_index.entries(spark.read.parquet(f"{tmp_path}/t/month=a+b c"), "day", {"id": F.col("id")})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" in plan and "substring_index" not in plan[plan.index("Project"):]
    assert {r["file"].split("/")[0] for r in found.collect()} == {"month=a+b c"}
    assert found.agg({"n_rows": "sum"}).first()[0] == 100 and found.columns == ["file", "part", "n_rows", "min_id", "max_id"]
