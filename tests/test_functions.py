"""Scalar column functions on the edge values of FIXTURES section 4."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from taxiframe.functions import codes, datetimes, geo, numbers


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_numbers_as_python_literals(spark):
    vals = ["10", "1.50", "007", "", None, "0.5.1", "1e3", "nan", "5d", "00", "-5"]
    assert one_col(spark, vals, numbers.parse_number) == \
        [10.0, 1.5, 0.0, 0.0, 0.0, 0.0, 1000.0, 0.0, 0.0, 0.0, -5.0]
    assert one_col(spark, vals, numbers.number_text) == \
        ["10", "1.5", "0", "0", "0", "0", "1000.0", "0", "0", "0", "-5"]


@pytest.mark.parametrize("text", ["15300000.0", "1e7", "1.5e15", "1e16", "1.5e16", "123456789.25", "0.0001", "0.00005",
                                  "1e-7", "1e300", "2.5e-10", "100.", ".5", "1e22", "0.001"])
def test_number_text_is_what_python_prints(spark, text):
    assert one_col(spark, [text], numbers.number_text) == [repr(float(text))]


def test_integer_text_of_any_length(spark):
    vals = ["1" * 45, "-12", "+7", "000", "-0", "10000000"]
    assert one_col(spark, vals, numbers.number_text) == ["1" * 45, "-12", "7", "0", "0", "10000000"]


def test_float_parse_accepts_what_float_accepts(spark):
    vals = ["-73.9", "007", "nan", "-inf", "0.5.1", "5d", None]
    out = one_col(spark, vals, numbers.parse_float)
    assert out[0] == -73.9 and out[1] == 7.0 and out[2] != out[2]
    assert out[3] == float("-inf") and out[4:] == [None, None, None]


def test_coordinates_round_to_7_and_fail_to_zero(spark):
    vals = ["-73.12345678", "-73.9.1", None, "40.7"]
    assert one_col(spark, vals, geo.parse_coord) == [-73.1234568, 0.0, 0.0, 40.7]


def test_wkt_text(spark):
    df = spark.createDataFrame([(-73.7, 40.55), (-86.0, 50.0), (0.0, 40.7)], "lon double, lat double")
    got = [r[0] for r in df.select(geo.wkt_point("lon", "lat")).collect()]
    assert got == ["POINT(-73.7 40.55)", "POINT(-86.0 50.0)", "POINT(0.0 40.7)"]


@pytest.mark.parametrize("lon,lat,expected", [
    (10.40744, 57.64911, "u4pruyd"), (-5.6, 42.6, "ezs42e4"), (-73.98, 40.75, "dr5rud3"),
    (0.0, 0.0, "s000000"), (180.0, 90.0, "zzzzzzz"), (200.0, 0.0, None)])
def test_geohash_vectors(spark, lon, lat, expected):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    assert df.select(geo.geohash("lon", "lat", 7)).first()[0] == expected


def test_geohash_prefix_property(spark):
    df = spark.createDataFrame([(-73.98 + i * 0.37, 40.75 - i * 0.21) for i in range(50)],
                               "lon double, lat double")
    hashes = df.select(*[geo.geohash("lon", "lat", p).alias(f"g{p}") for p in range(1, 13)]).collect()
    for row in hashes:
        for p in range(1, 12):
            assert row[f"g{p + 1}"].startswith(row[f"g{p}"])
    assert hashes[0]["g12"].startswith("dr5rud3")


def test_datetimes(spark):
    vals = ["2015-4-1 1:2:3", "2015-02-30 01:02:03", "2015/04/01 00:00:00", "2015-04-01 00:00:00.5"]
    got = one_col(spark, vals, datetimes.parse_datetime)
    assert got[0] == datetime(2015, 4, 1, 1, 2, 3) and got[1:] == [None, None, None]


def test_minutes_truncate(spark):
    df = spark.createDataFrame([("2015-04-01 00:00:59", "2015-04-01 00:02:58")], "a string, b string")
    m = df.select(datetimes.minutes_between(datetimes.parse_datetime("a"),
                                            datetimes.parse_datetime("b"))).first()[0]
    assert m == 1


def test_codes_and_flag(spark):
    assert one_col(spark, ["1", "99", None], lambda c: codes.decode("RateCodeID", c)) == \
        ["standard_rate", ":", ":"]
    assert one_col(spark, ["Y", "N", "x"], codes.flag_code) == [1, 0, None]
    assert one_col(spark, ["Y", "N", "x"], codes.flag_to_bool) == [True, False, None]


def test_passenger_rounding_half_away(spark):
    assert one_col(spark, [2.5, -2.5, 1.4], numbers.round_half_away, "double") == [3, -3, 1]


def test_role_selectors():
    from taxiframe import schemas
    assert schemas.COORDINATES == ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
    assert schemas.DATETIMES == ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    assert schemas.CODES == ["VendorID", "RateCodeID", "store_and_fwd_flag", "payment_type"]
    assert schemas.geometry_columns(["a_geom", "b"]) == ["a_geom"]
    assert schemas.nonzero_amount_columns(schemas.RAW_COLUMNS) == [
        "passenger_count", "trip_distance", "fare_amount", "total_amount"]


def test_coordinate_text_is_that_of_the_decimal(spark):
    vals = [-73.7, -86.0, 0.0, -0.0, 0.001, 0.0009999, 0.0001, -1e-7, 4e-8, 5e-8, 999.9999999, 999.99999994, 999.99999996,
            1000.0, -1000.0, 1e7, -179.9999999, 40.5500001, 0.12345675, 0.12345665, -73.70000004, 12.3456789, None,
            float("nan"), float("inf"), 1e300]
    vals += [round(i * 0.0370001 - 180, 7) for i in range(0, 9000, 13)]

    def by_decimal(c):
        t = c.try_cast("decimal(10,7)").cast("string")
        return F.regexp_replace(F.regexp_replace(t, r"0+$", ""), r"\.$", ".0")

    assert one_col(spark, vals, geo.coord_text, "double") == one_col(spark, vals, by_decimal, "double")


def test_plain_coordinates_are_written_without_a_decimal(spark):
    """The common case is decided before the decimal route, which takes ten times as long."""
    plan = spark.range(1).select(geo.coord_text(F.col("id") / 8))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("decimal(10,7)")
