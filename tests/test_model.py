"""Model tables, joins, aggregates and top-k: golden values and plan shape."""
from pyspark.sql import functions as F

from conftest import SF001, SF01
from taxiframe.operators import analytics, model
from taxiframe.plans import inspect, trips


def test_join_and_zone_counts(spark):
    data, pickup = trips.data(spark, SF01), trips.pickup(spark, SF01)
    j = analytics.join_trip_points(data, pickup, "pickup_timestmp")
    assert j.count() == 56790
    zones = analytics.avg_tip_by_zone(data, pickup)
    assert zones.count() == 1679
    assert zones.agg(F.sum("n_trips")).first()[0] == 56790


def test_avg_fare_per_mile_golden(spark):
    assert analytics.avg_fare_per_mile(trips.data(spark, SF01)).first()[0] == 12.563


def test_top10_golden_and_plan(spark):
    top = analytics.top10_pickup_zones(trips.data(spark, SF01), trips.pickup(spark, SF01))
    rows = [(r["geohash"], r["avg_tip"]) for r in top.collect()]
    assert rows == [("sp200j0", 11.51), ("sp0p2p2", 10.93), ("sp0n8p0", 9.776), ("sp0p0p8", 9.32),
                    ("dr5x9b9", 9.047), ("dr5x6ee", 9.043), ("dr5rzxf", 8.946), ("dr5rnxe", 8.933),
                    ("dr5x9mf", 8.9), ("dr5xf87", 8.873)]
    assert "TakeOrderedAndProject" in inspect.physical_plan(top)


def test_zone_average_never_builds_pairs(spark):
    """The per-zone average joins one row per key on the data side, so a key
    repeated k times on both sides costs k + k rows, not k * k."""
    d = spark.createDataFrame([("x", 1, 2.0)] * 50 + [("y", 2, 4.0)],
                              "custom_id string, t int, tip double")
    data = d.select("custom_id", F.col("t").cast("timestamp").alias("pickup_timestmp"),
                    F.struct(F.col("tip").alias("tip")).alias("amount_details"))
    p = spark.createDataFrame([("x", 1, "g1")] * 40 + [("x", 1, "g2")] * 10 + [("y", 2, "g1")],
                              "custom_id string, t int, geohash string")
    pickup = p.select("custom_id", F.col("t").cast("timestamp").alias("timestmp"), "geohash")
    got = {r["geohash"]: (r["avg_tip"], r["n_trips"])
           for r in analytics.avg_tip_by_zone(data, pickup).collect()}
    # g1: 50*40 pairs of tip 2 + 1 pair of tip 4; g2: 50*10 pairs of tip 2.
    assert got == {"g1": (round((2000 * 2 + 4) / 2001, 3), 2001), "g2": (2.0, 500)}


def zone_input(spark, data, points):
    d = spark.createDataFrame(data, "custom_id string, t int, tip double")
    p = spark.createDataFrame(points, "custom_id string, t int, geohash string")
    return (d.select("custom_id", F.col("t").cast("timestamp").alias("pickup_timestmp"),
                     F.struct(F.col("tip").alias("tip")).alias("amount_details")),
            p.select("custom_id", F.col("t").cast("timestamp").alias("timestmp"), "geohash"))


def test_zone_average_rounds_once(spark):
    """2001000.99 over 2000001 pairs is 1.00049999..., which is 1.0."""
    data, pickup = zone_input(spark, [("x", 1, 1.0)] * 2001 + [("y", 2, 1002.99)], [("x", 1, "g")] * 1000 + [("y", 2, "g")])
    got = analytics.avg_tip_by_zone(data, pickup).first()
    exact = (2001 * 1000 * 100 + 100299) / 100 / 2001001
    assert got["n_trips"] == 2001001 and got["avg_tip"] == round(exact, 3)
    data, pickup = zone_input(spark, [("x", 1, 1.0)] * 2000 + [("y", 2, 1000.99)], [("x", 1, "g")] * 1000 + [("y", 2, "g")])
    assert analytics.avg_tip_by_zone(data, pickup).first()["avg_tip"] == 1.0  # 2001000.99 / 2000001
    data, pickup = zone_input(spark, [("x", 1, 0.01), ("x", 1, 0.0)], [("x", 1, "g")])
    assert analytics.avg_tip_by_zone(data, pickup).first()["avg_tip"] == 0.005


def test_zone_average_of_dirty_tips(spark):
    data, pickup = zone_input(spark, [("x", 1, 1e17), ("x", 1, float("inf")), ("x", 1, 2.0), ("y", 2, 1e17)],
                              [("x", 1, "g"), ("y", 2, "h")])
    got = {r["geohash"]: (r["avg_tip"], r["n_trips"]) for r in analytics.avg_tip_by_zone(data, pickup).collect()}
    assert got == {"g": (float("inf"), 3), "h": (1e17, 1)}  # no amount is left out
    data, pickup = zone_input(spark, [("x", 1, 1e15), ("x", 1, 2.0), ("x", 1, None), ("y", 2, 4.0)],
                              [("x", 1, "g"), ("y", 2, "h")])
    got = {r["geohash"]: (r["avg_tip"], r["n_trips"]) for r in analytics.avg_tip_by_zone(data, pickup).collect()}
    assert got == {"g": (5e14 + 1, 3), "h": (4.0, 1)}


def test_zone_average_has_three_exchanges(spark):
    data, pickup = trips.data(spark, SF01), trips.pickup(spark, SF01)
    plan = analytics.avg_tip_by_zone(data, pickup)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_model_write_is_pruned_by_day(spark, tmp):
    load = trips.load_table(spark, SF001).where("tpep_pickup_datetime < '1995-03'").cache()
    for _ in range(2):  # rerun: the same folders are replaced, not appended to
        paths = model.write_model(load, tmp + "/model", trips.RUN_TS)
    for name, path in paths.items():
        assert spark.read.parquet(path).count() == load.count(), name
    pick = spark.read.parquet(paths["trips_pickup"])
    row = pick.select("day", "month").first()
    one_day = pick.filter((F.col("day") == row["day"]) & (F.col("month") == row["month"]))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "EqualTo(day," in plan
    # Days are not scattered: a file holds adjacent days of one month.
    files = pick.groupBy("_metadata.file_path", "month").agg(F.min("day").alias("a"), F.max("day").alias("b")).collect()
    ranges = sorted((r["a"], r["b"]) for r in files)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_tasks_of_a_write(spark):
    assert model.write_parts(spark, 0) == 1 and model.write_parts(spark, 3 << 20) == 3
    assert model.write_parts(spark, 100 << 40) == (100 << 40) // model.TASK_BYTES


def test_created_at_defaults_to_today(spark):
    row = model.pickup_points(trips.load_table(spark, SF001).limit(1)).select("created_at", F.current_date()).first()
    assert row[0].date() == row[1]


def test_conform_schema_defaults(spark):
    df = spark.createDataFrame([("a", 1.5)], "id string, trip_distance double")
    row = model.conform_schema(df).first().asDict()
    assert row["id"] == "a" and row["trip_distance"] == 1.5
    assert row["VendorID"] == ":" and row["store_and_fwd_flag"] is False
    assert row["fare_amount"] == 0.0 and row["pickup_geom"] == "POINT(0 0)"
