"""Golden counts, invariants and plan shape of the staging chain."""
from pyspark.sql import functions as F

from conftest import SF01
from taxiframe.operators import clean
from taxiframe.plans import inspect, trips


def test_golden_counts(spark):
    raw = trips.raw(spark, SF01)
    assert raw.count() == 60000
    assert clean.drop_zero_points(raw).count() == 58463
    counts = {r["reject_reason"]: r["count"]
              for r in clean.classify(raw).groupBy("reject_reason").count().collect()}
    assert set(counts) == {None, *clean.REASONS}  # every reason occurs
    assert counts == {None: 56776, "header": 139, "coord_not_finite": 287, "zero_pickup": 1247,
                      "zero_dropoff": 146, "coord_out_of_range": 145, "bad_datetime": 573,
                      "pickup_after_dropoff": 548, "bad_passenger_count": 139}


def test_staging_does_not_run_as_one_huge_method(spark):
    """The JVM interprets methods above 8000 bytes; above the session's limit
    a stage runs as generated projections, whose methods are split."""
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    assert limit <= 8000


def test_staged_plus_quarantined_is_raw(spark):
    raw = trips.raw(spark, SF01)
    assert clean.stage_trips(raw).count() + clean.quarantine(raw).count() == raw.count()


def test_result_independent_of_partitioning(spark):
    raw = trips.raw(spark, SF01)

    def fingerprint(df):
        h = F.xxhash64(*df.columns) % 1000003
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h)).first())

    assert fingerprint(clean.stage_trips(raw)) == fingerprint(clean.stage_trips(raw.repartition(3)))


def test_staging_has_no_exchange_and_no_python(spark):
    st = clean.stage_trips(trips.raw(spark, SF01))
    st.write.format("noop").mode("overwrite").save()
    assert not inspect.has_exchange(st)
    assert not inspect.has_python(st)
