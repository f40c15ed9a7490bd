"""Profile toolkit: exact quantiles against pandas, trim / duration goldens."""
import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01
from taxiframe.operators import profile, quantiles
from taxiframe.plans import trips


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"a": rng.normal(size=3001).round(3),
                        "b": np.concatenate([np.full(1000, 5.0), rng.integers(0, 50, 2001)]).astype(float)})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.02, 0.5, 0.98, 1.0, 0.333]
    got = {(r["name"], r["p"]): r["value"]
           for r in quantiles.exact_quantiles(df, ["a", "b"], probs).collect()}
    for c in ["a", "b"]:
        for p in probs:
            assert abs(got[(c, p)] - pdf[c].quantile(p)) < 1e-9, (c, p)


def test_quantile_trim_golden(spark):
    typed = profile.typed(trips.raw(spark, SF01))
    assert profile.quantile_trim(typed).count() == 54378


def test_duration_and_unknown_codes(spark):
    st = trips.staged(spark, SF01)
    assert st.filter(profile.duration_ok()).count() == 56760
    assert st.filter(F.col("VendorID") == ":").count() == 580
    assert st.filter(F.col("RateCodeID") == ":").count() == 8068


def test_retention_is_monotone(spark):
    rows = profile.stage_retention(trips.classified(spark, SF01)).orderBy("step").collect()
    left = [r["rows_left"] for r in rows]
    assert left[0] == 60000 and left[-1] == 56776
    assert all(a >= b for a, b in zip(left, left[1:]))


def test_approximate_trim_is_close(spark):
    typed = profile.typed(trips.raw(spark, SF01))
    approx = profile.quantile_trim(typed, exact=False).count()
    assert abs(approx - 54378) <= 0.01 * 60000


def test_quantiles_leave_out_what_is_not_finite(spark):
    vals = [float("nan")] * 10 + [float("inf")] * 6 + [float("-inf")] * 6 + [None] * 5
    rng = np.random.default_rng(3)
    good = [float(x) for x in rng.normal(size=100)] + [1e300, -1e300, 5e-324]
    df = spark.createDataFrame([(v, 7.0, None) for v in vals + good], "a double, b double, c double")
    got = quantiles.quantiles(df, ["a", "b", "c"], [0.02, 0.98])
    for p in (0.02, 0.98):
        assert got["a", p] == pytest.approx(pd.Series(good).quantile(p), rel=1e-12)
        assert got["b", p] == 7.0 and got["c", p] is None
    assert quantiles.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_trim_of_empty_and_dirty_rows(spark):
    typed = profile.typed(trips.raw(spark, SF01).limit(0))
    assert profile.quantile_trim(typed).count() == 0
    df = spark.createDataFrame([(-73.0 - i / 100, 40.0, -73.0, 40.0 + i / 100) for i in range(50)]
                               + [(None, 40.0, -73.0, 40.0)], "pickup_longitude double, pickup_latitude double, "
                               "dropoff_longitude double, dropoff_latitude double")
    kept = profile.quantile_trim(df)
    assert 44 <= kept.count() <= 48 and kept.where("pickup_longitude IS NULL").count() == 0


def test_missing_values_are_nulls(spark):
    row = trips.raw(spark, SF01).first().asDict()
    rows = [{**row, "passenger_count": None, "trip_distance": ""}] * 10 + [{**row, "passenger_count": "0"}]
    typed = profile.typed(spark.createDataFrame(rows, trips.raw(spark, SF01).schema))
    nulls = {r["column"]: r["n_null"] for r in profile.null_counts(typed, ["passenger_count", "trip_distance"]).collect()}
    assert nulls == {"passenger_count": 10, "trip_distance": 10}
    zeros = {r["column"]: r["n_zero"] for r in profile.zero_counts(typed, ["passenger_count"]).collect()}
    assert zeros == {"passenger_count": 1}
