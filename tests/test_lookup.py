"""Lookup joins with code tables that are data, and the retention of the profile."""
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from taxiframe.operators import lookup, profile
from taxiframe.plans import inspect, trips


@pytest.fixture(scope="module")
def rows(spark):
    """A code that a third of the rows have, one that no table has, nulls."""
    data = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 5 == 0 else f"c{i % 50}") for i in range(3000)]
    return spark.createDataFrame(data, "n int, code string").repartition(6)


@pytest.fixture(scope="module")
def table(spark):
    data = [("hot", "the hot one"), (None, "nothing"), ("c7", "b"), ("c7", "a"), ("c8", None), ("c9", None), ("c9", "nine")]
    return spark.createDataFrame(data + [(f"c{i}", f"label {i}") for i in range(10, 40)], "key string, label string")


def expected(rows, table):
    labels = {}
    for key, label in table.collect():
        if key is not None and label is not None:
            labels[key] = min(labels.get(key, label), label)
    return sorted(((r["n"], r["code"], labels.get(r["code"], ":")) for r in rows.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, -1])
def test_lookup_both_ways(spark, rows, table, limit):
    got = lookup.lookup_join(rows, table, "code", "key", "label", "name", broadcast_bytes=limit)
    assert got.columns == ["n", "code", "name"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == expected(rows, table)
    plan = inspect.physical_plan(got)
    assert ("BroadcastHashJoin" in plan) == (limit > 0) and ("SortMergeJoin" in plan) == (limit < 0)


def test_hot_codes_are_dealt_over_parts(spark, rows, table):
    assert lookup.hot_codes(rows, F.col("code"), 4) == ["hot"]
    assert "hot" in lookup.hot_codes(rows, F.col("code")) and lookup.hot_codes(rows.limit(0), F.col("code")) == []
    dim = lookup.dimension(table, "key", "label").withColumnsRenamed({"code": "_dim_code", "label": "_dim_label"})
    joined = lookup._salted(rows, dim, F.col("code"), ["hot"], 8)
    parts = {r["_part"]: r["n"] for r in joined.where("code = 'hot'").groupBy("_part").agg(
        F.count("_dim_label").alias("n")).collect()}
    assert len(parts) == 8 and sum(parts.values()) == 1000 and max(parts.values()) < 200


def test_lookup_measures_the_table(spark, rows, table):
    dim = lookup.dimension(table, "key", "label")
    size = lookup.measured_bytes(dim)
    assert dim.count() * 32 < size < dim.count() * 60
    assert lookup.measured_bytes(dim.limit(0)) == 0
    empty = lookup.lookup_join(rows, table.limit(0), "code", "key", "label", "name", broadcast_bytes=-1)
    assert empty.where("name = ':'").count() == rows.count() == empty.count()
    with pytest.raises(ValueError):
        lookup.lookup_join(rows, table, "code", "key", "label", "n")


def test_profile_retention_ends_with_the_clean_rows(spark):
    typed = profile.typed(trips.raw(spark, SF01)).cache()
    got = {r["rule"]: r for r in profile.profile_retention(typed).collect()}
    assert [r["step"] for r in got.values()] == [0, 1, 2, 3, 4]
    assert got["raw"]["rows_left"] == 60000 and got["quantile_trim"]["rows_left"] == 54378
    assert got["zero_amount"]["rows_left"] == profile.clean_typed(typed).count() == 35895
    assert got["duration"]["share_kept"] == round(got["duration"]["rows_left"] / 54378, 6)
    empty = profile.profile_retention(typed.limit(0)).collect()
    assert [(r["rows_left"], r["share_left"]) for r in empty] == [(0, None)] * 5
