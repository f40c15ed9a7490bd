"""Lazy builders of the trip tables from a folder of driver tables.

Each function returns an unexecuted DataFrame; nothing is collected. The model
tables here are projections of the load table computed on the fly; the
writers in ``taxiframe.operators.model`` / ``taxiframe.sources.sinks``
materialize them as partitioned Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxiframe.operators import clean, model
from taxiframe.sources.derived import raw_trips

#: Load time used by the registered queries so their outputs are repeatable
#: (``created_at`` is midnight of this instant, UTC).
RUN_TS = "2024-01-15 13:45:00"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips(spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.classify(raw(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.staged_view(classified(spark, sf_dir))


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tripdata_tmp``: staged trips conformed to the load schema."""
    return model.conform_schema(staged(spark, sf_dir))


def pickup(spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS) -> DataFrame:
    return model.pickup_points(load_table(spark, sf_dir), run_ts)


def dropoff(spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS,
            compat: bool = False) -> DataFrame:
    return model.dropoff_points(load_table(spark, sf_dir), run_ts, compat)


def data(spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS) -> DataFrame:
    return model.trip_data(load_table(spark, sf_dir), run_ts)
