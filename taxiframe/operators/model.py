"""Load table and the three model tables (pickup points, dropoff points, trip data).

``conform_schema`` turns staged trips into the load table ``tripdata_tmp``;
``pickup_points``, ``dropoff_points`` and ``trip_data`` are projections of the
load table (no join). Tables are stored in month folders, in files sorted by day
and cluster keys: the file index (``sources.file_index``) and the statistics of
the files prune reads by day and key. Loads of some parts are in
``sources.journal``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.functions import datetimes, geo, numbers
from taxiframe.schemas import LOAD_DEFAULTS, LOAD_FIELDS
from taxiframe.session import storing

GEOHASH_PRECISION = 7
# --- fixed values: fields of the amounts struct and their sources --------------
AMOUNT_FIELDS = [("fare", "fare_amount"), ("extra", "extra"), ("mta", "mta_tax"),
                 ("tip", "tip_amount"), ("tolls", "tolls_amount"),
                 ("improvement_surcharge", "improvement_surcharge")]
# --- end of fixed values ------------------------------------------------------


def conform_schema(df: DataFrame, fields: list[tuple[str, str]] = LOAD_FIELDS,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to ``fields`` in order (B9): present columns are cast to the field
    type and keep their nulls; absent columns get the type's default. Columns
    named in ``keep`` (e.g. the source part) are carried along at the end."""
    present = set(df.columns)
    out = []
    for name, typ in fields:
        spark_type = "string" if typ == "geography" else typ
        if name in present:
            out.append(F.col(name).cast(spark_type).alias(name))
        else:
            out.append(F.lit(LOAD_DEFAULTS[typ]).cast(spark_type).alias(name))
    return df.select(*out, *keep)


def known_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep only the listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def _created_at(run_ts: str | Column | None) -> Column:
    """Midnight of the load time; of the current day where none is given."""
    return datetimes.midnight_of(F.current_timestamp() if run_ts is None else run_ts)


def point_table(load: DataFrame, time_col: str, point: str, run_ts: str | Column | None = None) -> DataFrame:
    """One geometry table: id, geohash-7 and WKT of ``point`` ('pickup' or
    'dropoff'), the time of ``time_col``, load day, partition day."""
    ts = datetimes.parse_datetime(time_col)
    return load.select(
        F.col("id").alias("custom_id"),
        geo.geohash(f"{point}_longitude", f"{point}_latitude", GEOHASH_PRECISION).alias("geohash"),
        F.col(f"{point}_geom").alias("geom"),
        ts.alias("timestmp"),
        _created_at(run_ts).alias("created_at"),
    ).withColumn("day", datetimes.day_of("timestmp"))


def pickup_points(load: DataFrame, run_ts: str | Column | None = None) -> DataFrame:
    """``trips_pickup``."""
    return point_table(load, "tpep_pickup_datetime", "pickup", run_ts)


def dropoff_points(load: DataFrame, run_ts: str | Column | None = None, compat: bool = False) -> DataFrame:
    """``trips_dropdown`` (A16): dropoff time with the dropoff point; with
    ``compat=True`` the pickup point, as the reference's insert does."""
    return point_table(load, "tpep_dropoff_datetime", "pickup" if compat else "dropoff", run_ts)


def trip_data(load: DataFrame, run_ts: str | Column | None = None) -> DataFrame:
    """``trips_data`` (A17): rounded amounts in a struct, minutes, times."""
    pickup = datetimes.parse_datetime("tpep_pickup_datetime")
    dropoff = datetimes.parse_datetime("tpep_dropoff_datetime")
    amounts = F.struct(*[numbers.round_to(F.col(src).cast("double"), 2).alias(name)
                         for name, src in AMOUNT_FIELDS])
    return load.select(
        F.col("id").alias("custom_id"),
        "VendorID", "RateCodeID",
        F.col("store_and_fwd_flag").cast("boolean").alias("store_and_fwd_flag"),
        "payment_type",
        numbers.round_half_away(F.col("passenger_count")).alias("passenger_count"),
        numbers.round_to(F.col("trip_distance").cast("double"), 2).alias("trip_distance"),
        amounts.alias("amount_details"),
        F.col("total_amount").cast("double").alias("amount_total"),
        datetimes.minutes_between(pickup, dropoff).cast("bigint").alias("trip_minutes"),
        pickup.alias("pickup_timestmp"),
        dropoff.alias("dropoff_timestmp"),
        _created_at(run_ts).alias("created_at"),
    ).withColumn("day", datetimes.day_of("pickup_timestmp"))


# --- fixed values: the cluster keys of the tables -----------------------------
MODEL_CLUSTER_KEYS = {
    "trips_pickup": ["geohash"],
    "trips_dropdown": ["geohash"],
    "trips_data": ["passenger_count", "trip_minutes"],
}
# --- end of fixed values ------------------------------------------------------


def sort_keys(name: str) -> list[str]:
    """Order inside a model table: day, cluster keys, and the time, which
    spreads many rows of one day and key over tasks."""
    time = "pickup_timestmp" if name == "trips_data" else "timestmp"
    return ["day", *MODEL_CLUSTER_KEYS[name], time]


#: Folders of a stored table: one for each month, so that their number stays
#: small beside that of the files; days are found by the file index and by the
#: statistics of the files, which are sorted by day.
FOLDER = "month"
#: Stored bytes that a task sorts and writes at most (some ten times as many in
#: memory, where they stay at any size of the table), and that one core takes
#: before another one shares the work.
TASK_BYTES, CORE_BYTES = 32 << 20, 1 << 20


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_parts(spark: SparkSession, n_bytes: int) -> int:
    """Tasks of a write of rows that take so many bytes."""
    shared = min(spark.sparkContext.defaultParallelism, n_bytes // CORE_BYTES)
    return max(1, shared, -(-n_bytes // TASK_BYTES))


def laid_out(df: DataFrame, month: Column, keys: list[str], parts: int) -> DataFrame:
    """``df`` with its folder, dealt by ranges of the month and the keys to
    ``parts`` tasks and sorted by them (A14): a file holds adjacent days, or a
    part of one day where a day is large, however the days are skewed."""
    if FOLDER in df.columns:
        raise ValueError(f"the table has a column {FOLDER!r}")
    order = [FOLDER, *keys]
    return df.withColumn(FOLDER, month).repartitionByRange(parts, *order).sortWithinPartitions(*order)


def write_table(df: DataFrame, path: str, month: Column, keys: list[str], parts: int, mode: str = "append") -> None:
    """Write rows as files of a stored table. The files count once the file
    index names them, so tasks may move their own files into place."""
    (laid_out(df, month, keys, parts).write.mode(mode).option("partitionOverwriteMode", "static")
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(FOLDER).parquet(path))


#: Stored bytes of rows that a write shuffles at once, and the rounds that a larger
#: write takes at most: the shuffle files of a round are gone before the next one.
ROUND_BYTES, MOST_ROUNDS = 64 << 20, 4


def rounds(n_bytes: int, most: int = MOST_ROUNDS) -> int:
    """Rounds of a write of rows that take so many bytes."""
    return max(1, min(most, -(-n_bytes // ROUND_BYTES)))


#: Stored bytes of rows up to which several tables are made of them side by side.
#: Beyond, one write keeps all cores busy, and its shuffle files alone are on disk.
SIDE_BYTES = 64 << 20


def table_by_table(write: Callable[[str], None], tables: dict[str, int], n_bytes: int) -> None:
    """``write(name)`` for each of ``tables`` (their numbers of columns), the widest
    first, for which rows of ``n_bytes`` are read."""
    names = sorted(tables, key=tables.__getitem__, reverse=True)
    with ThreadPoolExecutor(len(names) if n_bytes <= SIDE_BYTES else 1) as pool:
        for done in [pool.submit(write, name) for name in names]:
            done.result()


def model_tables(load: DataFrame, run_ts: str | Column | None = None,
                 compat_dropoff: bool = False) -> dict[str, DataFrame]:
    """The three model tables as projections of the load table."""
    return {
        "trips_pickup": pickup_points(load, run_ts),
        "trips_dropdown": dropoff_points(load, run_ts, compat_dropoff),
        "trips_data": trip_data(load, run_ts),
    }


#: The time of the load table that gives the day of a model table.
DAY_SOURCE = {
    "trips_pickup": "tpep_pickup_datetime",
    "trips_dropdown": "tpep_dropoff_datetime",
    "trips_data": "tpep_pickup_datetime",
}
#: Columns that must not be null.
REQUIRED = ("custom_id", "geohash")


def write_model(load: DataFrame, model_dir: str, run_ts: str | Column | None = None,
                compat_dropoff: bool = False, parts: int | None = None, n_bytes: int = 0) -> dict[str, str]:
    """Write the three model tables of the whole load table under ``model_dir``;
    returns their paths. One scan of ``load`` for each table (and one of its sort
    keys). ``parts``: tasks of a write (see :func:`write_parts`); ``n_bytes``: of
    the load table, as far as they are known (see :func:`table_by_table`)."""
    tables = model_tables(load, run_ts, compat_dropoff)
    paths = {name: f"{model_dir.rstrip('/')}/{name}" for name in tables}
    parts = parts or load.sparkSession.sparkContext.defaultParallelism

    def write(name: str) -> None:
        write_table(tables[name], paths[name], month_of(F.col("day")), sort_keys(name), parts, "overwrite")

    with storing(load.sparkSession):
        table_by_table(write, {n: len(df.columns) for n, df in tables.items()}, n_bytes)
    return paths
