"""Registered queries: one per operator of the inventory, each ``(spark,
sf_dir) -> DataFrame`` over the trips derived from the folder's ``lineitem``.

Outputs use engine-neutral types: timestamps as TIMESTAMP_NTZ (UTC wall
clock), the ``amount_details`` struct flattened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.functions import codes, datetimes, geo, numbers
from taxiframe.operators import analytics, clean, lookup, model, profile
from taxiframe.plans import trips, warehouse
from taxiframe.schemas import COORDINATES, DATETIMES, NUMBERS, RAW_COLUMNS
from taxiframe.sources import catalog, files, folders, journal, sinks
from taxiframe.sources.derived import read_table
from taxiframe.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: datetimes.to_ntz(c) for c in cols})


# --- projections and scalar functions ----------------------------------------

@query
def parse_coords(spark, sf_dir):
    """B1 over every raw row."""
    return trips.raw(spark, sf_dir).select(*[geo.parse_coord(c).alias(c) for c in COORDINATES])


@query
def wkt_points(spark, sf_dir):
    """B2 over the rows that pass the zero-point filter."""
    raw = clean.drop_zero_points(trips.raw(spark, sf_dir))
    pc = {c: geo.parse_coord(c) for c in COORDINATES}
    return raw.select(
        geo.wkt_point(pc["pickup_longitude"], pc["pickup_latitude"]).alias("pickup_geom"),
        geo.wkt_point(pc["dropoff_longitude"], pc["dropoff_latitude"]).alias("dropoff_geom"))


@query
def trip_centroid(spark, sf_dir):
    """B3 over the rows that pass the zero-point filter."""
    raw = clean.drop_zero_points(trips.raw(spark, sf_dir))
    pc = {c: geo.parse_coord(c) for c in COORDINATES}
    return raw.select(
        geo.midpoint(pc["pickup_latitude"], pc["dropoff_latitude"]).alias("centroid_latitude"),
        geo.midpoint(pc["pickup_longitude"], pc["dropoff_longitude"]).alias("centroid_longitude"))


@query
def parse_datetimes(spark, sf_dir):
    """B4 / C9 over every raw row; null where the text is not a datetime."""
    raw = trips.raw(spark, sf_dir)
    return _ntz(raw.select(*[datetimes.parse_datetime(c).alias(c) for c in DATETIMES]),
                *DATETIMES)


@query
def decode_codes(spark, sf_dir):
    """B6 / D4 over every raw row."""
    raw = trips.raw(spark, sf_dir)
    return raw.select(codes.decode("VendorID").alias("VendorID"),
                      codes.decode("RateCodeID").alias("RateCodeID"),
                      codes.decode("payment_type").alias("payment_type"),
                      codes.flag_code("store_and_fwd_flag").alias("store_and_fwd_flag"))


def _vendors(spark, sf_dir, **how) -> DataFrame:
    """Raw trips with the name of the supplier whose key is the vendor's code;
    nearly every row has one of two codes."""
    raw = trips.raw(spark, sf_dir).select("VendorID", "trip_distance")
    suppliers = read_table(spark, sf_dir, "supplier")
    return lookup.lookup_join(raw, suppliers, "VendorID", "s_suppkey", "s_name", "vendor_name", **how)


@query
def lookup_vendor(spark, sf_dir):
    """D4 / B6 with a table as the dimension, sent to every executor if its
    measured size allows."""
    return _vendors(spark, sf_dir)


@query
def lookup_vendor_shuffled(spark, sf_dir):
    """D4 / B6 in the form for a dimension of any size: both sides shuffled by
    code, hot codes dealt over several parts."""
    return _vendors(spark, sf_dir, broadcast_bytes=-1)


@query
def parse_numbers(spark, sf_dir):
    """B7 over every raw row."""
    raw = trips.raw(spark, sf_dir)
    return raw.select(*[numbers.parse_number(c).alias(c) for c in NUMBERS])


@query
def trip_id(spark, sf_dir):
    """The id of every staged trip."""
    return trips.staged(spark, sf_dir).select("id")


@query
def flag_to_bool(spark, sf_dir):
    """B20 over every raw row."""
    raw = trips.raw(spark, sf_dir)
    return raw.select("store_and_fwd_flag",
                      codes.flag_to_bool("store_and_fwd_flag").alias("flag"))


@query
def valid_points(spark, sf_dir):
    """Raw rows whose parsed pickup and dropoff points are within EPSG:4326."""
    raw = trips.raw(spark, sf_dir)
    pc = {c: geo.parse_coord(c) for c in COORDINATES}
    ok = (geo.in_range(pc["pickup_longitude"], pc["pickup_latitude"])
          & geo.in_range(pc["dropoff_longitude"], pc["dropoff_latitude"]))
    return raw.filter(ok).select(*RAW_COLUMNS)


@query
def geohash7(spark, sf_dir):
    """Geohash of precision 7 of every staged pickup point."""
    st = trips.staged(spark, sf_dir)
    return st.select(F.col("id").alias("custom_id"),
                     geo.geohash("pickup_longitude", "pickup_latitude", 7).alias("geohash"))


@query
def trip_minutes(spark, sf_dir):
    """Whole minutes of every trip of the data table."""
    return _wh(spark, sf_dir, "trips_data").select("custom_id", "trip_minutes")


@query
def conform_schema(spark, sf_dir):
    """Staged trips conformed to the load table (``tripdata_tmp``)."""
    return trips.load_table(spark, sf_dir)


@query
def known_columns(spark, sf_dir):
    """Project staged trips to a list of names, skipping unknown ones."""
    return model.known_columns(trips.staged(spark, sf_dir),
                               ["id", "VendorID", "no_such_column", "total_amount"])


# --- filters and the staging chain ----------------------------------------------

@query
def drop_zero_points(spark, sf_dir):
    """Raw rows kept by the zero-point filters."""
    return clean.drop_zero_points(trips.raw(spark, sf_dir)).select(*RAW_COLUMNS)


@query
def order_check(spark, sf_dir):
    """C2 after C1: parseable times with pickup <= dropoff."""
    return clean.order_check(clean.drop_zero_points(trips.raw(spark, sf_dir))).select(*RAW_COLUMNS)


@query
def any_not_null(spark, sf_dir):
    """C4 (older job)."""
    return clean.any_not_null(trips.raw(spark, sf_dir)).select(*RAW_COLUMNS)


@query
def any_coord_nonzero(spark, sf_dir):
    """C5 (older job)."""
    return clean.any_coord_nonzero(trips.raw(spark, sf_dir)).select(*RAW_COLUMNS)


@query
def quarantine(spark, sf_dir):
    """Rejected rows with their reason."""
    return clean.quarantine(trips.raw(spark, sf_dir).drop("source_file"))


@query
def stage_trips(spark, sf_dir):
    """The 22 staged columns."""
    return trips.staged(spark, sf_dir)


# --- model tables, joins, aggregates --------------------------------------------
# All read the tables of the warehouse that is built once per input by the real
# load path (see ``plans.warehouse``). The compatibility variant of the dropoff
# table is projected from the load table.

def _points_out(df: DataFrame) -> DataFrame:
    return _ntz(df, "timestmp", "created_at")


@query
def model_pickup(spark, sf_dir):
    """``trips_pickup`` as stored, with its partition day."""
    return _points_out(_wh(spark, sf_dir, "trips_pickup"))


@query
def model_dropoff(spark, sf_dir):
    """A16 with the dropoff point."""
    return _points_out(_wh(spark, sf_dir, "trips_dropdown"))


@query
def model_dropdown_compat(spark, sf_dir):
    """A16 as the reference fills it: dropoff time, pickup point (Q1)."""
    return _points_out(model.dropoff_points(_wh(spark, sf_dir, "load"), trips.RUN_TS, compat=True))


def _data_out(df: DataFrame) -> DataFrame:
    flat = df.select("*", *[F.col(f"amount_details.{n}").alias(n)
                            for n, _ in model.AMOUNT_FIELDS]).drop("amount_details")
    return _ntz(flat, "pickup_timestmp", "dropoff_timestmp", "created_at")


@query
def model_data(spark, sf_dir):
    """``trips_data`` (amount struct flattened)."""
    return _data_out(_wh(spark, sf_dir, "trips_data"))


def _wh(spark, sf_dir, name: str) -> DataFrame:
    """A model table of the warehouse built once from ``sf_dir``."""
    return warehouse.table(spark, sf_dir, name)


def _join_out(df: DataFrame, time_col: str) -> DataFrame:
    out = df.select(F.col("d.custom_id").alias("custom_id"),
                    F.col(f"d.{time_col}").alias("timestmp"),
                    F.col("p.geohash").alias("geohash"),
                    F.col("d.amount_details.tip").alias("tip"),
                    F.col("d.amount_details.fare").alias("fare"))
    return _ntz(out, "timestmp")


@query
def join_trip_pickup(spark, sf_dir):
    """Data x pickup on (custom_id, pickup time)."""
    j = analytics.join_trip_points(_wh(spark, sf_dir, "trips_data"),
                                   _wh(spark, sf_dir, "trips_pickup"), "pickup_timestmp")
    return _join_out(j, "pickup_timestmp")


@query
def join_trip_dropoff(spark, sf_dir):
    """Data x dropoff on (custom_id, dropoff time)."""
    j = analytics.join_trip_points(_wh(spark, sf_dir, "trips_data"),
                                   _wh(spark, sf_dir, "trips_dropdown"), "dropoff_timestmp")
    return _join_out(j, "dropoff_timestmp")


@query
def avg_fare_per_mile(spark, sf_dir):
    """E1 / B22 / C6."""
    return analytics.avg_fare_per_mile(_wh(spark, sf_dir, "trips_data"))


@query
def avg_tip_by_zone(spark, sf_dir):
    """Average tip and number of joined trips per pickup geohash."""
    return analytics.avg_tip_by_zone(_wh(spark, sf_dir, "trips_data"),
                                     _wh(spark, sf_dir, "trips_pickup"))


@query
def top10_pickup_zones(spark, sf_dir):
    """G1: the ten pickup zones with the highest average tip."""
    return analytics.top10_pickup_zones(_wh(spark, sf_dir, "trips_data"),
                                        _wh(spark, sf_dir, "trips_pickup"))


# --- data-quality profile ----------------------------------------------------------

def _typed(spark, sf_dir) -> DataFrame:
    return warehouse.typed_trips(spark, sf_dir)


def _typed_out(df: DataFrame) -> DataFrame:
    return _ntz(df.select(*RAW_COLUMNS), *DATETIMES)


@query
def coord_ranges(spark, sf_dir):
    """Min / max of the parsed coordinates."""
    return profile.coord_ranges(_typed(spark, sf_dir))


@query
def coord_quantiles(spark, sf_dir):
    """Exact 2 % / 98 % quantiles of the parsed coordinates."""
    return profile.coord_quantiles(_typed(spark, sf_dir))


@query
def quantile_trim(spark, sf_dir):
    """Rows inside the quantile ranges of all four coordinates."""
    return _typed_out(profile.quantile_trim(_typed(spark, sf_dir)))


@query
def duration_check(spark, sf_dir):
    """C8 on the staged trips: 1 s < duration < 1 day."""
    st = trips.staged(spark, sf_dir)
    return st.filter(profile.duration_ok())


@query
def drop_unknown_codes(spark, sf_dir):
    """Rows whose three codes are all known."""
    return _typed_out(profile.drop_unknown_codes(_typed(spark, sf_dir)))


@query
def drop_zero_amounts(spark, sf_dir):
    """C11: rows with non-zero passenger count, distance, fare and total."""
    return _typed_out(profile.drop_zero_amounts(_typed(spark, sf_dir)))


@query
def profile_clean(spark, sf_dir):
    """H8: the whole profile chain C7 -> C9 -> C8 -> C10 -> C11."""
    return _typed_out(profile.clean_typed(_typed(spark, sf_dir)))


@query
def null_counts(spark, sf_dir):
    """E5: nulls per column of the typed raw trips."""
    return profile.null_counts(_typed(spark, sf_dir), RAW_COLUMNS)


@query
def zero_counts(spark, sf_dir):
    """Zeros per amount and coordinate column."""
    return profile.zero_counts(_typed(spark, sf_dir))


@query
def flag_counts(spark, sf_dir):
    """Rows per store-and-forward flag value."""
    return profile.value_counts(trips.raw(spark, sf_dir), "store_and_fwd_flag")


@query
def stage_retention(spark, sf_dir):
    """Rows left after each staging rule."""
    return profile.stage_retention(trips.classified(spark, sf_dir))


@query
def profile_retention(spark, sf_dir):
    """Rows left after each rule of the profile chain and the shares that
    they are of all rows and of the step before."""
    return profile.profile_retention(_typed(spark, sf_dir))


# --- files: globs, manifest, reader, sinks ------------------------------------------

#: Months picked by the month-selecting queries ('|'-separated, as the job takes them).
MONTHS = "1996-03|1998-11"
#: Year matched by the manifest query (the filter is "name contains").
MANIFEST_MONTH = "1996"
BASE_GLOB = "*.csv.zip"


def _raw_lines(spark, sf_dir, globs: list[str] | None = None) -> DataFrame:
    """Trip lines of the raw files that match the globs, with ``source_file``.
    The globs select folders, so other files are not opened."""
    root = warehouse.raw_files(spark, sf_dir)
    paths = [f"{root}/source_file={g}" for g in globs or ["*"]]
    return files.read_raw(spark, paths, base_path=root)


def _files(spark, sf_dir) -> DataFrame:
    """One row per raw file, from the listing: name and size in bytes."""
    listing = files.list_files(spark, f"{warehouse.raw_files(spark, sf_dir)}/source_file=*/*.txt")
    name = F.regexp_extract("path", r"/source_file=([^/]+)/[^/]*$", 1)
    return listing.groupBy(name.alias("file_name")).agg(F.sum("length").alias("length"))


@query
def select_months(spark, sf_dir):
    """A1 / A2: the trip lines of the files matched by the month globs."""
    return _raw_lines(spark, sf_dir, files.month_patterns(BASE_GLOB, MONTHS))


@query
def file_manifest(spark, sf_dir):
    """Zipped files of the month with their derived locations."""
    return files.file_manifest(_files(spark, sf_dir), MANIFEST_MONTH, root="/data")


@query
def file_count(spark, sf_dir):
    """Number of zipped files of the month."""
    return files.file_manifest(_files(spark, sf_dir), MANIFEST_MONTH).agg(F.count(F.lit(1)).alias("n_files"))


@query
def read_raw(spark, sf_dir):
    """A3 / A4: the trip lines of all raw files."""
    return _raw_lines(spark, sf_dir).select(*RAW_COLUMNS)


def staged_table(spark, sf_dir) -> str:
    """Folder of the one-pass staging write (staged and quarantined rows)."""
    return warehouse.once(spark, sf_dir, "staged", lambda path: sinks.write_stage(
        trips.raw(spark, sf_dir), path, extra=["source_file"]))


def _staged_parts(spark, sf_dir) -> DataFrame:
    """Staged trips with the ``source_part`` that the load is keyed by."""
    return _with_part(sinks.read_staged(spark, staged_table(spark, sf_dir), extra=["source_file"]))


def _stage_files(spark, sf_dir, path: str, parts: list[str]) -> DataFrame:
    """Stage the lines of some raw files, and only these; read back with their ``source_part``.
    Other files are not opened; a part without a file has no lines."""
    names = {f"source_file={p}{files.ZIP_SUFFIX}" for p in parts}
    root = warehouse.raw_files(spark, sf_dir)
    found = names.intersection(folders.children(spark, root, folders=True))
    raw = (_raw_lines(spark, sf_dir, sorted(n.removeprefix("source_file=") for n in found)) if found
           else spark.createDataFrame([], ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "source_file"])))
    sinks.write_stage(raw, path, extra=["source_file"])
    return _with_part(sinks.read_staged(spark, path, extra=["source_file"]))


def _with_part(staged: DataFrame) -> DataFrame:
    return staged.withColumn("source_part", F.regexp_replace("source_file", r"\.csv\.zip$", "")).drop("source_file")


@query
def read_staged(spark, sf_dir):
    """One-pass staging write (staged + quarantined), staged read back."""
    return sinks.read_staged(spark, staged_table(spark, sf_dir))


@query
def append_tmp(spark, sf_dir):
    """Staged parts appended to the load table, then the even parts
    loaded again; the rerun replaces them instead of doubling them."""
    staged = _staged_parts(spark, sf_dir)
    n_bytes = folders.n_bytes(spark, staged_table(spark, sf_dir))

    def write(path: str) -> None:
        sinks.append_load(staged, path, n_bytes=n_bytes)
        even = F.substring("source_part", -2, 2).cast("int") % 2 == 0
        sinks.append_load(staged.filter(even), path, n_bytes=n_bytes // 2)

    return spark.read.parquet(warehouse.once(spark, sf_dir, "appended", write)).drop("source_part")


#: Files of the first load (by stream), and the file that is then replaced by a
#: wrong version and corrected again.
FIRST_MONTHS = "*-0?_*"
CORRECTED = "yellow_tripdata_1996-03_04"


def _part_of_file():
    return incremental.part_of_file(F.col("path"))


def _listing(spark, sf_dir, glob: str = "*") -> DataFrame:
    """The raw files as the ledger knows them; ``file_name`` is the trip file's."""
    listing = files.list_files(spark, f"{warehouse.raw_files(spark, sf_dir)}/source_file={glob}/*.txt")
    return listing.withColumnRenamed("modificationTime", "modified").select("path", "file_name", "length", "modified")


def incremental_warehouse(spark, sf_dir) -> str:
    """Folder of a warehouse that several loads made: a stream loads the files
    of the months 01 to 09, a batch all files that the ledger doesn't have; then
    one file comes in a wrong version, whose trips are two days early, and in its
    right version again. ``new_files`` keeps what was new after the stream, and
    after the wrong version. Staged rows go when their loads have ended, as the
    load table has them; the quarantine stays."""
    def write(root: str) -> None:
        raw = warehouse.raw_files(spark, sf_dir)
        incremental.load_new_files(spark, f"{raw}/source_file={FIRST_MONTHS}", root, f"{root}/checkpoint", trips.RUN_TS)
        for batch in folders.children(spark, f"{root}/staged/files", folders=True):
            sinks.drop_staged(spark, f"{root}/staged/files/{batch}")
        listing = _listing(spark, sf_dir)

        def note_new(step: str) -> DataFrame:
            path = f"{root}/new_files/step={step}"
            files.new_files(listing, journal.loaded_files(spark, root)).write.parquet(path)
            return spark.read.parquet(path)

        new = note_new("stream")
        parts = [r[0] for r in new.select(_part_of_file()).distinct().collect()]  # files, not rows
        staged = _stage_files(spark, sf_dir, f"{root}/staged/batch", [*parts, CORRECTED])
        journal.load(staged, root, parts, new, trips.RUN_TS)
        one = listing.where(_part_of_file() == CORRECTED)
        earlier = F.expr("INTERVAL 2 DAYS")
        early = F.date_format(F.to_timestamp("tpep_pickup_datetime") - earlier, "yyyy-MM-dd HH:mm:ss")
        journal.load(staged.withColumn("tpep_pickup_datetime", early), root, [CORRECTED],
                     one.withColumn("modified", F.col("modified") - earlier), trips.RUN_TS)
        journal.load(staged, root, [CORRECTED], note_new("wrong"), trips.RUN_TS)
        sinks.drop_staged(spark, f"{root}/staged/batch")

    return warehouse.once(spark, sf_dir, "incremental", write)


@query
def new_files(spark, sf_dir):
    """Files that the ledger of loaded files did not have after the first
    load, and after a load of a file whose time was another one."""
    new = spark.read.parquet(f"{incremental_warehouse(spark, sf_dir)}/new_files")
    return new.select("step", F.concat(_part_of_file(), F.lit(files.ZIP_SUFFIX)).alias("file_name"), "length")


@query
def load_ledger(spark, sf_dir):
    """The files in the ledger and how often each was loaded."""
    ledger = journal.ledger(spark, incremental_warehouse(spark, sf_dir))
    return ledger.groupBy(F.concat(_part_of_file(), F.lit(files.ZIP_SUFFIX)).alias("file_name"), "length").agg(
        F.count(F.lit(1)).alias("n_loads"))


@query
def model_incremental(spark, sf_dir):
    """``trips_pickup`` after the loads of :func:`incremental_warehouse`."""
    return _points_out(journal.read(spark, incremental_warehouse(spark, sf_dir), "trips_pickup"))


@query
def model_incremental_data(spark, sf_dir):
    """``trips_data`` after the same loads."""
    return _data_out(journal.read(spark, incremental_warehouse(spark, sf_dir), "trips_data"))


@query
def index_days(spark, sf_dir):
    """Rows by day from the file index of ``trips_pickup``, without
    opening a file of the table."""
    index = journal.index(spark, incremental_warehouse(spark, sf_dir), "trips_pickup")
    return index.groupBy(F.col("part").cast("date").alias("day")).agg(F.sum("n_rows").alias("n_rows"))


#: The days and geohashes that the range query asks for.
RANGE_DAYS, RANGE_ZONES = ("1995-02-01", "1997-08-15"), ("dr5r", "dr5x5")


@query
def trips_in_range(spark, sf_dir):
    """Pickups of a range of days and geohashes; only the files that the
    file index names for it are opened."""
    return _points_out(journal.read_range(spark, incremental_warehouse(spark, sf_dir), "trips_pickup",
                                          RANGE_DAYS, RANGE_ZONES))


@query
def tables_by_name(spark, sf_dir):
    """The tables created by name where absent, the staged
    trips appended to the load table in two halves and the three model tables
    inserted from it, all by name; the dropoff points read by name."""
    staged = model.conform_schema(_staged_parts(spark, sf_dir), keep=(journal.PART,))
    parts = model.write_parts(spark, folders.n_bytes(spark, staged_table(spark, sf_dir)))
    even = F.pmod(F.hash(journal.PART), F.lit(2)) == 0

    def write(root: str) -> None:
        catalog.drop_tables(spark, "taxiframe_load")
        catalog.create_tables(spark, "taxiframe_load", root)
        for half in (even, ~even):
            catalog.append(staged.where(half), f"taxiframe_load.{catalog.LOAD_TABLE}", parts)
        catalog.fill_model(spark, "taxiframe_load", trips.RUN_TS, parts)
        catalog.drop_tables(spark, "taxiframe_load")

    root = warehouse.once(spark, sf_dir, "by-name", write)
    catalog.drop_tables(spark, "taxiframe")
    catalog.create_tables(spark, "taxiframe", root)
    return _points_out(spark.table("taxiframe.trips_dropdown").drop(model.FOLDER))


@query
def columns_by_file(spark, sf_dir):
    """Staged files of two kinds, one without ``improvement_surcharge``; its
    rows get the default, while nulls that the other files have stay null."""
    def write(path: str) -> None:
        staged = _staged_parts(spark, sf_dir).withColumn("old", F.substring(journal.PART, -2, 2).cast("int") % 2 == 0)
        empty = F.when(F.col("passenger_count") == 0, None).otherwise(F.col("improvement_surcharge"))
        staged.where("old").drop("improvement_surcharge", "old").write.parquet(f"{path}/old")
        staged.where("NOT old").withColumn("improvement_surcharge", empty).drop("old").write.parquet(f"{path}/new")

    root = warehouse.once(spark, sf_dir, "two-kinds", write)
    return sinks.read_conformed(spark, [f"{root}/old", f"{root}/new"])


@query
def extract_raw(spark, sf_dir):
    """H6 (older job): month files -> any datetime/coordinate present -> some
    coordinate away from 0; all text."""
    picked = _raw_lines(spark, sf_dir, files.month_patterns(BASE_GLOB, MONTHS))
    return clean.any_coord_nonzero(clean.any_not_null(picked)).select(*RAW_COLUMNS)
