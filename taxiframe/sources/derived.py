"""Raw trip lines derived from the driver's ``lineitem`` table.

The test tables hold no taxi trips, so every query builds ``trips_raw`` (the 19
text columns of a trip line) from ``lineitem`` with integer arithmetic only: no
random numbers and no row numbers, hence the same text in any engine and any
partitioning. The derived lines grow with ``lineitem`` and are written once
per input as a landing table (see :func:`landing_table`). The rules,
including the deliberately broken values, are those of FIXTURES.md section 2.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.schemas import COORDINATES, DATETIMES, RAW_COLUMNS, SOURCE_NAME
from taxiframe.session import shared_dir, storing


def _k() -> Column:
    return (F.col("l_orderkey") * 7 + F.col("l_linenumber") + F.col("l_partkey") * 13
            + F.col("l_suppkey") * 31).cast("bigint")


def _cents(e: Column) -> Column:
    """Integer cents as money text: 1234 -> '12.34'."""
    return F.concat((e / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((e % 100).cast("string"), 2, "0"))


def _when_mod(k: Column, cases: list[tuple[int, str]], otherwise: Column) -> Column:
    expr = None
    for mod, text in cases:
        cond = (k % mod) == 0
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(otherwise) if expr is not None else otherwise


def _lon(k: Column, cell: Column) -> Column:
    return _when_mod(k, [(53, "0"), (211, "-86.0"), (307, "-73.9.1")],
                     F.concat(F.lit("-73."), (700000 + cell * 7000 + k % 9).cast("string")))


def _lat(k: Column, cell: Column) -> Column:
    return _when_mod(k, [(53, "0"), (211, "50.0")],
                     F.concat(F.lit("40."), (550000 + cell * 7000 + k % 11).cast("string")))


def _shift_text(seconds: Column) -> Column:
    ts = F.timestamp_add("SECOND", seconds, F.col("l_shipdate").cast("timestamp_ntz"))
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


#: Dirty lines: every ``mod``-th trip has ``text`` in the columns named (null:
#: no field at all). The first entry that applies to a column wins.
DIRTY = [
    (401, None, "header"),
    (457, None, [*COORDINATES, *DATETIMES]),
    (409, "nan", ["pickup_longitude"]),
    (419, "-inf", ["dropoff_latitude"]),
    (421, "200.5", ["pickup_longitude"]),
    (433, "0", ["dropoff_longitude", "dropoff_latitude"]),
    (431, "1.5", ["passenger_count"]),
    (443, None, ["passenger_count", "tip_amount"]),
    (439, "15300000.0", ["trip_distance"]),
    (449, None, ["trip_distance"]),
    (461, "1e7", ["extra"]),
    (463, "0.00005", ["extra"]),
    (479, "10000000.5", ["extra"]),
]


def dirty(name: str, k: Column, text: Column) -> Column:
    """The text of a column, or what a dirty line has there."""
    out = None
    for mod, value, columns in DIRTY:
        if columns == "header" or name in columns:
            value = F.lit(name if columns == "header" else value).cast("string")
            out = F.when(k % mod == 0, value) if out is None else out.when(k % mod == 0, value)
    return text if out is None else out.otherwise(text)


def source_file() -> Column:
    """The raw file that the line of a ``lineitem`` row is in."""
    return F.concat(F.lit(SOURCE_NAME + "_"), F.date_format("l_shipdate", "yyyy-MM"), F.lit("_"),
                    F.lpad((_k() % 23).cast("string"), 2, "0"), F.lit(".csv.zip"))


def derive_raw_trips(lineitem: DataFrame, with_source: bool = True) -> DataFrame:
    """19 raw text columns (+ ``source_file``) for each ``lineitem`` row."""
    k = F.col("_k")
    base = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_shipdate").withColumn("_k", _k())
    div = lambda a, b: (a / b).cast("bigint")  # noqa: E731 - integer division
    drop_delta = F.when(k % 101 == 0, F.lit(-60)).otherwise((k * 37) % 5400)
    cols = {
        "VendorID": F.when(k % 97 == 0, F.lit("3")).otherwise((1 + k % 2).cast("string")),
        "tpep_pickup_datetime": F.when(k % 103 == 0, F.lit("2015/04/01 00:00:00"))
        .otherwise(_shift_text(k % 86400)),
        "tpep_dropoff_datetime": _shift_text(k % 86400 + drop_delta),
        "passenger_count": (k % 7).cast("string"),
        "trip_distance": _when_mod(k, [(89, "0.5.1"), (61, "0")],
                                   _cents(10 + (k * 13) % 2000)),
        "pickup_longitude": _lon(k, k % 40),
        "pickup_latitude": _lat(k, div(k, 40) % 40),
        "RateCodeID": (1 + k % 7).cast("string"),
        "store_and_fwd_flag": F.when(k % 5 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "dropoff_longitude": _lon(k, div(k, 3) % 40),
        "dropoff_latitude": _lat(k, div(k, 7) % 40),
        "payment_type": (1 + k % 6).cast("string"),
        "fare_amount": _when_mod(k, [(59, "0")], _cents(250 + (k * 31) % 9000)),
        "extra": F.when(k % 2 == 0, F.lit("0.5")).otherwise(F.lit("0")),
        "mta_tax": F.lit("0.5"),
        "tip_amount": _cents((k * 17) % 1200),
        "tolls_amount": F.when(k % 19 == 0, F.lit("5.54")).otherwise(F.lit("0")),
        "improvement_surcharge": F.lit("0.3"),
        "total_amount": _cents(330 + (k * 31) % 9000 + (k * 17) % 1200),
    }
    out = [dirty(c, k, cols[c]).alias(c) for c in RAW_COLUMNS]
    if with_source:
        out.append(source_file().alias("source_file"))
    return base.select(*out)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=1)
def _rules_version() -> str:
    """Hash of this module, whose rules make the lines."""
    with open(__file__, "rb") as code:
        return hashlib.sha1(code.read()).hexdigest()[:12]


def _landing_key(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the derived landing table: folder, size and time of
    lineitem, and the rules."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    st = fs.getFileStatus(jpath)
    size = fs.getContentSummary(jpath).getLength()
    ident = f"{fs.makeQualified(jpath).toString()}|{size}|{st.getModificationTime()}|{_rules_version()}"
    return hashlib.sha1(ident.encode()).hexdigest()[:16]


def publish(spark: SparkSession, tmp: str, final: str, marker: str = "_SUCCESS") -> None:
    """Move a finished folder into place. A complete copy (one that has the
    marker file) that another run published first wins and ours is dropped; a
    folder without the marker is what a broken run left, and is replaced."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    src, dst, done = path(tmp), path(final), path(f"{final}/{marker}")
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(done):
        fs.delete(dst, True)
        fs.rename(src, dst)
    if not fs.exists(done):
        raise OSError(f"{tmp} could not be moved to {final}; the finished copy stays there")
    fs.delete(src, True)
    # A rename onto a folder that appeared meanwhile nests ours inside it.
    fs.delete(path(f"{final}/{src.getName()}"), True)


#: Lines of a landing file at most: a task that parses one takes seconds at any size.
LANDING_ROWS = 250_000


def landing_parts(lineitem: DataFrame) -> int:
    """Files of the landing table: one per split of the scan, a core each, and
    one for every ``LANDING_ROWS`` lines (counted by the footers)."""
    return max(lineitem.rdd.getNumPartitions(), lineitem.sparkSession.sparkContext.defaultParallelism,
               -(-lineitem.count() // LANDING_ROWS))


def landing_table(spark: SparkSession, sf_dir: str) -> str:
    """Path of the raw trip lines derived from ``sf_dir``, written once.

    This stands for the landing zone of the real system, where the monthly
    trip files already exist: every query scans it like a raw input instead
    of re-deriving the text per query. It lives in the shared checkpoint
    folder, is written to a unique temporary name and renamed into place (a
    concurrent writer loses the rename and uses the winner's copy), and has at
    least one file per core so the CPU-heavy parsing uses the whole cluster.
    """
    base = shared_dir(spark).rstrip("/")
    final = f"{base}/landing-raw-{_landing_key(spark, sf_dir)}"
    jfinal = spark._jvm.org.apache.hadoop.fs.Path(final)
    fs = jfinal.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(final + "/_SUCCESS")):
        tmp = f"{final}.tmp-{uuid.uuid4().hex[:8]}"
        lineitem = read_table(spark, sf_dir, "lineitem")
        # The derived input is dealt out in parts of even size for its readers.
        derived = derive_raw_trips(lineitem.repartition(landing_parts(lineitem)))
        with storing(spark):
            derived.write.mode("overwrite").parquet(tmp)
        publish(spark, tmp, final)
    return final


def raw_trips(spark: SparkSession, sf_dir: str, with_source: bool = True) -> DataFrame:
    """``trips_raw`` for the tables under ``sf_dir`` (19 text columns and,
    unless ``with_source=False``, the ``source_file`` each line came from)."""
    df = spark.read.parquet(landing_table(spark, sf_dir))
    return df if with_source else df.drop("source_file")
