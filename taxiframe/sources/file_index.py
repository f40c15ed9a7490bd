"""File index of a stored Parquet table.

One row per file and partition value in it (a day; in the load table a part):
the file's path below the table's folder, the rows, and the least and greatest
keys among them. A load stores the index of the whole table under its own
version. Readers take their file list from a version instead of listing folders,
and only the files that can hold the rows they ask for; files that a load has
written but not published are in no version that a reader sees.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxiframe.sources import folders

#: Readers of whole tables by application, table and version: a version never
#: changes, so one listing serves all queries of a session.
_READERS: dict[tuple[str, str, str], DataFrame] = {}


def entries(files: DataFrame, partition: str, keys: dict[str, Column]) -> DataFrame:
    """Index rows for a table read as ``files``: ``file, part, n_rows`` and
    ``min_<key>, max_<key>`` for each of ``keys``. Only the keys are read; counts
    are combined by task and file before the shuffle."""
    # Folder and name of the file, as the file system has them.
    name = F.url_decode(F.replace(F.substring_index("path", "/", -2), F.lit("+"), F.lit("%2B")))
    bounds = [f(k).alias(f"{n}_{key}") for key, k in keys.items() for n, f in (("min", F.min), ("max", F.max))]
    # Names and texts are made of the groups, not of the rows.
    found = files.groupBy(F.col("_metadata.file_path").alias("path"), F.col(partition).alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), *bounds)
    return found.select(name.alias("file"), F.col("part").cast("string").alias("part"), *found.columns[2:])


def version_path(table: str, version: str) -> str:
    return f"{table.rstrip('/')}_index/{version}"


def write(index: DataFrame, table: str, version: str) -> None:
    """Store the index of ``table`` as ``version``: some rows per file, so one
    file holds it."""
    index.repartition(1).write.mode("overwrite").parquet(version_path(table, version))


def read(spark: SparkSession, table: str, version: str) -> DataFrame:
    return spark.read.parquet(version_path(table, version))


def open_files(spark: SparkSession, table: str, schema: T.StructType, names: list[str]) -> DataFrame:
    """The rows of the files ``names`` (below the folder ``table``)."""
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table.rstrip('/')}/{n}" for n in names])


def read_table(spark: SparkSession, table: str, version: str, schema: T.StructType,
               keep: Callable[[DataFrame], DataFrame] | None = None, closed: bool = True) -> DataFrame:
    """Rows of ``table`` in ``version``, from the files that the index names;
    with ``keep``, a filter over the index, from the files that pass it.
    ``closed``: the version will not change any more."""
    key = (spark.sparkContext.applicationId, table, version)
    if keep is None and key in _READERS:
        return _READERS[key]
    index = read(spark, table, version)
    names = [r["file"] for r in (keep(index) if keep else index).select("file").distinct().collect()]  # names, not rows
    frame = open_files(spark, table, schema, sorted(names))
    if keep is None and closed:
        _READERS[key] = frame
    return frame


def literal(value) -> Column:
    """A value of a key; days as their text, which is right for early years too."""
    return F.lit(value.isoformat()).cast("date") if isinstance(value, datetime.date) else F.lit(value)


def overlapping(low: str | None, high: str | None, key: str) -> Callable[[DataFrame], DataFrame]:
    """A filter over an index: files that can hold keys from ``low`` to ``high``
    (null: no limit)."""
    def keep(index: DataFrame) -> DataFrame:
        if low is not None:
            index = index.where(F.col(f"max_{key}") >= F.lit(low))
        return index if high is None else index.where(F.col(f"min_{key}") <= F.lit(high))

    return keep


def holding(values: list, key: str) -> Callable[[DataFrame], DataFrame]:
    """A filter over an index: files that can hold one of the values of a key,
    which can lie far apart."""
    def keep(index: DataFrame) -> DataFrame:
        if not values:
            return index.limit(0)
        inside = lambda v: (v >= F.col(f"min_{key}")) & (v <= F.col(f"max_{key}"))
        return index.where(F.exists(F.array(*map(literal, values)), inside))

    return keep
