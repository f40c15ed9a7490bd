"""The warehouse: load table and model tables materialized once per input.

Analytical queries read the model tables the way the reference's queries read
its warehouse: Parquet partitioned by day and clustered, scanned with column
pruning (``amount_details.tip`` reads one nested leaf). The tables are built
by the real load path (staged trips -> load table -> three model tables) in
the shared checkpoint folder, under a key made of the input's identity, the
load time and a hash of this package's code, so a code change or a new input
never reuses stale tables. A build goes to a unique temporary folder that is
renamed into place.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.operators import model, profile
from taxiframe.plans import trips
from taxiframe.schemas import RAW_COLUMNS
from taxiframe.session import shared_dir, storing
from taxiframe.sources import file_index, folders, journal
from taxiframe.sources.derived import (_landing_key, derive_raw_trips, landing_parts, publish, raw_trips, read_table,
                                       source_file)

TABLES = ("trips_pickup", "trips_dropdown", "trips_data")
#: The version of the file indexes of a warehouse that is built as a whole.
BUILT = "built"


@lru_cache(maxsize=1)
def code_version() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for dirpath, _, names in sorted(os.walk(root)):
        for name in sorted(n for n in names if n.endswith(".py")):
            with open(os.path.join(dirpath, name), "rb") as fh:
                h.update(name.encode())
                h.update(fh.read())
    return h.hexdigest()[:12]


def _built(spark: SparkSession, final: str, write: Callable[[str], None]) -> str:
    """The folder ``final``, which ``write(path)`` makes where it isn't complete:
    under a name of its own that is then moved, or removed if the write fails."""
    if not folders.exists(spark, f"{final}/_BUILT"):
        tmp = f"{final}.tmp-{uuid.uuid4().hex[:8]}"
        try:
            with storing(spark):
                write(tmp)
        except BaseException:
            folders.delete(spark, tmp)
            raise
        folders.mark(spark, f"{tmp}/_BUILT")
        publish(spark, tmp, final, "_BUILT")
    return final


def build(spark: SparkSession, sf_dir: str, run_ts: str = trips.RUN_TS) -> str:
    """Folder holding ``load`` and the three model tables for ``sf_dir``."""
    ident = f"{_landing_key(spark, sf_dir)}|{run_ts}|{code_version()}"
    final = f"{shared_dir(spark).rstrip('/')}/warehouse-{hashlib.sha1(ident.encode()).hexdigest()[:16]}"

    def write(root: str) -> None:
        # Stage and conform once; the model tables are projections of the load table.
        trips.load_table(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/load")
        load = spark.read.parquet(f"{root}/load")
        n_bytes = folders.n_bytes(spark, f"{root}/load")
        parts = model.write_parts(spark, n_bytes)
        for name, path in model.write_model(load, root, run_ts, parts=parts, n_bytes=n_bytes).items():
            written = spark.read.schema(journal.table_schema(name)).parquet(path)
            file_index.write(file_index.entries(written, "day", journal.index_keys(name)), path, BUILT)

    return _built(spark, final, write)


def table(spark: SparkSession, sf_dir: str, name: str, run_ts: str = trips.RUN_TS) -> DataFrame:
    """One warehouse table (``load``, ``trips_pickup``, ``trips_dropdown``,
    ``trips_data``) as a DataFrame over its Parquet files."""
    root = build(spark, sf_dir, run_ts)
    if name == "load":
        return spark.read.parquet(f"{root}/load")
    return file_index.read_table(spark, f"{root}/{name}", BUILT, journal.table_schema(name))


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder of a table derived from ``sf_dir`` that ``write(path)`` makes; it
    is built once per input and code version, so repeated queries leave no
    further copies."""
    ident = f"{_landing_key(spark, sf_dir)}|{name}|{code_version()}"
    final = f"{shared_dir(spark).rstrip('/')}/{name}-{hashlib.sha1(ident.encode()).hexdigest()[:16]}"
    return _built(spark, final, write)


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The trip lines as tab-separated text, one folder per raw file
    (``source_file=<name>``) and one file in it."""
    def write(path: str) -> None:
        lines = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS])
        # The rows are dealt by their file before the lines are made of them: the
        # lines, some five times as long, are never shuffled.
        lineitem = read_table(spark, sf_dir, "lineitem")
        dealt = lineitem.repartition(landing_parts(lineitem), source_file())
        (derive_raw_trips(dealt).select("source_file", lines.alias("value"))
         .sortWithinPartitions("source_file")
         # Many small files in a folder that is published as a whole: tasks may
         # move their own files.
         .write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .partitionBy("source_file").text(path))

    return once(spark, sf_dir, "raw-files", write)


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed view of the raw trips (``profile.typed``) as a table."""
    path = once(spark, sf_dir, "typed", lambda path: profile.typed(
        raw_trips(spark, sf_dir).drop("source_file")).write.parquet(path))
    return spark.read.parquet(path)
