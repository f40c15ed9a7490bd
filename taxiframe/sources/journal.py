"""Loads that can break off anywhere: the load table, the three model tables,
the file index and the ledger of files change together or not at all.

A load first writes down what it is going to do, in ``journal/<id>``: its rows,
the parts it replaces, the days that their old and new rows touch, the files it
takes and its time. Only when this record is complete (``_PLANNED``) does it
change a table. Each table step writes new files beside the old ones, with the
rows that it makes anew and those that stay of the files it replaces, and an
index of the table without the replaced files. The load counts from the moment
its ``_CLOSED`` file exists, as readers take the file lists of the last closed
load. Files that no index names any more are removed afterwards.

A run that breaks off is repeated by the next load, or by :func:`resume`: the
record is replayed, with steps that are done left out and what a broken step
left behind removed. A load that broke off before its record was complete has
changed nothing and is forgotten. The record's copy of the rows is removed as
soon as the load table has them.

One load runs at a time; readers can run at any time. The folders::

    load/month=…         trips_pickup/month=…   trips_dropdown/month=…   trips_data/month=…
    <table>_index/<id>   journal/<id>           ledger/load=<id>
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxiframe.functions import datetimes
from taxiframe.operators import model
from taxiframe.schemas import STAGED_SCHEMA
from taxiframe.session import storing
from taxiframe.sources import file_index, folders

LOAD, PART = "load", "source_part"
TABLES = tuple(model.MODEL_CLUSTER_KEYS)
#: What a file of the ledger is known by, and the load that took it.
FILE = "path string, file_name string, length long, modified timestamp"
#: What else a load notes: its time, its name and how many bytes its rows take.
INFO = "run_ts string, key string, n_bytes long"
LEDGER = FILE + ", state string, load string"


@lru_cache
def table_schema(name: str) -> T.StructType:
    """Schema of a stored table, without its folder; the column last by which a
    load replaces rows (the part, the day)."""
    staged = SparkSession.active().createDataFrame([], T.StructType([*STAGED_SCHEMA.fields, T.StructField(PART, T.StringType())]))
    load = model.conform_schema(staged, keep=(PART,))
    return load.schema if name == LOAD else model.model_tables(load)[name].schema


def partition_of(name: str) -> str:
    return PART if name == LOAD else "day"


def layout(name: str) -> tuple[Column, list[str]]:
    """Folder and order of a stored table."""
    if name == LOAD:
        return model.month_of(_day("tpep_pickup_datetime")), [PART, "tpep_pickup_datetime"]
    return model.month_of(F.col("day")), model.sort_keys(name)


def index_keys(name: str) -> dict[str, Column]:
    """Keys of a table's file index: its cluster keys; for the load table the
    days of its rows."""
    if name == LOAD:
        return {"pickup_day": _day("tpep_pickup_datetime"), "dropoff_day": _day("tpep_dropoff_datetime")}
    return {k: F.col(k) for k in model.MODEL_CLUSTER_KEYS[name]}


def _among(column: Column, values: list) -> Column:
    """Whether a column has one of the values, of which one may be null."""
    known = [file_index.literal(v) for v in values if v is not None]
    # A null is in no list, also not in an empty one.
    return F.when(column.isNull(), F.lit(None in values)).otherwise(column.isin(known))


def _day(column: str) -> Column:
    return datetimes.day_of(datetimes.parse_datetime(column))


# --- the journal --------------------------------------------------------------

def _at(root: str, load_id: str, name: str = "") -> str:
    return f"{root.rstrip('/')}/journal/{load_id}" + (f"/{name}" if name else "")


def loads(spark: SparkSession, root: str, marker: str = "_CLOSED") -> list[str]:
    """Ids of the loads that have a marker, in order."""
    ids = folders.children(spark, f"{root.rstrip('/')}/journal", folders=True)
    return [i for i in ids if folders.exists(spark, _at(root, i, marker))]


def current(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """The last closed load (before another one); null where there is none."""
    closed = [i for i in loads(spark, root) if before is None or i < before]
    return closed[-1] if closed else None


def read(spark: SparkSession, root: str, name: str, version: str | None = None, keep=None) -> DataFrame:
    """The rows of a table as the last closed load (or the load ``version``)
    left it; ``keep`` filters its file index (see :mod:`.file_index`)."""
    closed, schema = version is None, table_schema(name)
    version = version or current(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return file_index.read_table(spark, f"{root.rstrip('/')}/{name}", version, schema, keep, closed)


def index(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """The file index of a table as the last closed load left it."""
    version = version or current(spark, root)
    if version is None:
        raise ValueError(f"{root} has no closed load")
    return file_index.read(spark, f"{root.rstrip('/')}/{name}", version)


def read_range(spark: SparkSession, root: str, name: str, days: tuple[str | None, str | None] = (None, None),
               keys: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Rows of a model table with a day and a first cluster key (the geohash of
    the point tables) in the given ranges, both ends included. Only the files
    that the index names for them are opened."""
    key = model.MODEL_CLUSTER_KEYS[name][0]
    kind = table_schema(name)[key].dataType

    def inside(frame: DataFrame, column: Column, limits: tuple) -> DataFrame:
        for limit, passes in zip(limits, (column.__ge__, column.__le__), strict=True):
            frame = frame if limit is None else frame.where(passes(F.lit(limit).cast(
                "date" if limits is days else kind)))
        return frame

    def keep(index: DataFrame) -> DataFrame:
        named = inside(index, F.col("part").cast("date"), days)
        return file_index.overlapping(*keys, key)(named)

    return inside(inside(read(spark, root, name, keep=keep), F.col("day"), days), F.col(key), keys)


def plan(staged: DataFrame, root: str, parts: Iterable[str] | None = None, files: DataFrame | None = None,
         run_ts: str | None = None, key: str | None = None) -> str:
    """Write down a load of the staged rows (with ``source_part``) and return
    its id. ``parts`` names the parts it replaces, also those without a row
    (default: those that the rows have); ``files`` has the files it takes
    (:data:`FILE`); ``key`` is a name of the load that the caller knows."""
    spark = staged.sparkSession
    root = root.rstrip("/")
    number = int(([*folders.children(spark, f"{root}/journal", folders=True)] or ["0"])[-1]) + 1
    load_id = f"{number:06d}"
    if not folders.claim(spark, _at(root, load_id)):
        raise RuntimeError(f"another load has begun in {root}")
    given = None if parts is None else list(parts)
    rows = staged if given is None else staged.where(F.col(PART).isin(given))
    # The rows are staged once; all later steps read them from here.
    model.conform_schema(rows, keep=(PART,)).write.parquet(_at(root, load_id, "rows"))
    rows = _rows(spark, root, load_id)
    named = rows.select(PART).distinct() if given is None else spark.createDataFrame(
        [(p,) for p in given], f"{PART} string")
    named.coalesce(1).write.parquet(_at(root, load_id, "parts"))
    names = _parts(spark, root, load_id)
    # Files can hold other parts too.
    old = read(spark, root, LOAD, keep=lambda index: index.where(F.col("part").isin(names))).where(F.col(PART).isin(names))
    days = lambda frame: frame.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("table"), _day(c).alias("day")) for t, c in model.DAY_SOURCE.items()])).alias("d"))
    (days(rows).unionAll(days(old)).select("d.*").distinct().coalesce(1).write.parquet(_at(root, load_id, "days")))
    taken = spark.createDataFrame([], FILE) if files is None else files.select(
        *[F.col(n.split()[0]) for n in FILE.split(", ")])
    taken.write.parquet(_at(root, load_id, "files"))
    stamp = run_ts or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    noted = [(stamp, key, folders.n_bytes(spark, _at(root, load_id, "rows")))]
    spark.createDataFrame(noted, INFO).coalesce(1).write.parquet(_at(root, load_id, "info"))
    folders.mark(spark, _at(root, load_id, "_PLANNED"))
    return load_id


def _rows(spark: SparkSession, root: str, load_id: str) -> DataFrame:
    return spark.read.schema(table_schema(LOAD)).parquet(_at(root, load_id, "rows"))


def _parts(spark: SparkSession, root: str, load_id: str) -> list[str]:
    frame = spark.read.schema(f"{PART} string").parquet(_at(root, load_id, "parts"))
    return sorted(r[0] for r in frame.collect())  # names of files, not rows


def _days(spark: SparkSession, root: str, load_id: str, name: str) -> list[datetime.date | None]:
    frame = spark.read.schema("table string, day date").parquet(_at(root, load_id, "days"))
    days = {r["day"] for r in frame.where(F.col("table") == name).collect()}
    return [*[None for d in days if d is None], *sorted(d for d in days if d is not None)]


def info(spark: SparkSession, root: str, load_id: str) -> dict:
    return spark.read.schema(INFO).parquet(_at(root, load_id, "info")).first().asDict()


def _n_bytes(spark: SparkSession, root: str, load_id: str) -> int:
    """About how many bytes the rows of a load take, also once they are gone."""
    known = info(spark, root, load_id)["n_bytes"]  # null in a record of an older version
    return folders.n_bytes(spark, _at(root, load_id, "rows")) if known is None else known


# --- the steps ------------------------------------------------------------------

def _rounds(months: Iterable[str], n_bytes: int) -> list[set[str]]:
    """The months of a table dealt to the rounds in which it is written; as no
    file has rows of two months, the files are those of a single write."""
    names = sorted(months)
    n = max(1, min(len(names), model.rounds(n_bytes)))
    return [set(names[i::n]) for i in range(n)]


def _replace(spark: SparkSession, root: str, load_id: str, name: str,
             rows_of: Callable[[list[set[str]], int], DataFrame], values: list, months: set[str], n_bytes: int) -> None:
    """Write new rows in place of the rows of a table whose partition is one of
    ``values``, beside the old files, and the table's index without the files
    that had such rows. ``months``: those of the new and the old rows;
    ``rows_of(rounds, i)``: the new rows of a round, which are all rows where
    there is one round; ``n_bytes``: about how many all new rows are read from."""
    table, column, schema = f"{root}/{name}", partition_of(name), table_schema(name)
    before = current(spark, root, load_id)
    old = None if before is None else file_index.read(spark, table, before)
    first = old is None or old.isEmpty()
    hit: set[str] = set()
    if first:  # nothing is published, so all there is was left by a broken run
        folders.delete(spark, table)
        index = None
    else:
        texts = [v if v is None else str(v) for v in values]
        touched = old.where(_among(F.col("part"), texts)).select("file").distinct()
        hit = {r["file"] for r in touched.collect()}  # names, not rows
        names = sorted({f"{model.FOLDER}={m}" for m in months} | {f.split("/")[0] for f in hit})
        known = {r["file"] for r in old.select("file").distinct().collect()}
        folders.delete(spark, *[f"{table}/{f}" for f in folders.files(spark, table, names) if f not in known])
        index = old.join(touched, "file", "left_anti")
    month, keys = layout(name)
    rounds = _rounds(months, n_bytes)
    round_of = {f"{model.FOLDER}={m}": i for i, own in enumerate(rounds) for m in own}
    for i in range(len(rounds)):
        rows, read_bytes = rows_of(rounds, i), n_bytes // len(rounds)
        if opened := sorted(f for f in hit if round_of.get(f.split("/")[0], 0) == i):
            # Rows of other days or parts in these files stay.
            rest = file_index.open_files(spark, table, schema, opened)
            rows = rows.unionByName(rest.where(~_among(F.col(column), values)))
            read_bytes += sum(folders.n_bytes(spark, f"{table}/{f}") for f in opened)
        model.write_table(rows, table, month, keys, model.write_parts(spark, read_bytes))
    if first:
        new = spark.read.schema(schema).parquet(table)
    else:
        new = file_index.open_files(spark, table, schema, [f for f in folders.files(spark, table, names) if f not in known])
    if first or new.inputFiles():
        found = file_index.entries(new, column, index_keys(name))
        index = found if index is None else index.unionByName(found)
    file_index.write(index, table, load_id)


#: The folder of rows of no month.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _months(days: Iterable[datetime.date | None]) -> set[str]:
    return {NO_MONTH if d is None else d.isoformat()[:7] for d in days}


def required(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``table``, whose write fails where one of the columns is null: the task
    that meets the row stops the job before any of its files is published."""
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} must not be null")).cast(table.schema[c].dataType))
               for c in columns if c in table.columns}
    return table.withColumns(checked)


def _replace_parts(spark: SparkSession, root: str, load_id: str) -> None:
    months = _months(_days(spark, root, load_id, "trips_pickup"))  # the load table's folders
    rows = _rows(spark, root, load_id)

    def rows_of(rounds: list[set[str]], i: int) -> DataFrame:
        if len(rounds) == 1:
            return rows
        month = F.coalesce(layout(LOAD)[0], F.lit(NO_MONTH))
        # The first round has what is in no other one.
        return rows.where(month.isin(*rounds[i]) if i else ~month.isin(*set().union(*rounds[1:])))

    _replace(spark, root, load_id, LOAD, rows_of, _parts(spark, root, load_id), months, _n_bytes(spark, root, load_id))


def _rebuild_days(spark: SparkSession, root: str, load_id: str, name: str) -> None:
    """The touched days of a model table from the whole load table, of which
    the files that can hold rows of these days are read."""
    days = _days(spark, root, load_id, name)
    source = model.DAY_SOURCE[name]
    key = "pickup_day" if source == "tpep_pickup_datetime" else "dropoff_day"
    first = current(spark, root, load_id) is None
    run_ts = info(spark, root, load_id)["run_ts"]

    def rows_of(rounds: list[set[str]], i: int) -> DataFrame:
        own = [d for d in days if len(rounds) == 1 or _months([d]) <= rounds[i]]

        def keep(index: DataFrame) -> DataFrame:
            # Files with rows of no day have no bounds or any.
            return index if None in own else file_index.holding(own, key)(index)

        whole = first and len(rounds) == 1  # the first load touches every day there is
        load = read(spark, root, LOAD, load_id, None if whole else keep)
        if not whole:
            load = load.where(_among(_day(source), own))
        return required(model.model_tables(load, run_ts)[name], model.REQUIRED)

    _replace(spark, root, load_id, name, rows_of, days, _months(days), _n_bytes(spark, root, load_id))


def _note_files(spark: SparkSession, root: str, load_id: str) -> None:
    files = spark.read.schema(FILE).parquet(_at(root, load_id, "files"))
    files.withColumn("state", F.lit("loaded")).coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/load={load_id}")


def _once(spark: SparkSession, root: str, load_id: str, step: str, run, *args) -> None:
    done = _at(root, load_id, f"_DONE-{step}")
    if not folders.exists(spark, done):
        run(spark, root, load_id, *args)
        folders.mark(spark, done)


def replay(spark: SparkSession, root: str, load_id: str) -> None:
    """Do what the record of a load says, apart from what is done already."""
    root = root.rstrip("/")
    with storing(spark):
        _once(spark, root, load_id, LOAD, _replace_parts)
        # The load table has the rows now.
        n_bytes = _n_bytes(spark, root, load_id)
        folders.delete(spark, _at(root, load_id, "rows"))
        # The model tables are projections of the load table.
        model.table_by_table(lambda t: _once(spark, root, load_id, t, _rebuild_days, t),
                             {t: len(table_schema(t)) for t in TABLES}, n_bytes)
        _once(spark, root, load_id, "ledger", _note_files)
        folders.mark(spark, _at(root, load_id, "_CLOSED"))
        clean(spark, root, load_id)


def clean(spark: SparkSession, root: str, load_id: str) -> None:
    """Remove the files that the load replaced, and what is left of its rows.
    Readers that began before the load closed must have ended."""
    root = root.rstrip("/")
    before = current(spark, root, load_id)
    for name in (LOAD, *TABLES) if before is not None else ():
        table = f"{root}/{name}"
        if not folders.exists(spark, file_index.version_path(table, before)):
            continue  # a run that broke off here removed it last
        used = {r["file"] for r in file_index.read(spark, table, load_id).select("file").distinct().collect()}
        gone = [r["file"] for r in file_index.read(spark, table, before).select("file").distinct().collect()
                if r["file"] not in used]
        full = {f.split("/")[0] for f in used}
        folders.delete(spark, *[f"{table}/{f}" for f in gone],
                       *[f"{table}/{m}" for m in {f.split("/")[0] for f in gone} - full])
        versions = folders.children(spark, f"{table}_index", folders=True)
        folders.delete(spark, *[f"{table}_index/{v}" for v in versions if v <= before])
    folders.delete(spark, _at(root, load_id, "rows"))
    folders.mark(spark, _at(root, load_id, "_CLEAN"))


def resume(spark: SparkSession, root: str) -> list[str]:
    """Finish the loads that broke off; returns their ids. What was not yet
    written down is removed."""
    ids = folders.children(spark, f"{root.rstrip('/')}/journal", folders=True)
    planned, closed, tidy = (set(loads(spark, root, m)) for m in ("_PLANNED", "_CLOSED", "_CLEAN"))
    folders.delete(spark, *[_at(root, i) for i in ids if i not in planned])
    for load_id in sorted(planned - closed):
        replay(spark, root, load_id)
    for load_id in sorted((planned & closed) - tidy):
        clean(spark, root, load_id)
    return sorted(planned - closed)


def load(staged: DataFrame, root: str, parts: Iterable[str] | None = None, files: DataFrame | None = None,
         run_ts: str | None = None, key: str | None = None) -> str | None:
    """Load the staged rows of some parts (A12, A14-A17): the parts replace
    what the load table has of them, and the model tables are rebuilt for the
    days that old or new rows of the parts touch; days and parts that end empty
    are gone. Returns the id of the load; null where a closed load has ``key``."""
    spark = staged.sparkSession
    resume(spark, root)
    if key is not None and any(info(spark, root, i)["key"] == key for i in loads(spark, root)):
        return None
    with storing(spark):
        load_id = plan(staged, root, parts, files, run_ts, key)
    replay(spark, root, load_id)
    return load_id


# --- the ledger -------------------------------------------------------------------

def loaded_files(spark: SparkSession, root: str) -> DataFrame:
    """The ledger's last row for each file: what is loaded of it now."""
    names = [n.split()[0] for n in LEDGER.split(", ")]
    last = ledger(spark, root).groupBy("path").agg(F.max_by(F.struct(*names), "load").alias("last"))
    return last.select("last.*")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Files that closed loads have taken (:data:`LEDGER`), each as often as it
    was loaded."""
    closed = loads(spark, root)
    root = root.rstrip("/")
    paths = [p for i in closed if folders.exists(spark, p := f"{root}/ledger/load={i}")]
    if not paths:
        return spark.createDataFrame([], LEDGER)
    frame = spark.read.schema(LEDGER).option("basePath", f"{root}/ledger").parquet(*paths)
    return frame.withColumn("load", F.lpad(F.col("load").cast("string"), 6, "0"))
