"""The tables by name: database, load table and model tables in the session's
catalog, filled by name (A12, A13, A15-A17).

Every statement can be repeated: what exists stays as it is. Columns that must
not be null are declared so, and a write by name is checked row by row while it
runs: a null stops the job before any of its files is published. The tables are
external, so their files outlive the session's catalog; a later session attaches
the same folders and finds their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.operators import model
from taxiframe.session import storing
from taxiframe.sources import folders, journal

LOAD_TABLE = "tripdata_tmp"
#: Tables and the folders of a warehouse that hold them.
FOLDERS = {LOAD_TABLE: journal.LOAD, **{t: t for t in journal.TABLES}}


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def required_columns(table: str) -> list[str]:
    """Columns of a table that must not be null."""
    if table == LOAD_TABLE:
        return []
    names = journal.table_schema(table).fieldNames()
    return [c for c in model.REQUIRED if c in names]


def definition(table: str) -> str:
    """The column list of a table, its folder column last."""
    schema, needed = journal.table_schema(FOLDERS[table]), required_columns(table)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" + (" NOT NULL" if f.name in needed else "") for f in schema.fields]
    return ", ".join([*columns, f"`{model.FOLDER}` string"])


def create_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """The database and its tables over the folders of ``root``, where they
    are absent; returns the tables created. Partitions that the folders hold
    already are found."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    made = []
    for table, folder in FOLDERS.items():
        name = f"{database}.{table}"
        if not spark.catalog.tableExists(name):
            place = f"{root.rstrip('/')}/{folder}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({definition(table)}) USING parquet "
                      f"PARTITIONED BY (`{model.FOLDER}`) LOCATION '{place}'")
            made.append(table)
            if folders.exists(spark, place):
                find_partitions(spark, name)
    return made


def find_partitions(spark: SparkSession, name: str) -> None:
    """Take up partitions that were written to a table's folder by a load."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def append(rows: DataFrame, name: str, parts: int | None = None) -> None:
    """Append rows to one of the tables by name and by the names of its
    columns; rows with other columns are refused, and a null in a required
    column stops the write. ``parts``: tasks of the write."""
    spark, table = rows.sparkSession, name.split(".")[-1]
    columns = journal.table_schema(FOLDERS[table]).fieldNames()
    if sorted(rows.columns) != sorted(columns):
        raise ValueError(f"{name} has the columns {columns}, not {rows.columns}")
    checked = journal.required(rows.select(*columns), required_columns(table))
    month, keys = journal.layout(FOLDERS[table])
    parts = parts or spark.sparkContext.defaultParallelism
    # Appended beside what is there, whatever the session says of overwriting.
    with storing(spark):
        model.laid_out(checked, month, keys, parts).write.insertInto(name, overwrite=False)


def fill_model(spark: SparkSession, database: str, run_ts: str | None = None, parts: int | None = None) -> None:
    """Insert the three model tables from the load table, all by name.
    ``parts``: tasks of each write."""
    load = spark.table(f"{database}.{LOAD_TABLE}").drop(journal.PART, model.FOLDER)
    made = model.model_tables(load, run_ts)
    # The widest first, while least is on disk beside its shuffle files.
    for table in sorted(journal.TABLES, key=lambda name: len(made[name].columns), reverse=True):
        append(made[table], f"{database}.{table}", parts)


def drop_tables(spark: SparkSession, database: str) -> None:
    """Forget the names; the files stay."""
    for table in FOLDERS:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{database}.{table}')}")
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(database)}")


def row_counts(spark: SparkSession, database: str) -> DataFrame:
    """``(table_name, n_rows)`` of the tables of a database."""
    parts = [spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), "n_rows") for t in FOLDERS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
