"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.session import scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters between words.
BLANKS = " \t\n\v\f\r"
#: Size up to which a lookup table is sent to every executor.
BROADCAST_BYTES = 4 << 20
#: Parts that a row group of one key is dealt to where a lookup is not broadcast.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint directory and read
    it back: later jobs neither recompute it nor depend on a live executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of exactly this name, also where it has a dot or a backtick."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, or with underscores in front where a column already has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that are equal for rows of equal id and text only (a null text
    counts as empty)."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                                  F.coalesce(text, F.lit("")))))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use``
    reads it inside a higher-order function."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lookup(left: DataFrame, table: DataFrame, left_key: str, key: str, salt: Column,
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of a lookup table with unique ``key`` (null matches null).

    The size of the table is measured: up to ``limit`` bytes it is broadcast,
    beyond that both sides are dealt by key and salt, so that a key with a
    third of all rows is spread over ``SALTS`` parts.
    """
    size = table.agg(F.sum(F.length(F.to_json(F.struct(*table.columns))) * 2 + 32)).first()[0] or 0
    part = fresh("salt", [*left.columns, *table.columns])
    if size <= limit:
        return left.join(F.broadcast(table), left[left_key].eqNullSafe(table[key]), "left").drop(table[key])
    left = left.withColumn(part, F.pmod(F.hash(salt), F.lit(SALTS)))
    other = table.withColumn("_" + part, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = left[left_key].eqNullSafe(other[key]) & (left[part] == other["_" + part])
    return left.join(other, on, "left").drop(other[key], left[part], other["_" + part])
