"""Code lookup with a table as the dimension (D4, B6 beyond a handful of codes).

Small code tables are ``CASE`` expressions (``functions.codes``). A code table
that is data is joined: its size is measured, up to a limit it is broadcast,
beyond that both sides are shuffled by code. Codes that many rows have are
dealt over ``SALTS`` parts in the shuffled form, so a code with a third of all
rows doesn't land in one task; the dimension rows of these codes are copied to
each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.schemas import UNKNOWN_CODE

#: Bytes of a dimension (code and label) that is sent to every executor.
BROADCAST_BYTES = 8 << 20
SALTS = 32
#: A code with a larger share of the rows than one in so many is hot.
HOT_SHARE = 200


def dimension(table: DataFrame, code: str, label: str) -> DataFrame:
    """``code, label`` of a table as text: one row per code. Rows without a
    code are left out; of several labels of a code the least one counts, a
    missing label only where there is no other."""
    return (table.select(F.col(code).cast("string").alias("code"), F.col(label).cast("string").alias("label"))
            .where("code IS NOT NULL").groupBy("code").agg(F.min("label").alias("label")))


def measured_bytes(dim: DataFrame) -> int:
    """Bytes of a dimension, with 32 for each row's overhead."""
    size = F.octet_length("code") + F.coalesce(F.octet_length("label"), F.lit(0)) + 32
    return dim.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def hot_codes(rows: DataFrame, code: Column, share: int = HOT_SHARE) -> list[str]:
    """Codes that more than one in ``share`` rows have: fewer than ``share``
    codes, found from counts by code that are combined before the shuffle."""
    counts = rows.select(code.alias("code")).where("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    return [r["code"] for r in counts.where(F.col("n") * share > total).collect()]


def lookup_join(rows: DataFrame, table: DataFrame, code: str, key: str, label: str, name: str,
                default: str = UNKNOWN_CODE, broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS,
                hot_share: int = HOT_SHARE) -> DataFrame:
    """``rows`` with the column ``name``: the label that ``table`` (``key``,
    ``label``) has for the code in column ``code``, or ``default`` for a code
    that is null, unknown or has no label. Every row stays exactly once."""
    if name in rows.columns:
        raise ValueError(f"the rows have a column {name!r} already")
    dim = dimension(table, key, label).withColumnsRenamed({"code": "_dim_code", "label": "_dim_label"})
    text = F.col(code).cast("string")
    measured = measured_bytes(dim.withColumnsRenamed({"_dim_code": "code", "_dim_label": "label"}))
    if measured <= broadcast_bytes:
        joined = rows.join(F.broadcast(dim), text == F.col("_dim_code"), "left")
    else:
        joined = _salted(rows, dim, text, hot_codes(rows, text, hot_share), salts)
    return joined.withColumn(name, F.coalesce("_dim_label", F.lit(default))).select(*rows.columns, name)


def _salted(rows: DataFrame, dim: DataFrame, text: Column, hot: list[str], salts: int) -> DataFrame:
    """Shuffled left join; the rows of hot codes, and those without a code, are
    dealt over ``salts`` parts, and so are copies of the hot codes' labels."""
    spread = text.isNull() | text.isin(hot) if hot else text.isNull()
    part = F.when(spread, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0))
    parts = F.when(F.col("_dim_code").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))) if hot else F.array(F.lit(0))
    left = rows.withColumn("_part", part.cast("int"))
    right = dim.withColumn("_dim_part", F.explode(parts)).hint("merge")
    return left.join(right, (text == F.col("_dim_code")) & (F.col("_part") == F.col("_dim_part")), "left")
