"""Code-table lookups. The tables are a handful of entries, so they are inlined
as ``CASE`` expressions (constant, codegen'd, no join and no broadcast)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxiframe.schemas import CODE_TABLES, FLAG, UNKNOWN_CODE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lookup(col: Column | str, table: Mapping, default=None) -> Column:
    """``table[col]`` or ``default`` when the code is unknown or null."""
    c = _c(col)
    expr = None
    for code, label in table.items():
        cond = c == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def decode(name: str, col: Column | str | None = None, default=UNKNOWN_CODE) -> Column:
    """Label of a coded column (``payment_type``, ``RateCodeID``, ``VendorID``)."""
    return lookup(name if col is None else col, CODE_TABLES[name], default)


def flag_code(col: Column | str) -> Column:
    """Y -> 1, N -> 0, anything else null (SMALLINT, as staged)."""
    return lookup(col, FLAG).cast("smallint")


def flag_to_bool(col: Column | str) -> Column:
    """Y -> true, N -> false, anything else null."""
    return lookup(col, {k: bool(v) for k, v in FLAG.items()}).cast("boolean")
