"""Text-to-number parsing with the reference's acceptance rules, as Catalyst
expressions (no Python UDF: every function returns a ``Column``).

The reference evaluates amounts as Python literals and coordinates with
``float()``; anything that fails becomes the integer 0. Spark's ``try_cast``
alone is too lenient (it takes ``nan``, ``5d``, ``1f``), so a regular
expression decides first which texts are numbers at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Python integer literal: optional sign, then 0, 00.. or a digit string
# without a leading zero (``007`` is not a literal, ``00`` is).
INT_TEXT = r"^\s*[+-]?(0+|[1-9][0-9]*)\s*$"
# A Python int or float literal (a float has a dot and/or an exponent).
LITERAL_TEXT = (r"^\s*[+-]?(0+|[1-9][0-9]*|[0-9]+\.[0-9]*([eE][+-]?[0-9]+)?"
                r"|\.[0-9]+([eE][+-]?[0-9]+)?|[0-9]+[eE][+-]?[0-9]+)\s*$")
# What ``float()`` accepts: any decimal (leading zeros allowed), nan, inf.
FLOAT_TEXT = (r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?"
              r"|nan|inf|infinity)\s*$")
# Amounts as nearly all lines have them: no sign, no space, no exponent, at most 13 digits.
# Told apart at a quarter of the time that LITERAL_TEXT takes.
PLAIN_TEXT = r"^(?:0|[1-9][0-9]{0,8})(?:\.[0-9]{1,4})?\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_int_text(col: Column | str) -> Column:
    return F.coalesce(_c(col).rlike(INT_TEXT), F.lit(False))


def try_number(col: Column | str) -> Column:
    """Python-literal number; null where the text is none (``0.5.1``, empty,
    null, ``007``, ``nan``) or beyond what a double holds."""
    c = _c(col)
    value = F.when(c.rlike(LITERAL_TEXT), F.trim(c).try_cast("double"))
    return (F.when(c.rlike(PLAIN_TEXT), c.try_cast("double"))
            .otherwise(F.when(F.abs(value) < F.lit(float("inf")), value)))


def parse_number(col: Column | str) -> Column:
    """Python-literal number or 0."""
    return F.coalesce(try_number(col), F.lit(0.0))


def parse_float(col: Column | str) -> Column:
    """``float()`` semantics: number, nan or +/-inf; null where it would raise.
    (Spark's cast reads nan/inf/infinity case-insensitively; the guard keeps
    out what Python rejects, like ``5d`` or hex.)"""
    c = _c(col)
    return F.when(c.rlike(FLOAT_TEXT), F.trim(c).try_cast("double"))


def float_text(value: Column) -> Column:
    """The text Python prints for a float: plain from 1e-4 up to 1e16, else
    with an exponent of at least two digits (``1e+16``, ``1.5e-05``)."""
    text, size = value.cast("string"), F.abs(value)
    # The JVM switches to an exponent at 1e7 and below 1e-3.
    plain = F.when(size < 1, value.try_cast("decimal(38,25)")).otherwise(value.try_cast("decimal(38,17)"))
    plain = F.regexp_replace(F.regexp_replace(plain.cast("string"), r"0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    scientific = F.concat(mantissa, F.lit("e"), F.when(power < 0, F.lit("-")).otherwise(F.lit("+")),
                          F.lpad(F.abs(power).cast("string"), F.when(F.abs(power) > 99, 3).otherwise(2), "0"))
    return (F.when(~text.contains("E"), text)
            .when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific))


def int_text(text: Column) -> Column:
    """The text Python prints for an integer literal of any length."""
    body = F.ltrim(text, F.lit("+"))
    return F.when(F.translate(body, "+-0", "") == "", F.lit("0")).otherwise(body)


def number_text(col: Column | str) -> Column:
    """The text Python prints for the parsed number (as used inside the trip id).

    Integer literals print as they stand (``10``, any length), floats with a
    fraction or an exponent (``1.5``, ``15300000.0``, ``1e+16``); a failed
    parse is the integer 0 (``0``). A plain text without zeros at its end is
    that text already.
    """
    text, c = _c(col), F.trim(_c(col))
    short = ~text.endswith("0") | ~text.contains(".") | text.endswith(".0")
    return (F.when(text.rlike(PLAIN_TEXT) & short, text)
            .when(c.rlike(INT_TEXT), int_text(c))
            .when(c.rlike(LITERAL_TEXT), float_text(c.try_cast("double")))
            .otherwise(F.lit("0")))


def round_to(value: Column, digits: int) -> Column:
    """``round(value, digits)`` of a double, halves away from zero. One that has no more
    digits stays as it is, which spares the way over its decimal text."""
    scale = float(10 ** digits)
    same = F.floor(value * scale + 0.5) / scale
    return F.when((same == value) & (F.abs(value) < 1e15 / scale), same).otherwise(F.round(value, digits))


def is_whole(value: Column) -> Column:
    return value == F.floor(value)


def round_half_away(value: Column) -> Column:
    """Round to an integer, halves away from zero (warehouse float->INTEGER)."""
    return F.round(value, 0).cast("bigint")
