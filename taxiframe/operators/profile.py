"""Data-quality profile of raw trips: typed view, counts, ranges, quantile
trimming, duration and code checks, and per-rule retention.

Every counting operator is a single pass of conditional sums (one partial
aggregate per task, one tiny final merge), reshaped to long format with
``stack``; nothing is collected except the quantile bounds (2 numbers per
column) that become filter literals.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.functions import codes, datetimes, geo, numbers
from taxiframe.operators import clean
from taxiframe.operators.quantiles import exact_quantiles, quantile_bounds
from taxiframe.schemas import (CODE_TABLES, COORDINATES, DATETIMES, NUMBERS, RAW_COLUMNS,
                               nonzero_amount_columns)

TRIM = (0.02, 0.98)
PICKUP = ["pickup_longitude", "pickup_latitude"]
DROPOFF = ["dropoff_longitude", "dropoff_latitude"]
MIN_SECONDS, MAX_SECONDS = 1, 86400


def typed(raw: DataFrame) -> DataFrame:
    """Raw text as the profile reads it: coordinates and amounts as numbers,
    datetimes, codes as labels, each null where the text is missing, does not
    parse, is unknown or not finite; the flag stays text."""
    cols = {c: geo.finite_coord(c) for c in COORDINATES}
    cols.update({c: datetimes.parse_datetime(c) for c in DATETIMES})
    cols.update({c: codes.lookup(c, table) for c, table in CODE_TABLES.items()})
    cols.update({c: numbers.try_number(c) for c in NUMBERS})
    return raw.withColumns(cols)


def _long(agg_row: DataFrame, names: list[str], value_cols: list[str]) -> DataFrame:
    """Reshape a one-row aggregate with columns ``<name>__<value>`` to rows."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts.extend(f"`{n}__{v}`" for v in value_cols)
    expr = f"stack({len(names)}, {', '.join(parts)}) AS (column, {', '.join(value_cols)})"
    return agg_row.selectExpr(expr)


def coord_ranges(df: DataFrame, cols: list[str] = COORDINATES) -> DataFrame:
    """Min and max of each coordinate, one row per column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min_value"), F.max(c).alias(f"{c}__max_value")]
    return _long(df.agg(*aggs), cols, ["min_value", "max_value"])


def coord_quantiles(df: DataFrame, cols: list[str] = COORDINATES,
                    probs: tuple[float, float] = TRIM) -> DataFrame:
    """Exact quantiles of each column: ``(column, p, value)``."""
    return exact_quantiles(df, cols, list(probs)).withColumnRenamed("name", "column")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """E5: nulls per column in one pass."""
    cols = cols or df.columns
    aggs = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}__n_null") for c in cols]
    return _long(df.agg(*aggs), cols, ["n_null"])


def zero_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Zeros per column in one pass (nulls are not zeros)."""
    cols = cols or NUMBERS + COORDINATES
    aggs = [F.coalesce(F.sum((F.col(c) == 0).cast("bigint")), F.lit(0)).alias(f"{c}__n_zero")
            for c in cols]
    return _long(df.agg(*aggs), cols, ["n_zero"])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a column, nulls excluded."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def quantile_trim(df: DataFrame, probs: tuple[float, float] = TRIM,
                  exact: bool = True) -> DataFrame:
    """Keep rows inside the inclusive quantile range of each coordinate.

    As the profile does it: the longitude range is taken over all rows, the
    latitude range over the rows inside the longitude range, separately for
    pickup and dropoff; a row is kept when both its points are kept.
    ``exact=False`` takes the bounds from a bounded sketch instead (one pass
    per stage, for full-history runs).
    """
    return df.filter(trim_condition(df, probs, exact))


def trim_condition(df: DataFrame, probs: tuple[float, float] = TRIM, exact: bool = True) -> Column:
    """Whether a row of ``df`` is inside the quantile ranges; the bounds are
    found here and are literals of the condition."""
    low, high = probs
    def within(c: str, bounds: tuple) -> Column:
        return F.lit(False) if None in bounds else F.col(c).between(*bounds)

    lon = quantile_bounds(df, [PICKUP[0], DROPOFF[0]], low, high, exact=exact)
    inside = {c: within(c, lon[c]) for c in lon}
    lat = quantile_bounds(df, [PICKUP[1], DROPOFF[1]], low, high, exact=exact,
                          where={PICKUP[1]: inside[PICKUP[0]], DROPOFF[1]: inside[DROPOFF[0]]})
    return (inside[PICKUP[0]] & within(PICKUP[1], lat[PICKUP[1]])
            & inside[DROPOFF[0]] & within(DROPOFF[1], lat[DROPOFF[1]]))


def duration_ok(pickup: str = "tpep_pickup_datetime",
                dropoff: str = "tpep_dropoff_datetime") -> Column:
    secs = datetimes.seconds_between(pickup, dropoff)
    return (secs > MIN_SECONDS) & (secs < MAX_SECONDS)


def duration_check(df: DataFrame) -> DataFrame:
    """More than 1 second and less than 1 day (timestamps as columns)."""
    return df.filter(duration_ok())


def drop_unknown_codes(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows whose decoded code is null (unknown)."""
    return df.dropna("any", subset=cols or list(CODE_TABLES))


def drop_zero_amounts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C11: zero -> null, then drop nulls, over the amounts that must be
    non-zero (passenger count, distance, fare, total)."""
    cols = cols or nonzero_amount_columns(RAW_COLUMNS)
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in cols}).dropna("any", subset=cols)


def profile_rules(df: DataFrame, probs: tuple[float, float] = TRIM, exact: bool = True) -> dict[str, Column]:
    """The rules of the profile chain in order, true where a row of the typed
    view passes. Each is a condition on the row alone once the quantile bounds
    are known: the chain takes the bounds before its other rules."""
    known = [F.col(c).isNotNull() for c in CODE_TABLES]
    nonzero = [F.col(c) != 0 for c in nonzero_amount_columns(RAW_COLUMNS)]
    return {"quantile_trim": trim_condition(df, probs, exact), "duration": duration_ok(),
            "unknown_code": reduce(and_, known), "zero_amount": reduce(and_, nonzero)}


def first_failed(rules: dict[str, Column]) -> Column:
    """The name of the first rule that a row doesn't pass (a rule whose values
    are missing isn't passed); null where it passes all."""
    expr = None
    for name, passes in rules.items():
        fails = ~F.coalesce(passes, F.lit(False))
        expr = F.when(fails, F.lit(name)) if expr is None else expr.when(fails, F.lit(name))
    return expr


def profile_retention(df: DataFrame, probs: tuple[float, float] = TRIM, exact: bool = True) -> DataFrame:
    """E9 for the profile chain: ``(step, rule, rows_left, share_left,
    share_kept)`` with the rows left after each rule, their share of all rows
    and of the rows that the rule before left. Apart from the bounds it takes
    one pass: every row is counted once, by the first rule that it fails. An
    empty table has 0 rows at each step and no shares (null)."""
    rules = profile_rules(df, probs, exact)
    return retention(df.select(first_failed(rules).alias("reject_reason")), list(rules))


def profile_clean(raw: DataFrame) -> DataFrame:
    """H8: the notebook's chain C7 -> C9 -> C8 -> C10 -> C11."""
    return clean_typed(typed(raw))


def clean_typed(df: DataFrame) -> DataFrame:
    """H8 on the typed view, which is best read from a table: the quantile
    ranges take several passes over four of its columns."""
    return (df.transform(quantile_trim).transform(duration_check)
            .transform(drop_unknown_codes).transform(drop_zero_amounts))


def retention(judged: DataFrame, rules: list[str]) -> DataFrame:
    """``(step, rule, rows_left, share_left, share_kept)`` for rows that have
    the name of the first rule they fail as ``reject_reason``: one pass of
    conditional sums, then ``len(rules) + 1`` rows."""
    reason = F.col("reject_reason")
    counts = judged.agg(F.count(F.lit(1)).alias("raw"), *[F.count_if(reason == r).alias(r) for r in rules])
    left, steps = F.col("raw"), [("raw", F.col("raw"))]
    for r in rules:
        left = left - F.col(r)
        steps.append((r, left))
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"), e.alias("rows_left"),
                              steps[max(i - 1, 0)][1].alias("before")) for i, (name, e) in enumerate(steps)])
    out = counts.select("raw", F.explode(rows).alias("s")).select("raw", "s.*")
    share = lambda part, whole: F.round(F.try_divide(F.col(part), F.col(whole)), 6)
    return out.select("step", "rule", F.col("rows_left").cast("bigint").alias("rows_left"),
                      share("rows_left", "raw").alias("share_left"), share("rows_left", "before").alias("share_kept"))


def stage_retention(classified: DataFrame) -> DataFrame:
    """Rows left after each staging rule, from one pass over the
    reject reasons: ``(step, rule, rows_left, share_left)``."""
    return retention(classified, clean.REASONS).drop("share_kept")
