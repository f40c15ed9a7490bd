"""Exact quantiles (linear interpolation) by narrowing brackets.

Spark's exact ``percentile`` merges the counts of every distinct value of a
group into one buffer, which for a global group is one task. Here each wanted
rank has a bracket of values, at first from the minimum to the maximum. One
pass counts the values of all brackets in ``BINS`` bins (partial sums by task,
then one small row per bin), and the bin that holds the rank, cut to its own
minimum and maximum, is the next bracket. The rank is found when its bin has a
single value. Only bins are shuffled, never values.

Interpolation is ``lo + (hi - lo) * (h - floor(h))`` with ``h = (n - 1) * p``,
the definition of pandas ``quantile`` and SQL ``quantile_cont``. Nulls, nan and
infinities are left out; a column without a finite value has no quantile.
"""

from __future__ import annotations

from math import floor, isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
SKETCH_ACCURACY = 10000
#: Every round leaves a smaller bracket; doubles allow far fewer.
MAX_ROUNDS = 400


def finite(df: DataFrame, cols: list[str], where: dict[str, Column] | None = None) -> DataFrame:
    """The columns as doubles, null unless finite and ``where[col]`` holds."""
    out = []
    for c in cols:
        v = F.col(c).cast("double")
        keep = F.abs(v) < F.lit(float("inf"))
        if where and c in where:
            keep = keep & where[c]
        out.append(F.when(keep, v).alias(c))
    return df.select(*out)


def rank_values(values: DataFrame, wanted: dict[str, set[int]],
                bounds: dict[str, tuple[float, float]]) -> dict[tuple[str, int], float]:
    """The value of each wanted 0-based rank of each column."""
    found: dict[tuple[str, int], float] = {}
    # By column and rank: rank inside the bracket, and the bracket.
    open_ranks = {(c, r): (r, *bounds[c]) for c, ranks in wanted.items() for r in ranks}
    for _ in range(MAX_ROUNDS):
        for key, (_, low, high) in list(open_ranks.items()):
            if low == high:
                found[key] = low
                del open_ranks[key]
        if not open_ranks:
            return found
        brackets = sorted({(c, low, high) for (c, _), (_, low, high) in open_ranks.items()})
        binned = []
        for i, (c, low, high) in enumerate(brackets):
            v = F.col(c)
            part = 1.0 if isfinite(high - low) else 2.0  # the width has to be finite
            share = (v / part - low / part) / (high / part - low / part)
            place = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
            binned.append(F.when(v.between(low, high), F.struct(
                F.lit(i).alias("bracket"), place.alias("bin"), v.alias("v"))))
        rows = (values.select(F.explode(F.filter(F.array(*binned), lambda x: x.isNotNull())).alias("b"))
                .groupBy("b.bracket", "b.bin")
                .agg(F.count(F.lit(1)).alias("n"), F.min("b.v").alias("low"), F.max("b.v").alias("high"))
                .collect())  # bins, not values
        by_bracket: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r["bracket"], r["bin"])):
            by_bracket.setdefault(r["bracket"], []).append(r)
        for key, (rank, low, high) in open_ranks.items():
            for r in by_bracket[brackets.index((key[0], low, high))]:
                if rank < r["n"]:
                    open_ranks[key] = (rank, r["low"], r["high"])
                    break
                rank -= r["n"]
    raise RuntimeError("the brackets did not close")


def quantiles(df: DataFrame, cols: list[str], probs: list[float],
              where: dict[str, Column] | None = None) -> dict[tuple[str, float], float | None]:
    """``{(col, p): value}``; None for a column without a finite value."""
    values = finite(df, cols, where)
    totals = values.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(cols)
                          for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    wanted, bounds, steps = {}, {}, {}
    for i, c in enumerate(cols):
        n = totals[f"n_{i}"]
        if n:
            bounds[c] = (totals[f"low_{i}"], totals[f"high_{i}"])
            steps[c] = [(p, (n - 1) * p) for p in probs]
            wanted[c] = {min(n - 1, floor(h) + j) for _, h in steps[c] for j in (0, 1)}
    found = rank_values(values, wanted, bounds)
    out: dict[tuple[str, float], float | None] = {(c, p): None for c in cols for p in probs}
    for c, ranks in steps.items():
        for p, h in ranks:
            low = found[c, floor(h)]
            part = h - floor(h)
            out[c, p] = low if part == 0 else low + (found[c, floor(h) + 1] - low) * part
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    where: dict[str, Column] | None = None) -> DataFrame:
    """``(name, p, value)`` for each column of ``df`` and each ``p``; no row for
    a column without a finite value."""
    rows = [(c, float(p), v) for (c, p), v in quantiles(df, cols, probs, where).items() if v is not None]
    return df.sparkSession.createDataFrame(rows, "name string, p double, value double")


def quantile_bounds(df: DataFrame, cols: list[str], low: float, high: float,
                    where: dict[str, Column] | None = None,
                    exact: bool = True) -> dict[str, tuple[float | None, float | None]]:
    """``{col: (q_low, q_high)}``: 2 numbers per column reach the driver, so
    the filters that use them are literals Parquet can push down. With
    ``exact=False`` a bounded ``percentile_approx`` sketch gives the bounds in
    one pass (rank error about 1 / SKETCH_ACCURACY)."""
    if not exact:
        row = finite(df, cols, where).agg(*[
            F.percentile_approx(c, [low, high], SKETCH_ACCURACY).alias(c) for c in cols]).first()
        return {c: tuple(row[c]) if row[c] else (None, None) for c in cols}
    found = quantiles(df, cols, [low, high], where)
    return {c: (found[c, low], found[c, high]) for c in cols}
