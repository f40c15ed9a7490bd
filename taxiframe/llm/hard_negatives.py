"""Hard negatives by slots of scores.

An anchor is a row of the query set; its score with another row is the inner
product of their whole-number vectors. Its positives are the first rows of its
label, its negatives those of other labels. A positive of score p takes the
first negatives of a score from ``LOW`` to ``HIGH`` percent of p.

The windows of an anchor's positives overlap, so negatives are not searched
once for each. The upper limits of the windows cut the scores into disjoint
slots: slot j reaches from limit j down to limit j + 1, the last one to the
lowest lower limit. One pass keeps the first ``TAKE`` negatives of each slot;
a window is a suffix of the slots in descending order, cut at its lower limit,
so the merge of the suffix answers it exactly.

Anchors and rows meet in cells of a grid: anchors are dealt to its columns and
rows to its lines, a cell has some ``BLOCK_BYTES`` of each side whatever the
sizes of the table and of its labels, and multiplies them as matrices. A cell
emits its first rows of a label or slot only; they are combined by task before
the shuffle (the group limit of a window), then by anchor.

Rows with a null label, a null vector, or a component that is null or not
finite take no part; neither as anchors do rows of a null id. A row of a null
id comes after all other rows of its score. Repeated rows are rows of their own
(an anchor meets its copy). An empty vector has the score 0 with any other; in a
product of vectors of different lengths the missing components count as 0.
Products are exact; those beyond a 64-bit number count as its limit. An empty
table gives an empty result; all columns of the result are the operator's own.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import column, materialize

POSITIVES, TAKE = 5, 3
#: Percent of a positive's score.
LOW, HIGH = 50, 95
#: Bytes of vectors that a cell takes from each side.
BLOCK_BYTES = 4 << 20
#: Products in memory at once.
PRODUCTS = 1 << 21

BEST = "anchor long, score long, id long, row long"
SLOTTED = "anchor long, slot int, score long, id long, row long"


def prepared(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, vector, label`` of the rows that take part, as whole numbers; every
    seventh id has the next label, the remainder of a negative one is negative."""
    x = column(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    ident, given = column(vec_id).cast("long"), column(label).cast("long")
    moved = F.when(ident % 7 == 0, (given + 1) % 10).otherwise(given)
    whole = F.transform(x, lambda v: _floor(F.lit(256.0) * v.cast("double")))
    return rows.where(given.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        ident.alias("id"), whole.alias("vector"), moved.alias("label"))


def _floor(v: Column) -> Column:
    """Largest whole number, as a double of any size."""
    return F.when(F.abs(v) < 2.0 ** 52, F.floor(v).cast("double")).otherwise(v)


def is_anchor(ident: Column, every: int = 50) -> Column:
    return F.coalesce(ident % every == 0, F.lit(False))


def matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors of a table as rows of ``width`` components."""
    vectors = table.column("vector").combine_chunks()
    lengths, values = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    for row, part in zip(out, np.split(values, np.cumsum(lengths)[:-1]), strict=True):
        row[:len(part)] = part
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    largest = max(1, a.shape[1]) * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if largest < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)  # every partial sum is exact
    if largest < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    limit = np.iinfo(np.int64).max
    exact = np.array([[int(v) for v in row] for row in a], object).reshape(a.shape) @ np.array(
        [[int(v) for v in row] for row in b], object).reshape(b.shape).T
    return np.array([[min(max(int(v), -limit), limit) for v in row] for row in exact], np.int64).reshape(
        len(a), len(b))


class _Side:
    """Columns of one side of a cell."""

    def __init__(self, table: pa.Table, width: int):
        self.row = table.column("row").to_numpy()
        self.id = table.column("id").fill_null(0).to_numpy()
        self.label = table.column("label").to_numpy()
        self.vector = matrix(table, width)
        self.null_id = table.column("id").is_null().to_numpy(zero_copy_only=False)


def _first(scores: np.ndarray, rows: _Side, places: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of ``at`` the first ``k`` by score, id and row; score i belongs to row ``places[i]``."""
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((rows.row[places[at]], rows.id[places[at]], rows.null_id[places[at]], -scores[at]))[:k]]


def _blocks(n: int, width: int) -> list[slice]:
    step = max(1, PRODUCTS // max(1, width))
    return [slice(i, i + step) for i in range(0, n, step)]


def _found(columns: dict[str, list], rows: _Side, picked: list[np.ndarray]) -> pa.Table:
    at = np.concatenate(picked) if picked else np.empty(0, np.int64)
    return pa.table({**{n: np.concatenate(c) if c else np.empty(0, np.int32 if n == "slot" else np.int64)
                        for n, c in columns.items()},
                     "id": pa.array(rows.id[at], mask=rows.null_id[at]), "row": rows.row[at]})


def _best_of_label(anchors: pa.Table, table: pa.Table, width: int, k: int) -> pa.Table:
    """The first ``k`` rows of its own label for each anchor of a cell."""
    a, b = _Side(anchors, width), _Side(table, width)
    out, picked = {"anchor": [], "score": []}, []
    for label in np.intersect1d(a.label, b.label):
        mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)
        for part in _blocks(len(mine), len(theirs)):
            for i, scores in zip(mine[part], products(a.vector[mine[part]], b.vector[theirs]), strict=True):
                others = np.flatnonzero(b.row[theirs] != a.row[i])
                at = _first(scores, b, theirs, others, k)
                out["anchor"].append(np.full(len(at), a.row[i]))
                out["score"].append(scores[at])
                picked.append(theirs[at])
    return _found(out, b, picked)


def _best_of_slots(anchors: pa.Table, table: pa.Table, width: int, k: int) -> pa.Table:
    """The first ``k`` rows of other labels in each slot of each anchor of a cell."""
    a, b = _Side(anchors, width), _Side(table, width)
    uppers, lowest = anchors.column("uppers").to_pylist(), anchors.column("lowest").to_numpy()
    out, picked, every = {"anchor": [], "slot": [], "score": []}, [], np.arange(len(b.row))
    for part in _blocks(len(a.row), len(b.row)):
        for i, scores in zip(range(len(a.row))[part], products(a.vector[part], b.vector), strict=True):
            edges = np.array([*uppers[i], lowest[i] - 1])  # slot j: above edge j + 1, up to edge j
            at = np.flatnonzero((scores <= edges[0]) & (scores > edges[-1]) & (b.label != a.label[i]))
            for slot in range(len(edges) - 1) if len(at) else ():
                inside = at[(scores[at] <= edges[slot]) & (scores[at] > edges[slot + 1])]
                best = _first(scores, b, every, inside, k)
                out["anchor"].append(np.full(len(best), a.row[i]))
                out["slot"].append(np.full(len(best), slot, np.int32))
                out["score"].append(scores[best])
                picked.append(best)
    return _found(out, b, picked)


def _grid(anchors: DataFrame, rows: DataFrame, lines: int, columns: int, make, schema: str) -> DataFrame:
    """``make`` for each cell: anchors by grid column, rows by grid line."""
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("column", dealt(columns)).withColumn("line", each(lines))
    b = rows.withColumn("line", dealt(lines)).withColumn("column", each(columns))
    return a.groupBy("line", "column").cogroup(b.groupBy("line", "column")).applyInArrow(make, schema)


def _top(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first ``k`` rows by score, id and row for each key; the limit also
    holds inside each task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lower_limit(score: Column, low: int = LOW) -> Column:
    """The least whole number n with ``low * score <= 100 * n`` (no overflow)."""
    return -_part(-score, low)


def upper_limit(score: Column, high: int = HIGH) -> Column:
    """The largest whole number n with ``100 * n <= high * score``."""
    return _part(score, high)


def _part(score: Column, percent: int) -> Column:
    """``percent * score / 100``, rounded down, for any 64-bit score."""
    wide = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(4,0)")
    return F.floor(wide / F.lit(100).cast("decimal(4,0)")).cast("long")


def mine(rows: DataFrame, every: int = 50, positives: int = POSITIVES, take: int = TAKE, low: int = LOW,
         high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for prepared rows (``id, vector, label``)."""
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    asked = is_anchor(F.col("id"), every)
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(asked).alias("anchors"),
                     F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    width, in_block = sizes["width"], max(1, block_bytes // (8 * max(1, sizes["width"])))
    lines, columns = max(1, ceil(sizes["rows"] / in_block)), max(1, ceil(sizes["anchors"] / in_block))
    anchors = rows.where(asked).select(*[F.col(c).alias(c) for c in rows.columns])  # columns of their own
    found = _grid(anchors, rows, lines, columns, lambda a, b: _best_of_label(a, b, width, positives), BEST)
    best = materialize(_top(found, positives, "anchor").select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        lower_limit(F.col("score"), low).alias("lower"), upper_limit(F.col("score"), high).alias("upper")), "positives")
    windows = best.where("lower <= upper").groupBy("anchor").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("lowest"))
    limited = anchors.join(windows.withColumnRenamed("anchor", "row"), "row")
    found = _grid(limited, rows, lines, columns, lambda a, b: _best_of_slots(a, b, width, take), SLOTTED)
    # At most `take` entries for each of at most `positives` slots of an anchor.
    entry = F.struct("slot", (-F.col("score")).alias("minus"), F.col("id").isNull().alias("no_id"), "id", "row")
    slots = _top(found, take, "anchor", "slot").groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    asked_for = best.where("lower <= upper").join(windows.select("anchor", "uppers"), "anchor").join(slots, "anchor")
    # The suffix of the slots from the positive's own one, in descending order.
    first = F.array_position("uppers", F.col("upper")) - 1
    suffix = F.filter("entries", lambda e: (e["slot"] >= first) & (-e["minus"] >= F.col("lower")))
    ids = rows.where(asked).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    picked = asked_for.withColumn("taken", F.slice(suffix, 1, take)).join(ids, "anchor").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode("taken").alias("at", "negative"))
    return picked.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                         F.col("negative.id").alias("negative_id"), "positive_score",
                         (-F.col("negative.minus")).alias("negative_score"))
