"""Hierarchical residual packing of tokenized documents.

Documents are tokenized and cut into pieces of at most ``size`` tokens. The
pieces of each length are dealt in turn to partitions of about ``part`` pieces, so
that none sees long or short ones only, however the rows are sorted. A partition
packs its pieces by best fit (largest first, into the sequence that they fit most
closely). Sequences with at most ``slack`` tokens free are emitted; the underfull
ones are items of the node above, which merges the items of ``fan_in`` nodes by
best fit again, and so on to the root of the tree, which emits all that is left.

Best fit looks at lengths only, so a node works on numbers of items by length (at
most ``size`` of them) whatever the table is: no item is ever left out or held
back, and a node's plan is a few thousand rules, each for a range of items of one
length. On the way down each node hands its children the rules for their items,
as ranges again. A piece finds its place by its rank among the pieces of its
length: its rank in its task plus the pieces of that length in the tasks before.

A null or empty text has the end token only; a very long text is cut into
pieces; pieces of equal length are interchangeable, so ties change no count;
repeated rows are packed each time; an empty table gives an empty result. The
result has the operator's own columns only, so other columns can have any
names. Pieces, plans and placements are written to the shared folder, so a lost
executor repeats its own tasks only.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import lookup, materialize

SIZE, END = 1024, 2
#: Pieces of a partition, nodes that a node merges, free tokens of a sequence
#: that is as good as full.
PART, FAN_IN, SLACK = 50_000, 16, 16
#: Words whose ids a task keeps.
CACHE = 400_000

BLANK_AFTER_SPACE = re.compile(r"\s ")

PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Ids(dict):
    """The ids of a blank-led word as bytes, computed once while kept."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self[word] = out = array("I", self.encode(word)).tobytes()
        return out


class TextEncoder:
    """Ids of whole texts.

    The tokenizer never joins what stands on both sides of a single blank, as
    a blank starts a new token. A text without white space in front of a blank
    is therefore encoded blank by blank, each distinct word once; any other
    text is encoded as a whole. ``ranks`` is the same vocabulary in the form
    of the faster library, which gives the same ids; it is not used for texts
    that name a special token.
    """

    def __init__(self, path: str, ranks: str | None) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.exact = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.plain = self.exact
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                           special_tokens={}).encode_ordinary
        self.ids = Ids(self.plain)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.exact(text), "<u4")
        if BLANK_AFTER_SPACE.search(text):
            return np.array(self.plain(text), "<u4")
        first, *words = text.split(" ")
        parts = map(self.ids.__getitem__, [" " + w for w in words])
        return np.frombuffer(array("I", self.plain(first)).tobytes() + b"".join(parts), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None) -> TextEncoder:
    return TextEncoder(path, ranks)


def cut(ids: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """``(piece, start, end)``: all pieces but the first have ``size`` ids."""
    first = len(ids) % size or min(len(ids), size)
    yield 0, 0, first
    for piece, start in enumerate(range(first, len(ids), size), 1):
        yield piece, start, start + size


def best_fit_plan(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit over ``counts[n]`` items of each length ``n``.

    Rules ``length, low, high, bin, offset``: the items of this length and of the
    ranks from ``low`` to before ``high`` go one each to the bins from ``bin`` on, at
    this offset. Bins ``used, low, high``: the bins from ``low`` to before ``high``
    hold so many tokens.
    """
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # ranges of bins by free space
    spaces = made = 0
    rules: list[tuple[int, int, int, int, int]] = []
    bins: list[tuple[int, int, int]] = []

    def put(free: int, low: int, high: int) -> None:
        nonlocal spaces
        if free and low < high:
            open_at[free].append((low, high))
            spaces |= 1 << free
        elif low < high:
            bins.append((size, low, high))

    def fill(n: int, rank: int, free: int, low: int, high: int, copies: int) -> int:
        for k in range(copies):  # one item for each bin, then the next
            rules.append((n, rank, rank + high - low, low, size - free + k * n))
            rank += high - low
        put(free - copies * n, low, high)
        return rank

    for n in range(size, 0, -1):
        rank, end = 0, int(counts[n])
        while rank < end:
            fitting = spaces >> n
            if fitting:
                free = n + (fitting & -fitting).bit_length() - 1
                low, high = open_at[free].pop()
                if not open_at[free]:
                    spaces &= ~(1 << free)
            else:
                free, low = size, made
                made = high = low - (-(end - rank) // (size // n))
            # A bin that got an item and has room for another fits the next most closely.
            full = min(high - low, (end - rank) // (free // n))
            if full:
                rank = fill(n, rank, free, low, low + full, free // n)
            if rank < end and low + full < high:
                rank = fill(n, rank, free, low + full, low + full + 1, end - rank)
                full += 1
            put(free, low + full, high)
    bins += [(size - free, low, high) for free, ranges in enumerate(open_at) for low, high in ranges]
    return np.array(sorted(rules), np.int64).reshape(-1, 5), np.array(sorted(bins), np.int64).reshape(-1, 3)


def underfull(bins: np.ndarray, size: int, slack: int, root: bool) -> np.ndarray:
    """Whether a node passes bins on to the node above; the root emits all."""
    return (bins[:, 0] < size - slack) & (not root)


def placements(counts: np.ndarray, above: np.ndarray, first_id: int, size: int, slack: int, root: bool) -> np.ndarray:
    """Where the items of a node end: rows ``length, low, high, sequence, offset``
    as the rules of :func:`best_fit_plan`, with sequences in place of bins.
    ``above``: such rows for the node's own underfull bins, which are ranked by
    their place among those of the same length; ``first_id``: the id of bin 0."""
    rules, bins = best_fit_plan(counts, size)
    homes: list[tuple[int, int, int, int]] = []  # bins from, to; sequence and offset of the first one
    ranks: dict[int, int] = {}
    for passed, (used, low, high) in zip(underfull(bins, size, slack, root), bins.tolist(), strict=True):
        if not passed:
            homes.append((low, high, first_id + low, 0))
            continue
        start = ranks.get(used, 0)
        ranks[used] = start + high - low
        mine = above[(above[:, 0] == used) & (above[:, 2] > start) & (above[:, 1] < ranks[used])]
        for _, a, b, sequence, offset in mine.tolist():
            x, y = max(a, start), min(b, ranks[used])
            homes.append((low + x - start, low + y - start, sequence + x - a, offset))
    homes.sort()
    starts = [h[0] for h in homes]
    out = []
    for n, rank, end, first, offset in rules.tolist():
        k = bisect_right(starts, first) - 1
        while k < len(homes) and homes[k][0] < first + end - rank:
            low, high, sequence, shift = homes[k]
            a, b = max(low, first), min(high, first + end - rank)
            out.append((n, rank + a - first, rank + b - first, sequence + a - low, shift + offset))
            k += 1
    return np.array(out, np.int64).reshape(-1, 5)


def ranks_within(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rank of each piece among those of its length; ``seen`` counts on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    ranks = np.empty(len(lengths), np.int64)
    ranks[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + seen[ordered]
    seen += np.bincount(lengths, minlength=len(seen))
    return ranks


def tokenize(docs: DataFrame, vocab: str | None = None, ranks: str | None = None, size: int = SIZE, end: int = END,
             doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if
    asked for, the ``ids``. ``vocab`` and ``ranks``: files of one vocabulary."""
    path, kind = vocab or vocabulary(), docs.schema[doc_id].dataType.simpleString()
    same = ranks if vocab else vocabulary("byte_bpe_50k.tiktoken")
    schema = PIECE.format(id=kind) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, same)
        for batch in batches:
            at, rows = [], []
            ids_of = []
            for i, t in enumerate(batch.column(1)):
                ids = np.append(enc.encode(t.as_py() or ""), np.uint32(end)).astype("<u4")
                for piece, a, b in cut(ids, size):
                    at.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    if with_ids:
                        ids_of.append(ids[a:b].astype("int32"))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()),
                      *[pa.array(c, pa.int64()) for c in columns[1:]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids_of, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def _counts(table: pa.Table, size: int) -> np.ndarray:
    counts = np.zeros(size + 1, np.int64)
    np.add.at(counts, table.column("length").to_numpy(), table.column("n").to_numpy())
    return counts


def _table(names: str, rows: np.ndarray, **extra: int) -> pa.Table:
    columns = {n: pa.array(rows[:, i], pa.int64()) for i, n in enumerate(names.split())}
    return pa.table({**{n: pa.array([v] * len(rows), pa.int64()) for n, v in extra.items()}, **columns})


def _id(level: int, node: int) -> int:
    """The id of the first sequence of a node: its level and number before 32
    bits for the sequence."""
    return (level << 27 | node) << 32


def merge_tree(leaves: DataFrame, nodes: int, size: int = SIZE, fan_in: int = FAN_IN, slack: int = SLACK) -> DataFrame:
    """``node, length, low, high, sequence, offset`` for the pieces of the leaves:
    the rows of :func:`placements`, for ``leaves`` (``node, length, n``) with the
    numbers 0 to ``nodes`` - 1."""
    levels, last = [leaves], nodes - 1
    # Upwards: the underfull bins of the children are the items of a node.
    while last:
        passed = levels[-1].groupBy("node").applyInArrow(lambda key, table: _passed(key, table, size, slack),
                                                         "node long, length long, n long")
        within = Window.partitionBy("parent", "length").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        up = passed.withColumn("parent", F.floor(F.col("node") / fan_in)).withColumn(
            "start", F.coalesce(F.sum("n").over(within), F.lit(0)))
        levels.append(materialize(up.select(F.col("parent").alias("node"), F.col("node").alias("child"), "length", "n",
                                            "start"), "packing-items"))
        last = last // fan_in
    # Downwards: a child gets the part of the rows that its items have.
    rows = "node long, length long, low long, high long, sequence long, offset long"
    above = leaves.sparkSession.createDataFrame([], rows)
    for level in range(len(levels) - 1, -1, -1):
        items, root = levels[level], level == len(levels) - 1
        placed = materialize(items.groupBy("node").cogroup(above.groupBy("node")).applyInArrow(
            _placer(level, size, slack, root), rows), "packing-places")
        if level:
            low = F.greatest(F.col("low"), F.col("start"))
            high = F.least(F.col("high"), F.col("start") + F.col("n"))
            above = items.join(placed, ["node", "length"]).where(
                (F.col("high") > F.col("start")) & (F.col("low") < F.col("start") + F.col("n"))).select(
                F.col("child").alias("node"), "length", (low - F.col("start")).alias("low"),
                (high - F.col("start")).alias("high"), (F.col("sequence") + low - F.col("low")).alias("sequence"), "offset")
    return placed


def _passed(key, table: pa.Table, size: int, slack: int) -> pa.Table:
    """The underfull bins of a node as numbers by length."""
    bins = best_fit_plan(_counts(table, size), size)[1]
    bins = bins[underfull(bins, size, slack, False)]
    counts = np.zeros(size + 1, np.int64)
    np.add.at(counts, bins[:, 0], bins[:, 2] - bins[:, 1])
    lengths = np.flatnonzero(counts)
    return _table("length n", np.column_stack([lengths, counts[lengths]]).astype(np.int64), node=key[0].as_py())


def _placer(level: int, size: int, slack: int, root: bool):
    """A function of a node's items and the rows that the node above has for it."""
    names = "length low high sequence offset"

    def place(items: pa.Table, above: pa.Table) -> pa.Table:
        if not items.num_rows:
            return _table(names, np.zeros((0, 5), np.int64), node=0)
        node = items.column("node")[0].as_py()
        rows = np.column_stack([above.column(n).to_numpy() for n in names.split()]).astype(np.int64).reshape(-1, 5)
        return _table(names, placements(_counts(items, size), rows, _id(level, node), size, slack, root), node=node)

    return place


def pack(pieces: DataFrame, size: int = SIZE, part: int = PART, fan_in: int = FAN_IN, slack: int = SLACK) -> DataFrame:
    """``pieces`` (``doc_id, piece, start, length, ids_crc32``) with
    ``sequence_id`` and ``offset``. ``part``: pieces of a partition; ``fan_in``: nodes
    that a node of the tree merges; ``slack``: free tokens with which a sequence
    counts as full."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    fields = PIECE.format(id=kind)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            ranks = ranks_within(batch.column(3).to_numpy(), seen)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(ranks), pa.int64()), pa.array(ranks, pa.int64())],
                [*names, "task", "rank"])

    rows = materialize(pieces.select(names).mapInArrow(ranked, fields + ", task long, rank long"), "ranked-pieces")
    slot = (F.col("task") * (size + 1) + F.col("length")).alias("slot")
    by_task = materialize(rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select(slot, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # The small table is read twice (its size, the join), so it is written once.
    earlier = materialize(earlier.withColumnRenamed("slot", "of_slot"), "piece-offsets")
    whole = lookup(rows.select("*", slot), earlier, "slot", "of_slot", F.col("rank")).withColumn(
        "rank", F.col("rank") + F.col("earlier"))

    # Leaves of equal shares: the pieces of a length go to them in turn.
    totals = by_task.groupBy("length").agg(F.sum("n").alias("total"))
    nodes = max(1, ceil((totals.agg(F.sum("total")).first()[0] or 0) / part))
    share = F.floor((F.col("total") - F.col("node") + nodes - 1) / nodes).alias("n")
    leaves = materialize(totals.select("length", "total", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))).alias("node")).select("node", "length", share).where("n > 0"), "packing-leaves")
    placed = merge_tree(leaves, nodes, size, fan_in, slack).withColumnsRenamed({"node": "leaf", "length": "of_length"})
    dealt = whole.select(*names, (F.col("rank") % nodes).alias("in_leaf"), F.floor(F.col("rank") / nodes).alias("nth"))
    # The ranges of a length in a leaf don't overlap, and each rank is in one.
    here = (F.col("in_leaf") == F.col("leaf")) & (F.col("length") == F.col("of_length")) & (
        F.col("nth") >= F.col("low")) & (F.col("nth") < F.col("high"))
    return dealt.join(placed, here).select(*names, (F.col("sequence") + F.col("nth") - F.col("low")).alias("sequence_id"), "offset")
