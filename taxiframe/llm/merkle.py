"""Merkle manifest of a dataset, and its versions by path copying.

Every row is a leaf, the SHA-256 of its fields. The leaves of a tree (one for
each language) stand in ascending order of the id; every ``ARITY`` consecutive
nodes have a parent until one node is left, the subroot. The subroots are the
leaves of one more tree, whose top is the root of the dataset.

The order is a distributed sort; the place of a leaf is its place in its
partition plus the counts of the partitions before. ``LEVELS`` levels are
built at a time by aligned blocks of ``BLOCK`` nodes, one block in a task's
memory. The tops of the blocks are the nodes of the next stage, so a tree of n
leaves takes log n / log BLOCK stages.

A tampered leaf makes a version of the tree. A version shares every node that
it doesn't touch and copies the ancestors of its leaf only: first those inside
the aligned block, then, along the path that the stages above have for the
block, the upper ones. No version is stored as a tree.

Nulls: a null field counts as ``-``, a null language comes first and has a tree
of its own, null ids come first in their tree. Ties of the id are ordered by
leaf, so repeated rows have their own places and equal leaves. A text of any
length is hashed whole where it is read and never moved. An empty table gives
an empty result. All columns of the results are the operator's own, whatever
other columns the input has.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import column, lookup, materialize

ARITY, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A tree without a name, where a column of names can be null.
NO_NAME = "0"

NODES = "tree string, index long, total long, digest string"
STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
PATHS = "tree string, index long, subroot string, root string, path array<struct<left: string, right: string>>"
PROVED = ("doc_id {}, tree string, index long, leaf string, subroot string, root string, proof string, "
          "version array<string>, folded_root string")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def lowered(text: Column) -> Column:
    """The tampered text: its letters A-Z in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tampered(doc_id: Column) -> Column:
    """Whether a row is tampered with."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", text: str = "text",
           fields: Iterable[str] = FIELDS) -> DataFrame:
    """``doc_id, tree, leaf, changed``: the tree (the language, marked so that a
    null has a name), the leaf, and the leaf after tampering (null: none)."""
    now = [column(f) for f in fields]
    then = [lowered(column(f)) if f == text else column(f) for f in fields]
    tree = F.coalesce(F.concat(F.lit("1"), column(group).cast("string")), F.lit(NO_NAME))
    return docs.select(column(doc_id).alias("doc_id"), tree.alias("tree"), leaf(now).alias("leaf"),
                       F.when(tampered(column(doc_id)), leaf(then)).alias("changed"))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``row`` (a number of their own), ``index`` (the place in
    their ``tree`` by ``order``, from 0) and ``total`` (the rows of the tree)."""
    # The last key spreads rows that are equal in all others.
    spread = rows.withColumn("row", F.monotonically_increasing_id())
    ordered = materialize(
        spread.orderBy("tree", *[F.col(c).asc_nulls_first() for c in order], "row")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    # A row for each partition and the trees in it.
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    runs = materialize(runs.select(
        F.concat_ws(":", "part", "tree").alias("run"), place.alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total")), f"{name}-runs")
    keyed = ordered.withColumn("of_run", F.concat_ws(":", "part", "tree"))
    return lookup(keyed, runs, "of_run", "run", F.col("at")).withColumn(
        "index", F.col("at") + F.col("shift")).drop("of_run", "part", "at", "shift")


def digest_of(nodes: Iterable[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def block_levels(digests: list[str], total: int, arity: int = ARITY, levels: int = LEVELS) -> list[list[str]]:
    """The levels of one aligned block, its nodes first and its top last;
    ``total``: the nodes of the whole tree, which ends when one is left."""
    out = [digests]
    while total > 1 and len(out) <= levels:
        digests = [digest_of(digests[i:i + arity]) for i in range(0, len(digests), arity)]
        out.append(digests)
        total = -(-total // arity)
    return out


def block_path(levels: list[list[str]], at: int, arity: int = ARITY) -> list[tuple[str, str]]:
    """The siblings of node ``at`` of a block by level, those before and those after it."""
    path = []
    for nodes in levels[:-1]:
        first = at - at % arity
        path.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + arity])))
        at //= arity
    return path


def copied(node: str, path: Iterable[tuple[str, str]]) -> list[str]:
    """The new ancestors of a changed node, from the lowest to the top."""
    out = []
    for left, right in path:
        node = digest_of((left, node, right))
        out.append(node)
    return out


def _block(key, nodes: pa.Table, arity: int, levels: int) -> pa.Table:
    nodes = nodes.sort_by("index")
    total = nodes.column("total")[0].as_py()
    top = block_levels(nodes.column("digest").to_pylist(), total, arity, levels)[-1][0]
    return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "index": pa.array([key[1].as_py()], pa.int64()),
                     "total": pa.array([-(-total // arity ** levels)], pa.int64()), "digest": pa.array([top], pa.string())})


def stages(nodes: DataFrame, name: str, arity: int = ARITY, levels: int = LEVELS) -> list[DataFrame]:
    """The nodes of each stage, from the leaves to the single top of each tree."""
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        grouped = out[-1].select("tree", "index", "total", "digest").groupBy(
            "tree", F.floor(F.col("index") / arity ** levels).alias("block"))
        out.append(materialize(grouped.applyInArrow(
            lambda key, table: _block(key, table, arity, levels), NODES), f"{name}-stage"))
    return out


def _steps(table: pa.Table) -> list[list[tuple[str, str]]]:
    return [[(s["left"], s["right"]) for s in p] for p in table.column("path").to_pylist()]


def _paths(nodes: pa.Table, above: pa.Table, arity: int, levels: int) -> pa.Table:
    """Paths of the nodes of a block from the path of its top."""
    nodes = nodes.sort_by("index")
    upper = _steps(above)[0]
    rows = block_levels(nodes.column("digest").to_pylist(), nodes.column("total")[0].as_py(), arity, levels)
    paths = [[{"left": a, "right": b} for a, b in [*block_path(rows, i, arity), *upper]] for i in range(nodes.num_rows)]
    n = nodes.num_rows
    return pa.table({"tree": nodes.column("tree").cast(pa.string()), "index": nodes.column("index").cast(pa.int64()),
                     "subroot": pa.array([above.column("subroot")[0].as_py()] * n, pa.string()),
                     "root": pa.array([above.column("root")[0].as_py()] * n, pa.string()),
                     "path": pa.array(paths, pa.list_(STEP))})


def _proofs(nodes: pa.Table, above: pa.Table, arity: int, levels: int) -> pa.Table:
    """Proofs and versions of the leaves of a block."""
    nodes = nodes.sort_by("index")
    upper, root = _steps(above)[0], above.column("root")[0].as_py()
    digests, changed = nodes.column("digest").to_pylist(), nodes.column("changed").to_pylist()
    rows = block_levels(digests, nodes.column("total")[0].as_py(), arity, levels)
    proofs, versions, folded = [], [], []
    for i, (old, new) in enumerate(zip(digests, changed, strict=True)):
        path = [*block_path(rows, i, arity), *upper]
        proofs.append(digest_of(a + b for a, b in path))
        # Every leaf is folded with its siblings, also one that is unchanged.
        node = old if new is None else new
        nodes_up = copied(node, path)
        folded.append(nodes_up[-1] if nodes_up else node)
        versions.append(nodes_up if node != old else None)
    n = nodes.num_rows
    return pa.table({"doc_id": nodes.column("doc_id"), "tree": nodes.column("tree").cast(pa.string()),
                     "index": nodes.column("index").cast(pa.int64()), "leaf": pa.array(digests, pa.string()),
                     "subroot": pa.array([above.column("subroot")[0].as_py()] * n, pa.string()),
                     "root": pa.array([root] * n, pa.string()), "proof": pa.array(proofs, pa.string()),
                     "version": pa.array(versions, pa.list_(pa.string())), "folded_root": pa.array(folded, pa.string())})


def _descend(nodes: DataFrame, above: DataFrame, make, schema: str, arity: int, levels: int) -> DataFrame:
    """``make`` for each block of ``nodes`` with the path of its top."""
    mine = nodes.groupBy("tree", F.floor(F.col("index") / arity ** levels).alias("block"))
    upper = above.withColumnRenamed("index", "block").groupBy("tree", "block")
    return mine.cogroup(upper).applyInArrow(lambda a, b: make(a, b, arity, levels), schema)


def node_paths(built: list[DataFrame], tops: DataFrame, arity: int, levels: int, last: int) -> DataFrame:
    """Paths of the nodes of stage ``last`` from those of the tops."""
    paths = tops
    for nodes in reversed(built[last:-1]):
        paths = materialize(_descend(nodes, paths, _paths, PATHS, arity, levels), "merkle-paths")
    return paths


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", text: str = "text",
             fields: Iterable[str] = FIELDS, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """One row per document: ``doc_id, tree, index, leaf, subroot, root, proof``
    (the digest of the siblings up to the root), ``version`` (the ancestors that
    tampering copies, the root of the version last; null where the leaf stays the
    same) and ``folded_root``."""
    found = materialize(leaves(docs, doc_id, group, text, fields), "merkle-leaves")
    nodes = materialize(numbered(found, ["doc_id", "leaf", "changed"], "merkle-order")
                        .withColumnRenamed("leaf", "digest").drop("row"), "merkle-nodes")
    built = stages(nodes, "merkle", arity, levels)
    subroots = built[-1].select("tree", F.col("digest").alias("subroot"))
    # The subroots, in the order of their trees, are the leaves of the last tree.
    top = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest")),
                   ["of"], "merkle-subroots")
    upper = stages(materialize(top.select("tree", "index", "total", "digest", "of"), "merkle-top"), "merkle-top", arity, levels)
    none = F.array().cast("array<struct<left: string, right: string>>")
    roots = upper[-1].select("tree", "index", F.lit("").alias("subroot"), F.col("digest").alias("root"), none.alias("path"))
    by_subroot = node_paths(upper, roots, arity, levels, 0).select("index", "root", "path")
    tops = upper[0].join(by_subroot, "index").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("index"), F.col("digest").alias("subroot"), "root", "path")
    proved = PROVED.format(nodes.schema["doc_id"].dataType.simpleString())
    return _descend(nodes, node_paths(built, tops, arity, levels, 1), _proofs, proved, arity, levels)
