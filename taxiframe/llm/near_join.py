"""N-gram Jaccard join by MinHash prefixes with exact verification.

Two texts are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8 (shorter texts have one shingle, all their words).

1. Texts with equal shingle sets are a class; one member represents it.
2. A representative gets ``TREES`` MinHash signatures of ``DEPTH`` values. In
   each tree, representatives with the same prefix of the signature meet. The
   prefix has one length for all, the longest with which a pair at the threshold
   meets in some tree with the probability ``RECALL``: bands of a forest, whose
   prefixes are not sorted and not shortened by the matches found.
3. Meeting makes candidates, chained to components by hooking and contracting
   (member, smallest member) rows: a tree node of ``m`` members has ``m`` rows,
   never its pairs.
4. The texts of a component go to one task, those of a component above
   ``PART`` members to one task for each two parts of it. The task checks all
   pairs by their exact shingle sets, also those that meet in no tree. It
   returns the links of each text as a number and a spanning forest of them.
5. The forests are chained to classes of near copies.

Every pair of a component is verified, in groups of any size; no bucket is cut.
A null text counts as empty; texts without words are a class of their own and
equal to each other. Null ids and repeated rows are documents like any other.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import column, fresh, materialize, row_key

SHINGLE, SIMILARITY = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9995
#: Representatives of a component that one task holds, from one side.
PART = 128
#: Multipliers and offsets of the MinHash functions, from a fixed seed.
SEED = 20240229
MASK = np.uint64(0xFFFFFFFF)


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH,
                  recall: float = RECALL) -> int:
    """The longest prefix with which a pair of this similarity meets in some
    tree with the probability ``recall``; 1 if none is short enough."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of the shingles, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    table: dict[bytes, int] = {}
    codes = np.fromiter((table.get(w) or table.setdefault(w, word_hash(w)) for w in words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(SHINGLE, len(words))):
            mixed = (mixed ^ codes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` MinHash values of a set in each tree."""
    random = np.random.default_rng(SEED).integers(0, 1 << 64, (3, TREES, DEPTH), dtype=np.uint64)
    a, b, c = (x[:, :length].ravel() for x in random)
    low, high = hashes & MASK, hashes >> np.uint64(32)
    out = np.full(TREES * length, ~np.uint64(0))
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 512):
            mixed = low[i:i + 512, None] * a
            mixed += high[i:i + 512, None] * b
            mixed += c
            out = np.minimum(out, mixed.min(0))
    return (out >> np.uint64(32)).reshape(TREES, length)


def prefixes(hashes: np.ndarray, length: int) -> list[int]:
    """A hash of the prefix of the signature in each tree."""
    if not len(hashes):
        return []
    parts = signature(hashes, length)
    mixed = np.arange(TREES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            mixed = (mixed ^ parts[:, i]) * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed ^= mixed >> np.uint64(31)
    return mixed.astype(np.int64).tolist()


def sketch(length: int):
    """A function for a pandas UDF: the class hash and the tree nodes of texts."""
    import xxhash

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            s = shingles(t)
            rows.append((xxhash.xxh3_128_digest(s.tobytes()), len(s), prefixes(s, length)))
        return pd.DataFrame(rows, columns=["same", "size", "nodes"])

    return run


def components(links: DataFrame, name: str) -> DataFrame:
    """``member, root`` for the members of ``links`` (``a, b``): the smallest
    member that can be reached.

    Each round hooks every member to its smallest neighbour below it, jumps
    along these hooks to their ends, and contracts the links to what is left
    between different ends. A tight group collapses in the first round."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = materialize(links.where("a != b").select(high.alias("a"), low.alias("b")).distinct(), f"{name}-links")
    done: list[DataFrame] = []
    while not links.isEmpty():
        hooks = materialize(links.groupBy(F.col("a").alias("member")).agg(F.min("b").alias("root")), f"{name}-hooks")
        while True:
            ends = hooks.select(F.col("member").alias("root"), F.col("root").alias("next"))
            after = materialize(hooks.join(ends, "root", "left").select(
                "member", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                f"{name}-hooks")
            hooks = after.select("member", "root")
            if after.where("moved").isEmpty():
                break
        done.append(hooks)
        to = lambda c: hooks.select(F.col("member").alias(c), F.col("root").alias(f"{c}_root"))  # noqa: E731, B023
        ended = links.join(to("a"), "a").join(to("b"), "b", "left").select(
            F.col("a_root").alias("a"), F.coalesce("b_root", "b").alias("b")).where("a != b")
        links = materialize(ended.select(high.alias("a"), low.alias("b")).distinct(), f"{name}-links")
    if not done:
        return links.select(F.col("a").alias("member"), F.col("b").alias("root"))
    # What a later round hooked carries all that earlier rounds hooked to it.
    roots = done[-1]
    for hooks in reversed(done[:-1]):
        later = roots.select(F.col("member").alias("root"), F.col("root").alias("next"))
        roots = roots.unionByName(hooks.join(later, "root", "left").select(
            "member", F.coalesce("next", "root").alias("root")))
    ends = roots.select(F.col("root").alias("member"), "root").distinct()
    return materialize(roots.unionByName(ends), f"{name}-roots")


def linked(sets: list[np.ndarray], weights: np.ndarray, split: int,
           similarity: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each text (weighted by the members of the class at the other
    end) and a spanning forest. ``split`` > 0: only pairs across that place."""
    n = len(sets)
    counts, edges, root = np.zeros(n, np.int64), [], list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    for i, later in overlaps(sets, sizes, split, similarity):
        for j in later:
            counts[i] += weights[j]
            counts[j] += weights[i]
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((i, j))
    return counts, edges


def overlaps(sets: list[np.ndarray], sizes: np.ndarray, split: int,
             similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the later ones whose sets reach the similarity."""
    n = len(sets)
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    step = 4096
    for low in range(0, len(every), step):
        a, b = np.searchsorted(column, [low, low + step])
        present = np.zeros((n, step), np.float32)
        present[owner[a:b], column[a:b] - low] = 1.0
        rows = np.unique(owner[a:b])
        common[np.ix_(rows, rows)] += present[rows] @ present[rows].T
    for i in range(n):
        first = max(i + 1, split) if split and i < split else n if split else i + 1
        if first < n:
            both = common[i, first:]
            near = both >= similarity * (sizes[i] + sizes[first:] - both) - 1e-6
            exact = first + np.flatnonzero(near & (both > 0))
            if len(exact):
                yield i, exact


def verify(similarity: float):
    """A function for mapInArrow over rows sorted by ``task``."""
    def group(rows: list[tuple]) -> list[tuple]:
        rows.sort(key=lambda r: (r[1], r[2]))
        sets = [shingles(r[3]) for r in rows]
        low, high = rows[0][1], rows[-1][1]
        split = sum(r[1] == low for r in rows) if low != high or rows[0][5] else 0
        if split == len(rows):
            return []
        counts, edges = linked(sets, np.array([r[4] for r in rows]), split, similarity)
        out = [(rows[i][2], None, int(c)) for i, c in enumerate(counts) if c]
        return out + [(rows[i][2], rows[j][2], 0) for i, j in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        members: set[bytes] = set()  # a repeated row adds nothing
        for batch in batches:
            out = []
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[-1][0] != r[0]:
                    out += group(held)
                    held, members = [], set()
                if r[2] not in members:
                    members.add(r[2])
                    held.append(r)
            yield links_batch(out)
        if held:
            yield links_batch(group(held))

    return run


def links_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()),
                                       pa.array(columns[2], pa.int64())], ["a", "b", "n"])


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                 recall: float = RECALL, part: int = PART) -> DataFrame:
    """One row per distinct row of ``docs`` (by ``key``, see ``row_key``):
    ``key, doc_id, rows`` (how many equal ones), ``same`` (class of equal
    shingle sets), ``cluster`` (class of near copies, the smallest ``same``)
    and ``links`` (other rows within the similarity)."""
    length = prefix_length(similarity, recall=recall)
    sketched = docs.select(docs[doc_id].alias("doc_id"), row_key(docs[doc_id], docs[text]).alias("key"),
                           F.pandas_udf(sketch(length), "same binary, size int, nodes array<long>")(docs[text])
                           .alias("s")).select("doc_id", "key", "s.*")
    sketched = materialize(sketched, "near-sketches")
    members = materialize(sketched.groupBy("key", "same").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")), "near-members")
    classes = materialize(members.groupBy("same").agg(F.min("key").alias("key"), F.sum("rows").alias("weight")),
                          "near-classes")
    nodes = sketched.join(classes.select("same", "key"), ["same", "key"], "left_semi").select(
        F.col("same").alias("member"), F.explode("nodes").alias("node"))
    # Nodes as (member, smallest member); a node of one member links nothing.
    smallest = nodes.groupBy("node").agg(F.min("member").alias("low"), F.max("member").alias("high")).where(
        "low != high").select("node", "low")
    meeting = nodes.join(smallest, "node").select(F.col("member").alias("a"), F.col("low").alias("b")).distinct()
    candidates = components(meeting, "near-candidates")

    # Parts of a component: a component of up to ``part`` members is one part.
    sizes = candidates.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    parts = (candidates.join(sizes, "root").withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")))
    # Each two parts meet in one task, and each part with itself.
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least(F.col("mine"), other).alias("x"), F.greatest(F.col("mine"), other).alias("y")))
    where = materialize(parts.select("member", "root", "mine", pairs.alias("pairs")).join(
        classes.select(F.col("same").alias("member"), "key", "weight"), "member"), "near-parts")
    texts = docs.select(row_key(docs[doc_id], docs[text]).alias("key"), docs[text].alias("text"))
    sent = texts.join(where.hint("shuffle_hash"), "key").select("member", "root", "mine", "weight", "text", F.explode("pairs").alias("pair")).select(
        F.concat("root", F.encode(F.concat_ws(":", "pair.x", "pair.y"), "utf-8")).alias("task"),
        "mine", "member", "text", "weight", (F.col("pair.x") != F.col("pair.y")).alias("across"))
    checked = materialize(sent.repartition("task").sortWithinPartitions("task").mapInArrow(
        verify(similarity), "a binary, b binary, n long"), "near-links")
    links = checked.where("b is null").groupBy(F.col("a").alias("same")).agg(F.sum("n").alias("others"))
    clusters = components(checked.where("b is not null").select("a", "b"), "near-clusters")
    found = (classes.join(links, "same", "left")
             .join(clusters.withColumnRenamed("member", "same"), "same", "left")
             .select("same", F.coalesce("root", "same").alias("cluster"),
                     (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("links")))
    return members.join(found, "same")


def near_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest id of its
    class of near copies) and ``n_links`` (other documents within the similarity)."""
    found = near_classes(docs, doc_id, text, **options)
    ids = found.groupBy("cluster").agg(F.min("doc_id").alias("class_id"))
    return found.join(ids, "cluster").select("doc_id", "class_id", "links", F.explode(F.array_repeat(
        F.lit(1), F.col("rows").cast("int"))).alias("row")).select("doc_id", "class_id", F.col("links").alias("n_links"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The document of smallest id (nulls last) of each class of near copies."""
    found = near_classes(docs, doc_id, text, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "rows")
    key, rows = fresh("row_key", docs.columns), fresh("rows", docs.columns)
    kept = found.groupBy("cluster").agg(F.min(order).alias("first")).select(
        F.col("first.key").alias("_" + key), F.col("first.rows").alias(rows))
    joined = docs.withColumn(key, row_key(docs[doc_id], docs[text])).join(
        kept.hint("shuffle_hash"), F.col(key) == F.col("_" + key))
    once, several = joined.where(F.col(rows) == 1), joined.where(F.col(rows) > 1).dropDuplicates([key])
    return once.unionByName(several).select(*[column(c) for c in docs.columns])
