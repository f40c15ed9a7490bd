"""Exact dedup by skew-safe combining, in DataFrame functions.

Two texts are copies if they are equal after all ASCII white space is deleted.
Of a group of copies the row with the most code points in its original text
stays, then the one with the smallest id.

Three stages combine the copies, and each groups by the digest and by the whole
normalised text, so that texts of equal digest are told apart by their content:
a task first combines the copies among its own rows; what is left of a group is
merged in ``SALTS`` parts, dealt by the task it comes from; the winners of the
parts are merged last. A text that a third of all rows share reaches the last
stage as ``SALTS`` rows at most. Rows find the result of their group by digest,
where only groups of two or more rows are looked up. Should a digest stand for
several contents (never seen with SHA-256), its rows are looked up by content.

A null text counts as empty, and all empty texts are copies. A null id comes
after all others. Of rows with equal id, content and length one stays; which
one of them makes no difference to the result. Texts of any length are compared
whole. An empty table gives an empty result. ``mark_copies`` returns columns of
its own only; ``without_copies`` carries all columns of the input.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import BLANKS, column, fresh, lookup, materialize

#: Parts in which a group of copies is merged.
SALTS = 16
#: A rank is ``n_chars * ID_RANGE + 2^63 - doc_id``: the highest one stays.
ID_RANGE, ID_TOP = Decimal(2 ** 65), Decimal(2 ** 63)


def normalised(text: Column) -> Column:
    """The text without ASCII white space; empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def rank(text: Column, doc_id: Column) -> Column:
    """A number that is highest for the row that stays (ids: whole numbers)."""
    n_chars = F.coalesce(F.length(text), F.lit(0)).cast("decimal(12,0)")
    place = F.coalesce(F.lit(ID_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return (n_chars * F.lit(ID_RANGE).cast("decimal(20,0)") + place).cast("decimal(38,0)")


def ranked_id(ranked: Column) -> Column:
    """The id in a rank."""
    place = ranked % F.lit(ID_RANGE).cast("decimal(38,0)")
    return F.when(place > 0, (F.lit(ID_TOP).cast("decimal(38,0)") - place).cast("long"))


def combined(rows: DataFrame) -> DataFrame:
    """One row per content of ``rows`` (``digest, content, rank``): its highest
    rank ``top`` and the number of its rows, ``group_size``."""
    part = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    # The partial aggregation of the first group-by combines inside the task.
    parts = rows.groupBy("digest", "content", part.alias("part")).agg(
        F.max("rank").alias("top"), F.count(F.lit(1)).alias("group_size"))
    return parts.groupBy("digest", "content").agg(
        F.max("top").alias("top"), F.sum("group_size").alias("group_size"))


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, digest, rank, keep_id, group_size, kept``.

    ``digest`` gives candidates only; equality is that of the content.
    """
    content = normalised(column(text))
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), digest(content).alias("digest"),
                       rank(column(text), column(doc_id)).alias("rank"), content.alias("content"))
    groups = materialize(combined(rows).select("digest", "top", "group_size", F.xxhash64("content").alias("of")), "copies")
    clashing = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("digest")
    if clashing.isEmpty():
        return _marked(rows.drop("content"), groups.where("group_size > 1").select("digest", "top", "group_size"))
    clashing = materialize(clashing, "clashing-digests").withColumnRenamed("digest", "shared")
    shared = F.col("digest") == F.col("shared")
    sure = groups.join(clashing, shared, "left_anti").where("group_size > 1").select("digest", "top", "group_size")
    plain = _marked(rows.drop("content").join(clashing, shared, "left_anti"), sure)
    # By content: the whole text takes the place of the digest.
    doubtful = rows.join(clashing, shared, "left_semi")
    whole = combined(doubtful).where("group_size > 1").select("content", "top", "group_size")
    named = doubtful.withColumnsRenamed({"digest": "shown", "content": "digest"})
    by_text = _marked(named, whole.withColumnRenamed("content", "digest"), "shown")
    return plain.unionByName(by_text.drop("digest").withColumnRenamed("shown", "digest"))


def _marked(rows: DataFrame, groups: DataFrame, *carry: str) -> DataFrame:
    """Rows with the result of their group; rows of no group stand alone."""
    counted = rows.groupBy("doc_id", "digest", "rank", *carry).agg(F.count(F.lit(1)).alias("times"))
    found = lookup(counted, groups.withColumnRenamed("digest", "of_group"), "digest", "of_group", F.col("rank"))
    top = F.coalesce(F.col("top"), F.col("rank"))
    return (found.select("doc_id", "digest", "rank", *carry, ranked_id(top).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         (F.col("rank") == top).alias("is_top"),
                         F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
            .withColumn("kept", F.col("is_top") & (F.col("copy") == 1)).drop("is_top", "copy"))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    A text moves only where its group has several rows of the highest rank.
    """
    marked = mark_copies(docs, doc_id, text).where("group_size > 1")
    mine, best = fresh("digest_of_row", docs.columns), fresh("best_rank", docs.columns)
    tops = marked.where("kept").select(F.col("digest").alias("of_" + mine), F.col("rank").alias(best))
    again = marked.where((F.col("doc_id").eqNullSafe(F.col("keep_id"))) & ~F.col("kept")).select(
        "digest", "rank").distinct().select(F.col("digest").alias("twice_" + mine), F.col("rank").alias("twice_" + best))
    rows = docs.withColumn(mine, sha256(normalised(column(text))))
    rows = lookup(rows, tops, mine, "of_" + mine, column(doc_id))
    own = rank(column(text), column(doc_id))
    rows = lookup(rows.where(column(best).isNull() | (column(best) == own)), again, mine, "twice_" + mine, own)
    twice = column("twice_" + best) == own
    once = rows.where(~F.coalesce(twice, F.lit(False)))
    one_of = rows.where(twice).dropDuplicates([mine])
    return once.unionByName(one_of).select(*[column(c) for c in docs.columns])
