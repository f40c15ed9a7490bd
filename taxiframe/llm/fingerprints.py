"""Document fingerprints from closed syncmers, in DataFrame functions.

The letters are the words of a text (a long word is cut into letters of
``LETTER`` characters), hashed to 64 bits. Every ``K`` adjacent letters form a
k-mer with ``K - S + 1`` inner s-mers; the k-mer is a closed syncmer if its
smallest s-mer is its first or its last. Whether a k-mer is chosen depends on
its own letters only, so two texts choose the same anchors in a passage that
they share, wherever it stands. The fingerprint is the sketch of the ``SKETCH``
smallest anchor hashes (32 bits, as hexadecimal text in ascending order). The
likeness of two fingerprints is the share of the smallest hashes of their union
that both have, an estimate of the Jaccard similarity of the anchor sets.

Whole texts are read, also very long ones. A text without a syncmer (it has
fewer than ``K + 3`` letters) has one anchor, the hash of all its letters, so
only a text without a word has the fingerprint ``""``, and two of these have
likeness 1. A run of more than ``LETTER`` characters without white space is cut at
fixed places, so an insertion changes the letters that follow it in the run.
Equal texts have equal fingerprints, and rows of equal likeness are not told
apart. Other columns and repeated rows are carried along, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import fresh, let, materialize, row_key

#: Letters of a k-mer and of an inner s-mer.
K, S = 6, 2
LETTER, SKETCH, WIDTH = 16, 64, 8


def letters(text: Column) -> Column:
    """The 64-bit hashes of the letters of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]{1,%d}" % LETTER), F.lit(0)),
                       lambda w: F.xxhash64(w))


def anchors(text: Column) -> Column:
    """The hashes of the closed syncmers of a text by place; for a text that has
    letters but no syncmer the hash of all its letters."""
    inner = K - S + 1

    def syncmers(h: Column) -> Column:
        n = F.size(h)
        smers = F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))

        def kmer(s: Column, i: Column) -> Column:
            edge = F.least(F.get(s, i), F.get(s, i + inner - 1))
            middle = F.least(*[F.get(s, i + j) for j in range(1, inner - 1)])
            return F.when(edge <= middle, F.xxhash64(*[F.get(s, i + j) for j in range(0, inner, S)]))

        return let(smers, lambda s: F.transform(F.sequence(F.lit(0), n - K), lambda i: kmer(s, i)))

    def all_of(h: Column) -> Column:
        none = F.array().cast("array<long>")
        chosen = F.when(F.size(h) >= K, F.filter(syncmers(h), lambda a: a.isNotNull())).otherwise(none)
        # K + 3 letters always have a syncmer, fewer may have none.
        few = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
        return let(chosen, lambda a: F.when((F.size(a) == 0) & (F.size(h) > 0), few).otherwise(a))

    return let(letters(text), all_of)


def fingerprint(text: Column) -> Column:
    """The sketch of a text as one string."""
    top = F.transform(anchors(F.coalesce(text, F.lit(""))), lambda a: F.shiftrightunsigned(a, 32))
    smallest = F.slice(F.sort_array(F.array_distinct(top)), 1, SKETCH)
    return F.array_join(F.transform(smallest, lambda a: F.lower(F.lpad(F.hex(a), WIDTH, "0"))), "")


def hashes(sketch: Column) -> Column:
    return F.regexp_extract_all(sketch, F.lit("." * WIDTH), F.lit(0))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    def of(a: Column, b: Column) -> Column:
        union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
        both = F.size(F.array_intersect(union, F.array_intersect(a, b))).cast("double")
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))

    return F.when(one == other, F.lit(1.0)).otherwise(
        let(hashes(one), lambda a: let(hashes(other), lambda b: of(a, b))))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``."""
    return docs.withColumn(fresh("fingerprint", docs.columns), fingerprint(docs[text]))


def neighbours(docs: DataFrame) -> DataFrame:
    """``key, next_key, half, copies``: for the distinct rows of ``docs`` (``doc_id,
    text``) the next one in descending order of the id (nulls last, then by
    key), after the last one the first. Of rows that occur several times, all
    but one have their own copy as the next. ``half``: half the code points.

    The order is a distributed sort; the number of a row is its place in its
    partition plus the sizes of the partitions before, one row for each.
    """
    keys = materialize(docs.groupBy(row_key(F.col("doc_id"), F.col("text")).alias("key")).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
        F.max(F.floor(F.length("text") / 2).cast("int")).alias("half")), "neighbour-keys")
    ordered = materialize(
        keys.orderBy(F.col("doc_id").desc_nulls_last(), "key")
        .select("key", "copies", "half", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "neighbour-order").withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    numbered = ordered.join(F.broadcast(offsets), "part").select(
        "key", "copies", "half", (F.col("at") + F.col("offset")).alias("number"))
    total = ordered.count()
    following = numbered.select(F.col("key").alias("next_key"), F.pmod(F.col("number") - 1, F.lit(max(total, 1))
                                                                         ).alias("number"))
    pairs = numbered.join(following, "number").select(
        "key", "next_key", "half", F.lit(1).cast("long").alias("copies"))
    own = numbered.where("copies > 1").select("key", F.col("key").alias("next_key"), "half", F.col("copies") - 1)
    return materialize(pairs.union(own), "neighbours")


def edited(text: Column, following: Column) -> Column:
    """The text with the last half of its code points replaced by the first as
    many (or all) of the following text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the
    likeness of the first to the second and to that of the next document."""
    given = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    pairs = neighbours(given)
    # A row for each distinct id and text; fingerprints are made before the
    # only shuffle of texts. Both sides below read that shuffle.
    printed = given.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text",
                           fingerprint(F.col("text")).alias("fingerprint"))
    distinct = printed.groupBy("key").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "fingerprint")])
    heads = distinct.withColumnsRenamed({"key": "next_key", "doc_id": "next_doc_id", "text": "next_text",
                                         "fingerprint": "next_fingerprint"}).join(pairs, "next_key").select(
        "key", "copies", "next_doc_id", "next_fingerprint", F.substring(F.col("next_text"), F.lit(1), F.col("half"))
        .alias("head"))
    joined = distinct.join(heads, "key").withColumn("edited", edited(F.col("text"), F.col("head")))
    shown = joined.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_doc_id", "next_fingerprint",
        "copies")
    return shown.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "next_doc_id",
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
