"""Mixing sources to target weights by exponential keys.

Each source gets a target size. Its complete epochs come first: every document
is taken ``floor(target / source size)`` times. What is left of the target is
filled by weighted sampling without replacement: a document of quality weight
``w`` gets the key ``-ln(u) / w``, with ``u`` in (0, 1] from a hash of its id
and text, and the documents of the source are taken in the order of their keys
as long as the middle of the document lies within the rest of the target.

No source is sorted as a whole. Sizes are summed by source and key range (a
fixed number of ranges); only the documents in the one range that the target
falls into are ordered by a window, all others are decided by their range.

A null or empty text has size 0; the words of very long texts are counted
whole; a null source is a source of its own; rows repeat as often as they occur;
equal keys are ordered by the hash. An empty table gives an empty result. All
columns of the input are carried along, whatever their names; the struct of the
result is called ``mix``, with underscores in front where that is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import WORD, column, fresh, lookup, materialize

#: Key ranges per source.
RANGES = 4096
#: Share of all sizes that the mix has, weights of the sources in turn, times
#: that a source is taken at most.
SHARE, SOURCE_WEIGHTS, CAP = 1.5, (3, 1, 2), 2
NOISE = "0123456789" + "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for text without digits and symbols, down to 0.1."""
    n = F.length(text)
    noise = (n - F.length(F.translate(text, NOISE, ""))).cast("double")
    return F.when(n > 0, F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(2.0) * noise / n)).otherwise(F.lit(0.1))


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = SOURCE_WEIGHTS,
                   cap: int = CAP) -> DataFrame:
    """``sizes`` (``source``, ``source_size``; one row per source) with ``target``.

    With the sources in the order of size over weight, those in front are the
    ones that reach the cap; the level of the others follows from what is left.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_code) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    full = (cap * F.col("source_size")).cast("double")
    ranked = sizes.withColumn("weight", weight).withColumn("full", full).withColumn("ratio", full / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.lit(share) * F.sum("source_size").over(everything).cast("double")
    level = (total - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = ranked.withColumn("level", level)
    # The first source below its cap sets the level; where none is, all are full.
    found = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"]
    target = F.when(found.isNull(), F.col("full")).otherwise(F.least(F.col("full"), found * F.col("weight")))
    return levelled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        share: float = SHARE, weights: tuple[int, ...] = SOURCE_WEIGHTS, cap: int = CAP,
        quality: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the struct ``mix``: ``size``,
    ``source_size``, ``target``, ``times`` (how often the document is taken)
    and ``taken`` (words: ``times * size``)."""
    name = fresh("mix", docs.columns)
    part, key = fresh("mix_part", docs.columns), fresh("mix_source", docs.columns)
    digest = F.md5(F.concat(F.coalesce(column(doc_id).cast("string"), F.lit("")), F.lit(":"),
                            F.coalesce(column(text), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / F.lit(float(2 ** 52))
    sized = docs.select(*[column(c) for c in (docs.columns if carry is None else carry)],
                        column(source).alias(key), F.struct(
        word_count(column(text)).alias("size"), digest.alias("digest"),
        (-F.log(u) / (quality_weight(column(text)) if quality is None else quality)).alias("key")).alias(name))
    if carry is not None:  # a small copy without the texts
        sized = materialize(sized, "sized")
    sized = sized.withColumn(part, F.floor((F.lit(1.0) - F.exp(-F.col(f"{name}.key"))) * RANGES).cast("int"))

    ranges = materialize(sized.groupBy(F.col(key).alias("source"), F.col(part).alias("part")).agg(
        F.sum(f"{name}.size").alias("part_size")), "mix-ranges")
    sources = ranges.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(sources, share, weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    upto = ranges.withColumn("upto", F.sum("part_size").over(running))
    t = targets.withColumnRenamed("source", "target_source")
    cut = upto.join(t, F.col("source").eqNullSafe(F.col("target_source"))).groupBy("target_source").agg(
        *[F.first(c).alias(c) for c in ("source_size", "target", "epochs", "rest")],
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct(
            F.col("part").alias("part"), (F.col("upto") - F.col("part_size")).alias("before")))).alias("cut"))
    cut = cut.select("target_source", F.struct("source_size", "target", "epochs", "rest", "cut").alias("plan"))
    plan = fresh("mix_plan", docs.columns)
    cut = materialize(cut.withColumnRenamed("target_source", "_" + key).withColumnRenamed("plan", plan), "mix-plan")

    planned = lookup(sized, cut, key, "_" + key, F.col(f"{name}.digest"))
    at = F.coalesce(F.col(f"{plan}.cut.part"), F.lit(RANGES + 1))
    inside = planned.where(F.col(part) == at)
    before = Window.partitionBy(key).orderBy(f"{name}.key", f"{name}.digest").rowsBetween(
        Window.unboundedPreceding, 0)
    middle = (F.col(f"{plan}.cut.before") + F.sum(f"{name}.size").over(before) - F.col(f"{name}.size") / 2.0)
    extra = fresh("mix_extra", docs.columns)
    rows = planned.where(F.col(part) != at).withColumn(extra, F.col(part) < at).unionByName(
        inside.withColumn(extra, middle <= F.col(f"{plan}.rest")))
    times = F.col(f"{plan}.epochs") + F.col(extra).cast("long")
    return rows.select(*[column(c) for c in (docs.columns if carry is None else carry)], F.struct(
        F.col(f"{name}.size").alias("size"), F.col(f"{plan}.source_size").alias("source_size"),
        F.col(f"{plan}.target").alias("target"), times.alias("times"),
        (times * F.col(f"{name}.size")).alias("taken")).alias(name))


def emit(mixed: DataFrame, name: str = "mix") -> DataFrame:
    """Each document as often as the mix takes it, without the struct, which is
    the column ``name`` of the mixed documents (:func:`mix` has it last)."""
    copy = fresh("copy", mixed.columns)
    taken = mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(f"{name}.times").cast("int"))))
    return taken.select(*[column(c) for c in mixed.columns if c != name])
