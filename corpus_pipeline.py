"""The corpus pipeline: documents to packed training sequences in five stages.

A stage takes and returns documents; all columns of its input are carried along
unchanged, whatever their names, but for what it says it changes. The last stage
returns pieces in sequences. An empty table gives an empty result at every
stage. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.llm import host_rules, line_dedup, mixing, near_join, packing
from taxiframe.llm.common import column, documents, fresh, materialize
from taxiframe.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule that holds for them.

    A null or empty text has no words, so its document goes. Documents of a null
    source are judged as one source. Repeated rows are judged alike; each stays
    or goes. A source whose rate equals the limit of a rule passes it.
    """
    configure(spark)
    kept = host_rules.names(docs.columns)[2]
    return host_rules.apply_rules(docs).where(F.col(kept)).select(*[column(c) for c in docs.columns])


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line chunks that an earlier document has; ``text``
    and ``n_chars`` change.

    A null text stays null, a text that loses all its units becomes empty; no
    row goes. Of a repeated chunk the occurrence in the document of the smallest
    id stays (null ids last), then that of the first place; repeated rows count
    as one document.
    """
    configure(spark)
    cleaned = line_dedup.dedup_lines(docs).select(*[column(c) for c in docs.columns])
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id (null
    ids last; of texts with the same id, the one of the smallest hash; of repeated
    rows one). Null, empty and wordless texts are copies of each other."""
    configure(spark)
    return near_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them: not at all,
    once, or several times as equal rows.

    A null source is a source. A null or empty text has no words, so that
    taking it changes no size; it is taken by its key like any other. Equal keys
    are ordered by the hash of id and text.
    """
    configure(spark)
    name = fresh("mix", docs.columns)
    return mixing.emit(mixing.mix(docs), name)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence: ``doc_id,
    piece, start, length, ids_crc32, sequence_id, offset``, no other columns.

    A null text counts as empty: one piece of the end token. Repeated rows are
    packed each time, each with pieces of its own.
    """
    configure(spark)
    return packing.pack(packing.tokenize(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_chunks),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The stages use a tokenizer, which SQL doesn't have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
