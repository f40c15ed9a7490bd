"""The document operators applied to the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.llm import (
    exact_dedup,
    fingerprints,
    hard_negatives,
    hmm,
    host_rules,
    line_dedup,
    merkle,
    mixing,
    near_join,
    packing,
    pii,
    secrets,
    token_counts,
)
from taxiframe.llm.common import documents, table
from taxiframe.llm.oracle import ORACLE
from taxiframe.session import scratch_path


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(documents(spark, sf_dir))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_links(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "text", F.col("removed.chunks").alias("n_removed_chunks"),
                          F.col("removed.units").alias("n_removed_units"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), carry=["doc_id", "source"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "source", "mix.times")


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = scratch_path(spark, "secret-ledger")
    docs = documents(spark, sf_dir)
    return secrets.digest(secrets.update(docs.select("doc_id", "text"), ledger))


def op7_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(documents(spark, sf_dir))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.apply_rules(documents(spark, sf_dir), carry=["doc_id"])
    measures = [F.col(f"quality.{m}").alias(m) for m in host_rules.MEASURES if m != "n_lines"]
    return judged.select("doc_id", *measures, "base_failed", "kept")


def op9_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, sf_dir))
    return counted.select("doc_id", "tokens.n_pretokens", "tokens.n_tokens")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(documents(spark, sf_dir)))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.prepared(table(spark, sf_dir, "embeddings")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.manifest(documents(spark, sf_dir))
    return proved.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(documents(spark, sf_dir))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_syncmer_fingerprints, op2_ngram_jaccard_join, op3_line_dedup, op4_source_mix, op5_pii_spans,
    op6_secret_ledger, op7_hidden_markov_scores, op8_host_rules, op9_trie_token_counts, op10_best_fit_packing,
    op11_hard_negatives, op12_merkle_manifest, op13_exact_dedup)}
