"""Quality rules with verdicts by host.

Every document is measured on its whole text. A document that fails a base
rule is rejected. Further rules are noisy on a single document, so they only
count where the host fails them clearly more often than others: failures are
counted by host and rule, the rate of each host is shrunk towards a beta prior
fitted to the rates of all hosts, and a rule holds for the documents of the
hosts whose shrunk rate, less its standard deviation, is above ``EXCESS`` times
the prior's mean. The rate of a host of a few documents is near the mean or
uncertain, so a few failures don't condemn it. A document that fails no rule is
always kept.

The measures are written once with the columns that are carried along; the
verdicts of the hosts are joined to them, so no text is measured twice.

A null text has no words (and fails the base rule), as an empty one; very long
texts are measured whole, one at a time. Documents without a host share the
null host; repeated rows count each time; a host whose rate equals the limit
passes. An empty table gives an empty result. All columns of the input are
carried along unchanged, whatever their names; the names of the new ones get
underscores in front where they are taken (:func:`names`).
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import column, fresh, lookup, materialize

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MEASURED = ", ".join(f"{m} long" for m in MEASURES)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\v\f"
MIN_WORDS = 50
#: A host is judged by a rule if its shrunk failure rate, less a standard
#: deviation, is above so many times the mean rate of all hosts.
EXCESS = 1.25


def measure_text(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    repeated = 0
    if len(counts) < len(windows):
        end = 0  # positions before it are counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(words), len(text) - sum(text.count(c) for c in BLANKS),
            sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines))


def measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=list(MEASURES), dtype="int64")


def base_failed(m) -> Column:
    """``m``: gives the column of a measure."""
    return (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > 50 * m("n_words"))


def host_rules(m) -> dict[str, Column]:
    """Rules that count by host, true where the document fails."""
    return {
        "symbols": 10 * m("n_symbols") > m("n_words"),
        "dup_lines": 10 * m("n_dup_lines") > 3 * m("n_lines"),
        "word_length": (m("word_chars") < 3 * m("n_words")) | (m("word_chars") > 12 * m("n_words")),
    }


def judge_hosts(measured: DataFrame, host: str, measures: str, excess: float = EXCESS) -> DataFrame:
    """One row per host: the host, its documents, and for each rule the shrunk
    failure rate and whether it is above the limit (``bad_<rule>``)."""
    rules = host_rules(lambda n: F.col(f"{measures}.{n}"))
    hosts = materialize(measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(c.cast("long")).alias(f"failed_{r}") for r, c in rules.items()]), "hosts")
    # Moments of the rates over all hosts: two numbers per rule.
    rate = lambda r: F.col(f"failed_{r}") / F.col("n_docs")
    moments = hosts.agg(*[f(rate(r)).alias(f"{n}_{r}") for r in rules
                          for n, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    out = [F.col("host"), F.col("n_docs")]
    for r in rules:
        a, b = beta_prior(moments[f"mean_{r}"], moments[f"var_{r}"])
        shrunk = (F.col(f"failed_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
        spread = F.sqrt(shrunk * (1 - shrunk) / (F.col("n_docs") + F.lit(a + b) + 1))
        out += [shrunk.alias(f"rate_{r}"), (shrunk - spread > excess * a / (a + b)).alias(f"bad_{r}")]
    return hosts.select(*out)


def beta_prior(mean: float | None, var: float | None) -> tuple[float, float]:
    """Beta parameters with this mean and variance of the hosts' rates; the
    weight of the prior is kept between 2 and 1000 documents."""
    mean = min(max(mean or 0.0, 1e-6), 1 - 1e-6)
    weight = mean * (1 - mean) / var - 1 if var else 1000.0
    weight = min(max(weight, 2.0), 1000.0)
    return mean * weight, (1 - mean) * weight


def names(columns: list[str]) -> tuple[str, str, str]:
    """Names of the measures, of ``base_failed`` and of ``kept`` in the result
    for an input with these columns."""
    return fresh("quality", columns), fresh("base_failed", columns), fresh("kept", columns)


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", excess: float = EXCESS,
                carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the struct ``quality`` of the
    measures, ``base_failed`` and ``kept`` (see :func:`names`)."""
    taken = docs.columns
    keep = [column(c) for c in (taken if carry is None else carry)]
    measures, failed_name, kept_name = names(taken)
    at = fresh("host_of_document", taken)
    measured = materialize(docs.select(*keep, column(host).alias(at), F.pandas_udf(measure, MEASURED)(
        column(text)).alias(measures)), "measured")
    hosts = judge_hosts(measured, at, measures, excess)
    rules = host_rules(lambda n: F.col(f"{measures}.{n}"))
    bad = hosts.where(" or ".join(f"bad_{r}" for r in rules)).select(
        F.col("host").alias(fresh("judged_host", taken)), *[F.col(f"bad_{r}").alias(fresh(f"bad_{r}", taken)) for r in rules])
    joined = lookup(measured, bad, at, bad.columns[0], F.col(measures))
    failed = base_failed(lambda n: F.col(f"{measures}.{n}"))
    by_host = F.lit(False)
    for (r, c), flag in zip(rules.items(), bad.columns[1:], strict=True):
        by_host = by_host | (F.coalesce(F.col(flag), F.lit(False)) & c)
    return joined.select(*keep, F.col(measures), failed.alias(failed_name), (~failed & ~by_host).alias(kept_name))
