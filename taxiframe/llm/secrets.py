"""Secret scan with an incremental ledger of blobs.

Every version of a document is addressed by the SHA-256 of its content, its
blob. The ledger, a table of ``blob``, the ``rules`` scanned (name and
version) and the ``spans`` found, tells what has been scanned. A run finds
the blobs and rule versions that the ledger doesn't have, scans one row for
each such blob by the missing rules only, appends to the ledger, and joins
the findings back to all paths that hold a blob. All of it is expressed by
DataFrame functions.

Spans are in code points, the end exclusive; matches of a rule are leftmost
and don't overlap, and a match that is too short is dropped as a whole. A null
text counts as the empty blob; a null path is a path like any other; repeated
rows share a blob; empty tables give empty results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxiframe.llm.common import fresh, lookup, materialize


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group that has to be long enough
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                      r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
RULES = (
    *BASE_RULES,
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def screen(rule: Rule) -> str:
    """A pattern that every text with a long enough match of ``rule`` has."""
    return {"hex": r"[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}"}.get(rule.kind, rule.pattern)


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule: the text between the matches gives their places."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        F.split(text, rule.pattern, -1).alias("before"))
    start = lambda acc, x: acc["at"] + F.length(x["before"])
    empty = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        end = start(acc, x) + F.length(x["match"])
        span = F.struct(start(acc, x).alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"))
        long_enough = F.length(x["value"]) >= rule.least
        return F.struct(end.alias("at"),
                        F.when(long_enough, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
                        .alias("spans"))

    # The zip is as long as the text pieces, one more than the matches.
    matches = F.filter(parts, lambda x: x["match"].isNotNull())
    found = F.aggregate(matches, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step,
                        lambda acc: acc["spans"])
    return F.when(text.rlike(screen(rule)), found).otherwise(empty)


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, paths: DataFrame, ledger: DataFrame, text: str, key: Column,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for what the ledger lacks. ``paths``: ``blob, path_key`` of ``docs``."""
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    unseen = (paths.groupBy("blob").agg(F.min("path_key").alias("path_key")).join(seen, "blob", "left")
              .select("blob", "path_key", F.array_except(
                  names, F.coalesce("seen", F.array().cast("array<string>"))).alias("missing"))
              .where(F.size("missing") > 0))
    # One row per blob is scanned. Blob and path deal the rows out, so many
    # copies of one blob don't meet in one task.
    texts = docs.select(blob_of(docs[text]).alias("blob"), key.alias("path_key"),
                        F.coalesce(docs[text], F.lit("")).alias("text"))
    todo = texts.join(unseen.hint("shuffle_hash"), ["blob", "path_key"])
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.concat(*[F.when(F.array_contains("missing", r.name), spans_of(F.col("text"), r, i)).otherwise(none)
                       for i, r in enumerate(rules)])
    return todo.select("blob", F.col("missing").alias("rules"), spans.alias("spans")).dropDuplicates(["blob"])


def update(docs: DataFrame, ledger_path: str, path: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what is new in ``docs``, append it to the ledger and return ``docs``
    with ``secrets``, the spans of its text by start."""
    spark = docs.sparkSession
    names = fresh("secrets", docs.columns), fresh("blob", docs.columns)
    key = F.coalesce(docs[path].cast("string"), F.lit(""))
    paths = materialize(docs.select(blob_of(docs[text]).alias("blob"), key.alias("path_key")), "blob-paths")
    scan(docs, paths, read_ledger(spark, ledger_path), text, key, rules).write.mode("append").parquet(ledger_path)
    found = findings(spark, ledger_path, rules).withColumnsRenamed({"blob": "_" + names[1], "spans": names[0]})
    held = docs.withColumn(names[1], blob_of(docs[text]))
    joined = lookup(held, found, names[1], "_" + names[1], key).drop(names[1])
    return joined.withColumn(names[0], F.coalesce(names[0], F.array().cast(f"array<{SPAN}>")))


def findings(spark: SparkSession, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans`` of the blobs with findings of the given rule versions."""
    current = F.array(*[F.lit(r.name) for r in rules])
    rows = read_ledger(spark, ledger_path).where(F.size("spans") > 0)
    kinds = F.transform(F.array_intersect("rules", current), lambda r: F.split_part(r, F.lit("@"), F.lit(1)))
    kept = F.filter("spans", lambda s: F.array_contains(kinds, s["kind"]))
    return rows.select("blob", kept.alias("spans")).groupBy("blob").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")).where(F.size("spans") > 0)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, doc_id: str = "doc_id", spans: str = "secrets") -> DataFrame:
    """Counts by base kind, the hash of the base spans and the list of all."""
    kinds = [r.kind for r in BASE_RULES]
    only = lambda *k: F.filter(spans, lambda s: s["kind"].isin(*k))
    return scanned.select(doc_id, *[F.size(only(k)).cast("long").alias(f"n_{k}") for k in kinds],
                          F.sha2(listed(only(*kinds)), 256).alias("base_sha256"),
                          listed(F.col(spans)).alias("spans"))
