"""Hard negatives, the Merkle manifest and exact dedup against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from llm_cases import SCHEMA, prose, rows, table
from oracle_check import compare, duck
from pyspark.sql import functions as F

from taxiframe.llm import exact_dedup, hard_negatives, merkle
from taxiframe.llm.queries import ORACLE, QUERIES


def counted(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


# --- exact dedup

def brute_copies(data):
    """Rows ``(doc_id, keep_id, group_size, kept, content)``."""
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = Counter()
    for content, members in groups.items():
        members.sort()
        for i, m in enumerate(members):
            out[m[3], members[0][3], len(members), i == 0, content] += 1
    return out


def marked(spark, data, **given):
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = exact_dedup.mark_copies(frame, **given)
    return frame, Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect())


def plain(brute):
    out = Counter()
    for (*row, _), n in brute.items():
        out[tuple(row)] += n
    return out


COPIES = ([(i, "hot  text\n" + " " * (i % 3)) for i in range(300)] + [(None, "hot text"), (None, None), (5, "")]
          + [(7, "hot  text\n "), (7, "hot  text\n ")] + [(i, prose(i, 20)) for i in range(400, 430)]
          + [(-9, "a b"), (-10, "a\tb"), (2 ** 63 - 1, "ab "), (-2 ** 63, " ab")])


def test_copies_match_brute_force(spark, docs):
    for data in (COPIES, [(r[0], r[1]) for r in rows()]):
        assert marked(spark, data)[1] == plain(brute_copies(data))


@pytest.mark.parametrize("digest", [F.length, lambda c: F.lit("same")])
def test_equal_digests_of_unequal_texts(spark, digest):
    """With a digest that stands for many texts the contents decide."""
    assert marked(spark, COPIES, digest=digest)[1] == plain(brute_copies(COPIES))


def test_hot_group_reaches_the_last_stage_as_few_rows(spark):
    plan = exact_dedup.combined(spark.range(10).select(
        F.lit("d").alias("digest"), F.lit("c").alias("content"), F.col("id").cast("decimal(38,0)").alias("rank")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == 2 and "SortAggregate" not in text and "Python" not in text


def test_without_copies_keeps_one_whole_row(spark, docs):
    clashing = docs.withColumnsRenamed({"key": "rank", "mix": "a.b`c"}).withColumn("digest_of_row", F.lit(1))
    kept = exact_dedup.without_copies(clashing)
    assert kept.columns == clashing.columns
    want = Counter((k[0], k[4]) for k, n in brute_copies([(r[0], r[1]) for r in rows()]).items() if k[3] for _ in range(n))
    assert Counter((r["doc_id"], re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")) for r in kept.collect()) == want
    twice = spark.createDataFrame([(1, "x y", 1), (1, "xy ", 2), (1, "x y", 3)], "doc_id long, text string, kept int")
    assert exact_dedup.without_copies(twice).count() == 1


# --- Merkle manifest

def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(digests, arity):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for nodes in levels[:-1]:
        run = at // arity * arity
        out.append((nodes[run:at], nodes[at + 1:run + arity]))
        at //= arity
    return out


def brute_manifest(data, arity=8):
    """Rows ``(doc_id, leaf, subroot, root, proof, folded_root)`` of tuples (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n_chars):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))

    def low(text):
        return text if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)

    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in data:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        one = leaf(doc_id, text, lang, source, n_chars)
        trees[lang].append((doc_id is not None, doc_id or 0, one, leaf(doc_id, low(text), lang, source, n_chars) if hit else "", doc_id))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort()
        built[lang] = brute_tree([m[2] for m in trees[lang]], arity)
    top = brute_tree([built[lang][-1][0] for lang in langs], arity) if langs else []
    out = Counter()
    for k, lang in enumerate(langs):
        for i, (*_, one, changed, doc_id) in enumerate(trees[lang]):
            path = siblings(built[lang], i, arity) + siblings(top, k, arity)
            node = changed or one
            for left, right in path:
                node = h([*left, node, *right])
            out[doc_id, one, built[lang][-1][0], top[-1][0], h(x for a, b in path for x in (*a, *b)), node] += 1
    return out


def leaf_rows(data):
    return [(r[0], r[1], r[2], r[3], r[4]) for r in data]


def proved(frame, **given):
    got = merkle.manifest(frame, **given)
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in got.collect())


def test_manifest_of_awkward_rows(spark, docs):
    clashing = docs.withColumnsRenamed({"key": "leaf", "mix": "tree.x", "quality": "index"})
    assert proved(clashing) == brute_manifest(leaf_rows(rows()))
    one = spark.createDataFrame(rows()[:1], SCHEMA)
    assert proved(one) == brute_manifest(leaf_rows(rows()[:1]))


@pytest.mark.parametrize("arity, levels", [(2, 1), (2, 2), (3, 2), (8, 4)])
def test_manifest_over_several_stages(spark, arity, levels):
    """Trees of many sizes, whose last runs are not full, over blocks of several stages."""
    data = [(i, f"Text {i}", f"l{i % 11}" if i < 90 else "big", "s", i) for i in range(190)]
    data += [(400 + i, "Lone", f"only{i}", None, None) for i in range(3)] + [(7, "Same", None, None, 1)] * 5
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars int")
    assert proved(frame.repartition(7), arity=arity, levels=levels) == brute_manifest(data, arity)


def test_version_copies_the_ancestors_only(spark):
    data = [(i, f"Text {i}" if i % 2 else f"text {i}", "en", "s", 1) for i in range(70)]
    got = {r["doc_id"]: r for r in merkle.manifest(
        spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars int")).collect()}
    for i in range(70):
        changed = zlib.crc32(str(i).encode()) % 3 == 0 and i % 2 == 1
        version = got[i]["version"]
        assert (version is not None) == changed
        if changed:
            assert len(version) == 3 and version[-1] == got[i]["folded_root"] != got[i]["root"]
        else:
            assert got[i]["folded_root"] == got[i]["root"]


def test_every_leaf_is_folded_with_its_siblings():
    """A path that doesn't lead to the root shows, also for a leaf that nobody tampered with."""
    digests = [merkle.digest_of([str(i)]) for i in range(3)]
    nodes = pa.table({"doc_id": [1, 2, 3], "tree": ["1en"] * 3, "index": [0, 1, 2], "total": [3] * 3, "digest": digests,
                      "changed": pa.array([None, digests[1], "ff"], pa.string())})
    above = pa.table({"subroot": ["s"], "root": ["r"], "path": pa.array([[{"left": "a", "right": "b"}]], pa.list_(merkle.STEP))})
    out = merkle._proofs(nodes, above, 8, 4)
    top = merkle.digest_of(["a", merkle.digest_of(digests), "b"])
    other = merkle.digest_of(["a", merkle.digest_of([*digests[:2], "ff"]), "b"])
    assert out.column("folded_root").to_pylist() == [top, top, other]
    assert [v is None for v in out.column("version").to_pylist()] == [True, True, False]


# --- hard negatives

def brute_negatives(data, every=50):
    part = []
    for i, (ident, vector, label) in enumerate(data):
        if label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        if ident is not None and ident % 7 == 0:
            label = (label + 1) % 10
        part.append((i, ident, [math.floor(256 * v) for v in vector], label))
    top = 2 ** 63 - 1

    def key(x):
        return (-x[0], x[1] is None, x[1] or 0, x[2])

    out = Counter()
    for row, ident, vector, label in part:
        if ident is None or ident % every:
            continue
        found = sorted(((max(-top, min(top, sum(a * b for a, b in zip(vector, v, strict=False)))), j, k, other)
                        for k, j, v, other in part if k != row), key=key)
        for p in [f for f in found if f[3] == label][:5]:
            window = [f for f in found if f[3] != label and 50 * p[0] <= 100 * f[0] <= 95 * p[0]][:3]
            for rank, f in enumerate(window, 1):
                out[ident, p[1], rank, f[1], p[0], f[0]] += 1
    return out


def vectors(seed=1, n=400, width=6):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(10, width))
    data = []
    for i in range(n):
        c = int(rnd.integers(10))
        data.append((i, [float(np.float32(x)) for x in centres[c] + rnd.normal(size=width) * 0.7], c))
    return data


AWKWARD = [(None, [0.5] * 6, 1), (1000, None, 1), (1001, [0.1, None, 0.2, 0.0, 0.0, 0.0], 2), (1002, [float("nan")] * 6, 1),
           (1003, [float("inf")] + [0.0] * 5, 3), (1050, [], 1), (1004, [1.0, 2.0], 4), (1100, [0.0] * 6, None),
           (50, [0.3] * 6, 1), (50, [0.3] * 6, 1), (51, [0.3] * 6, 2), (51, [0.3] * 6, 2), (-50, [-0.2] * 6, 12), (1150, [0.0] * 6, 4)]
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [400, hard_negatives.BLOCK_BYTES])
def test_negatives_match_brute_force(spark, block):
    """Also where the grid has many cells in both directions."""
    data = vectors() + AWKWARD
    frame = spark.createDataFrame(data, VECTORS).repartition(3)
    got = counted(hard_negatives.mine(hard_negatives.prepared(frame), every=10, block_bytes=block))
    assert got == brute_negatives(data, 10) and len(got) > 300


def test_negatives_of_equal_vectors(spark):
    """A vector that a third of the rows share: ties go by id."""
    data = [(i, [0.5, 0.25] if i % 3 else [0.45, 0.3 + i / 4000], 1 + (i % 3 and i % 2)) for i in range(300)]
    data += [(i, [0.5 * 0.8, 0.25 * 0.8], 4) for i in range(301, 500, 2)]
    frame = spark.createDataFrame(data, VECTORS)
    got = counted(hard_negatives.mine(hard_negatives.prepared(frame), block_bytes=800))
    data = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in data]
    assert got == brute_negatives(data) and got


@pytest.mark.parametrize("scale", [1e4, 1e7, 1e30])
def test_negatives_of_huge_components(spark, scale):
    """Products beyond 2^53 stay exact, those beyond 64 bits are its limit."""
    data = [(i, [v * scale for v in vec], k) for i, vec, k in vectors(3, 60, 3)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = counted(hard_negatives.mine(hard_negatives.prepared(frame), every=5))
    assert got == brute_negatives(data, 5)


def test_negative_labels_match_sql(spark, tmp_path):
    """The remainder of a negative label is negative: -4 is next to -5, not 6."""
    data = [(i, v, k - 12) for i, v, k in vectors(5)] + [(i + 400, v, k) for i, v, k in vectors(6)]
    spark.createDataFrame(data, VECTORS).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    key = "op11_hard_negatives"
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], str(tmp_path))
    assert res["status"] == "ok", res


def test_limits_of_any_score(spark):
    scores = [0, 1, -1, 2, 99, 100, 101, -100, 2 ** 63 - 1, -2 ** 63 + 1, 12345678901234567]
    got = spark.createDataFrame([(s,) for s in scores], "s long").select(
        "s", hard_negatives.lower_limit(F.col("s")).alias("low"), hard_negatives.upper_limit(F.col("s")).alias("high")).collect()
    for r in got:
        assert (r["low"], r["high"]) == (-((-50 * r["s"]) // 100), 95 * r["s"] // 100)


def test_group_limit_holds_before_the_shuffle(spark):
    found = spark.range(1000).selectExpr("id % 7 AS anchor", "hash(id) AS score", "id", "id + 1 AS row")
    plan = hard_negatives._top(found, 3, "anchor")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_empty_vectors_table(spark, tmp_path):
    spark.createDataFrame([], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_hard_negatives"](spark, str(tmp_path)).count() == 0


def test_awkward_vectors_match_sql(spark, tmp_path):
    data = [r for r in vectors() + AWKWARD if r[1] is None or len(r[1]) == 6]  # SQL multiplies equal lengths only
    spark.createDataFrame(data, VECTORS).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    key = "op11_hard_negatives"
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], str(tmp_path))
    assert res["status"] == "ok", res
    assert compare(spark, duck(SF001), key, QUERIES[key], ORACLE[key], SF001)["status"] == "ok"
