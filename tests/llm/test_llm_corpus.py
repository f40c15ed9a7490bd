"""Operators on whole tables against brute force, and the pipeline."""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SF001
from llm_cases import prose, rows, table
from oracle_check import compare, duck
from pyspark.sql import functions as F

from taxiframe.llm import hmm, line_dedup, mixing, near_join, packing
from taxiframe.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def awkward_dir(docs, tmp_path_factory):
    """The awkward rows as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return folder


def counted(frame):
    return Counter(tuple(r) for r in frame.collect())


#: The queries on ``documents``.
ON_DOCUMENTS = sorted(set(QUERIES) - {"op11_hard_negatives"})


@pytest.mark.parametrize("key", sorted(set(ORACLE) & set(ON_DOCUMENTS)))
def test_awkward_rows_match_sql(spark, awkward_dir, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{awkward_dir}/documents.parquet/*.parquet'")
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], awkward_dir)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_smallest_table_matches_sql(spark, key):
    res = compare(spark, duck(SF001), key, QUERIES[key], ORACLE[key], SF001)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("key", ON_DOCUMENTS)
def test_empty_table(spark, tmp_path, key):
    empty = str(tmp_path)
    table(spark).limit(0).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(
        f"{empty}/documents.parquet")
    assert QUERIES[key](spark, empty).count() == 0


# --- n-gram Jaccard join

def brute_links(data):
    def sh(text):
        w = WORD.findall(text or "")
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [sh(t) for _, t in data]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and (a == b or a & b and len(a & b) >= 0.8 * len(a | b)):
                near[i].add(j)
    root = list(range(len(data)))
    for _ in data:
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(len(data))]
    ids = {r: min((data[i][0] for i in range(len(data)) if root[i] == r and data[i][0] is not None), default=None)
           for r in set(root)}
    return Counter((d[0], ids[root[i]], len(near[i])) for i, d in enumerate(data))


@pytest.mark.parametrize("part", [5, 128])
def test_near_group_in_parts(spark, part):
    """A large group of near copies, also where it is cut into parts."""
    base = prose(9, 150).split(" ")
    data = [(0, " ".join(base)), (1, " ".join(base)), (2, None), (3, "")]
    for i in range(40):
        w = list(base)
        w[(3 * i) % len(w)] = f"edit{i}"
        data.append((10 + i, " ".join(w)))
    data += [(100 + i, prose(50 + i, 80)) for i in range(20)] + [(10, data[4][1])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert counted(near_join.near_links(docs, part=part)) == brute_links(data)


def test_links_of_pairs_that_meet_in_no_tree(spark):
    """At full depth about one pair in a hundred at 0.8 shares no tree node;
    in one component its link is counted all the same."""
    base = prose(21, 96).split()
    data = [(i, " ".join([*base[:i + 10], f"edit{i}", *base[i + 11:]])) for i in range(60)]
    nodes = [set(near_join.prefixes(near_join.shingles(t), near_join.DEPTH)) for _, t in data]
    assert any(a.isdisjoint(b) for a in nodes for b in nodes)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert counted(near_join.near_links(docs, recall=0.0)) == brute_links(data)


def test_prefix_is_shortened_to_the_recall():
    assert near_join.prefix_length(recall=0.0) == near_join.DEPTH
    d = near_join.prefix_length()
    assert 1 - (1 - 0.8 ** d) ** near_join.TREES >= near_join.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** near_join.TREES
    assert near_join.prefix_length(similarity=0.01) == 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"\xf0", b"\xf1")],
                                  "a binary, b binary")
    got = {bytes(r["member"]): bytes(r["root"]) for r in near_join.components(links, "chain").collect()}
    assert got == {**{bytes([i]): b"\x00" for i in range(41)}, b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def test_keep_one(spark, docs):
    kept = near_join.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {r["class_id"] for r in near_join.near_links(docs).collect()}
    assert kept.count() == len(brute_links([(r[0], r[1]) for r in rows()]) and {
        c for _, c, _ in brute_links([(r[0], r[1]) for r in rows()])}) == len(classes)


# --- line dedup

def test_line_dedup_removes_shared_passages(spark):
    passage = " ".join(f"Sentence number {i} of the shared passage has {i * 7} words." for i in range(12))
    data = [(i, f"Intro {i} alone.\n{passage}\nThe end of {i}.") for i in range(5)] + [(9, "Clean text. It stays.")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out[0] == data[0][1] and out[9] == data[5][1]
    assert all(out[i] == f"Intro {i} alone.\nThe end of {i}." for i in range(1, 5))


@pytest.mark.parametrize("words", [50, 100])
@pytest.mark.parametrize("place", ["lines", "inside", "line", "short lines"])
def test_line_dedup_finds_planted_passages(spark, place, words):
    """Passages in two documents each, as lines, inside a line, as one line, as lines of a few words."""
    rnd = np.random.default_rng(words)

    def sentence(n):
        return " ".join(f"w{x}" for x in rnd.integers(0, 50_000, n)) + "."

    def sentences(total, n):
        return [sentence(n) for _ in range(total // n)]

    data, passages = [], []
    for i in range(40):
        parts = sentences(words, 4 if place == "short lines" else 12 if words > 50 else 10)
        passages.append(parts)
        for doc in (2 * i, 2 * i + 1):
            before, after = sentences(60, 10), sentences(60, 10)
            if "lines" in place:
                text = "\n".join([*before, *parts, *after])
            elif place == "line":
                text = "\n".join([*before, " ".join(parts), *after])
            else:
                text = "\n".join([" ".join([*before, *parts, *after]), sentence(10)])
            data.append((doc, text))
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for i, parts in enumerate(passages):
        assert all(p in out[2 * i] for p in parts)
        assert not any(p in out[2 * i + 1] for p in parts)
    for doc, text in data:
        own = [u for u in re.split(r"(?<=[.]) |\n", text) if u not in passages[doc // 2]]
        assert all(u in out[doc] for u in own)  # nothing else is removed


def test_chunks_of_equal_hashes_are_compared(spark, monkeypatch):
    """Where all chunks have the same hashes, their texts decide."""
    data = [(i, "\n".join(f"line {j} of some kind has a few more words" for j in (i % 3, 7, 8 + i % 2))) for i in range(9)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    want = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    plain = line_dedup.chunks
    monkeypatch.setattr(line_dedup, "chunks", lambda text: F.transform(plain(text), lambda c: F.struct(
        c["first"].alias("first"), c["n"].alias("n"), F.lit(1).cast("long").alias("hash"))))
    whole = line_dedup.removed_units
    monkeypatch.setattr(line_dedup, "removed_units", lambda d, i, t: whole(d, i, t, lambda c: F.lit(2).cast("long")))
    assert Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()) == want
    assert want != Counter(data)


def test_line_dedup_leaves_each_unit_somewhere(spark, docs):
    """Overlapping repeats, also inside a text: no unit vanishes from the corpus."""
    rnd = np.random.default_rng(4)
    lines = [f"line {i} has a few more words in it" for i in range(6)]
    data = [(i, "\n".join(lines[j] for j in rnd.integers(0, 6, rnd.integers(1, 9)))) for i in range(60)]
    out = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    left = {u for r in out for u in r["text"].split("\n")}
    assert {u for _, t in data for u in t.split("\n")} <= left
    assert sum(r["removed"]["units"] for r in out) > 100


def test_line_dedup_keeps_columns(docs):
    clashing = docs.withColumnsRenamed({"key": "removed", "mix": "text.x", "quality": "row_key"})
    got = line_dedup.dedup_lines(clashing)
    assert got.columns == [*clashing.columns, "_removed"] and got.count() == docs.count()


def test_units_cover_the_text(spark, docs):
    for r in docs.select("text", line_dedup.units(docs["text"]).alias("u")).collect():
        assert r["text"] is None or "".join(r["u"]) == r["text"]


# --- mixing

def test_mix_comes_near_its_targets(spark, docs):
    got = mixing.mix(docs)
    assert got.columns == [*docs.columns, "_mix"]
    r = got.select("source", "_mix.*").collect()
    assert len(r) == docs.count()
    total = sum({(x["source"], x["source_size"]) for x in r} and [s for _, s in {(x["source"], x["source_size"]) for x in r}])
    targets = {x["source"]: x["target"] for x in r}
    assert math.isclose(sum(targets.values()), 1.5 * total)
    for s, target in targets.items():
        mine = [x for x in r if x["source"] == s]
        assert abs(sum(x["taken"] for x in mine) - target) <= max(x["size"] for x in mine) / 2 + 1e-6
        assert all(0 <= x["taken"] <= 2 * x["size"] for x in mine)
    again = mixing.mix(docs).select("doc_id", "text", "_mix.taken")
    assert counted(again) == counted(got.select("doc_id", "text", "_mix.taken"))


def test_emit_repeats_documents(docs):
    mixed = mixing.mix(docs)
    assert mixing.emit(mixed, "_mix").count() == sum(r[0] for r in mixed.select("_mix.times").collect())


# --- packing

def check_packing(pieces, size):
    by = defaultdict(list)
    for r in pieces:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def best_fit(lengths, size):
    """Sequences of lengths: largest first, each into the fullest one with room."""
    out = []
    for n in sorted(map(int, lengths), reverse=True):
        room = [(sum(b), i) for i, b in enumerate(out) if sum(b) + n <= size]
        if room:
            out[max(room)[1]].append(n)
        else:
            out.append([n])
    return out


@pytest.mark.parametrize(("part", "fan_in", "slack"), [(150, 2, 1), (40, 3, 0), (50_000, 16, 16)])
def test_packing_is_whole_and_tight(spark, part, fan_in, slack):
    """Trees of several levels, of a few, and of a single node."""
    rnd = np.random.default_rng(3)
    lengths = [int(x) for x in rnd.integers(1, 101, 1500)] + [100] * 20
    pieces = spark.createDataFrame([(i if i % 50 else None, 0, 0, n, i) for i, n in enumerate(lengths)],
                                   packing.PIECE.format(id="long")).repartition(9)
    got = packing.pack(pieces, size=100, part=part, fan_in=fan_in, slack=slack).collect()
    assert Counter((r["doc_id"], r["length"]) for r in got) == Counter(
        (i if i % 50 else None, n) for i, n in enumerate(lengths))
    bins, whole = check_packing(got, 100), len(best_fit(lengths, 100))
    assert bins == whole if part == 50_000 else bins <= whole * (1.03 if part == 150 else 1.12)


def test_packing_of_sorted_lengths(spark):
    """Long pieces in some tasks and short ones in others fill each other's space."""
    rnd = np.random.default_rng(5)
    lengths = np.sort(np.concatenate([rnd.integers(520, 760, 6000), rnd.integers(30, 480, 6000), [1024] * 9]))
    pieces = spark.createDataFrame(spark.sparkContext.parallelize(
        [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)], 8), packing.PIECE.format(id="long"))
    got = packing.pack(pieces, part=2000).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(lengths)))
    assert check_packing(got, 1024) <= (6000 + 9) * 1.01  # two long pieces never share a sequence


@pytest.mark.parametrize("size", [1, 7, 100])
def test_plan_by_counts_is_best_fit(size):
    rnd = np.random.default_rng(size)
    for n in (0, 1, 50, 600):
        lengths = rnd.integers(1, size + 1, n)
        rules, bins = packing.best_fit_plan(np.bincount(lengths, minlength=size + 1), size)
        fills, ranks = Counter(), Counter()
        for length, low, high, first, offset in sorted(rules.tolist(), key=lambda r: (-r[0], r[1])):
            assert low == ranks[length]
            ranks[length] = high
            for j in range(high - low):
                assert fills[first + j] == offset
                fills[first + j] += length
        assert ranks == Counter(lengths.tolist())
        assert sorted(fills.values()) == sorted(map(sum, best_fit(lengths, size)))
        assert sorted(fills.values()) == sorted(used for used, low, high in bins.tolist() for _ in range(low, high))


def test_underfull_bins_are_items_of_the_node_above():
    counts = np.zeros(101, np.int64)
    counts[60], counts[97], counts[30] = 3, 2, 1
    rules, bins = packing.best_fit_plan(counts, 100)
    assert bins.tolist() == [[60, 3, 5], [90, 2, 3], [97, 0, 2]]
    assert packing.underfull(bins, 100, 5, False).tolist() == [True, True, False]
    assert not packing.underfull(bins, 100, 5, True).any()
    above = np.array([[60, 0, 1, 70, 40], [60, 1, 2, 90, 0], [90, 0, 1, 80, 5]])
    placed = packing.placements(counts, above, 1000, 100, 5, False)
    assert placed.tolist() == [[30, 0, 1, 80, 65], [60, 0, 1, 80, 5], [60, 1, 2, 70, 40], [60, 2, 3, 90, 0],
                               [97, 0, 2, 1000, 0]]


def test_packing_query(spark, awkward_dir):
    got = QUERIES["op10_best_fit_packing"](spark, awkward_dir).collect()
    check_packing(got, 1024)
    assert len({(r["doc_id"], r["piece"], r["ids_crc32"]) for r in got}) <= len(got)


# --- hidden Markov model

def brute_forward(model, seq):
    a = model.start * model.emit[seq[0]]
    for s in seq[1:]:
        a = (a @ model.move) * model.emit[s]
    return math.log(a.sum())


def small_model(symbols=5, states=3):
    rnd = np.random.default_rng(2)
    move, emit = rnd.uniform(0.1, 1, (states, states)), rnd.uniform(0.1, 1, (symbols, states))
    return hmm.Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_and_expected_counts():
    model = small_model()
    rnd = np.random.default_rng(4)
    seqs = [rnd.integers(0, 5, n) for n in (1, 2, 7, 7, 3)]
    out = np.zeros(5)
    for chosen, symbols, live in hmm.batches_of(seqs):
        out[chosen] = hmm.forward(model, symbols, live, False)[0]
    assert np.allclose(out, [brute_forward(model, s) for s in seqs])
    start, move, emit = hmm.expected(model, seqs)
    assert math.isclose(start.sum(), 5) and math.isclose(move.sum(), 15) and math.isclose(emit.sum(), 20)
    # The expected counts are the derivatives of the log likelihood by the logs of the parameters.
    total = lambda m: sum(brute_forward(m, s) for s in seqs)
    for i, j in ((0, 1), (2, 2)):
        bumped = model.move.copy()
        bumped[i, j] *= math.exp(1e-6)
        assert math.isclose((total(model._replace(move=bumped)) - total(model)) / 1e-6, move[i, j], rel_tol=1e-3)
    bumped = model.emit.copy()
    bumped[3, 1] *= math.exp(1e-6)
    assert math.isclose((total(model._replace(emit=bumped)) - total(model)) / 1e-6, emit[3, 1], rel_tol=1e-3)


def test_counts_by_symbol_of_all_states():
    rnd = np.random.default_rng(3)
    symbols, values = rnd.integers(0, 9, 500), rnd.uniform(size=(500, 4))
    want = np.array([np.bincount(symbols, values[:, s], 11) for s in range(4)]).T
    assert np.allclose(hmm.by_symbol(symbols, values, 11), want)
    assert hmm.by_symbol(np.array([7]), np.ones((1, 2)), 8)[7].tolist() == [1.0, 1.0]


def test_expected_counts_gather_the_emissions_once():
    """One look-up of the emissions for a batch, which both directions use."""
    class Counted(np.ndarray):
        looked = 0

        def __getitem__(self, key):
            Counted.looked += 1
            return np.asarray(super().__getitem__(key))

    model = small_model()
    hmm.expected(model._replace(emit=model.emit.view(Counted)), [np.array([0, 1, 2, 3]), np.array([4, 1])])
    assert Counted.looked == 1


def test_packed_ids_round_trip():
    ids = np.array([0, 1, 65535, 65536, 2 ** 24 - 1])
    assert hmm.unpack_ids(hmm.pack_ids(ids)).tolist() == ids.tolist()


def test_symbols_are_ranked_by_the_whole_count(spark):
    """A word that is rare in every block but has many occurrences in all."""
    rows = [(b, 0, b"often", 5, False) for b in range(20)] + [(0, 1, b"once", 1, True), (0, 2, b"held", 0, False)]
    got = hmm.count_words(spark.createDataFrame(rows, "block long, id int, word binary, n long, common boolean"))
    symbols = {(r["id"], r["symbol"] < hmm.WORDS) for r in got.collect()}
    assert symbols == {(0, True), (1, True), (2, False)}


def test_training_starts_without_a_sample(spark):
    """Before the first round over all documents, only their shares of symbols count."""
    frame = spark.createDataFrame([(i, False, np.arange(i, i + 9).astype("<u2").tobytes()) for i in range(50)],
                                  "doc_id long, held boolean, symbols binary")
    background = np.full(hmm.SYMBOLS, 1 / hmm.SYMBOLS)
    assert np.array_equal(hmm.train(frame, background, 0).emit, hmm.Model.initial(background).emit)
    assert not np.allclose(hmm.train(frame, background, 1).emit, hmm.Model.initial(background).emit)


def brute_base(data):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[*WORD.findall((t or "").translate(lower)), None] for _, t in data]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in data]
    c = Counter(w for ts, h in zip(tokens, held, strict=True) if not h for w in ts)
    n, v = sum(c.values()), len(c)
    return Counter((d, h, len(ts), sum(c[w] > 0 for w in ts), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts), 4))
                   for (d, _), h, ts in zip(data, held, tokens, strict=True))


@pytest.mark.parametrize("small", [True, False])
def test_base_scores(spark, docs, small):
    given = docs if small else spark.read.parquet(f"{SF001}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in given.collect()]
    got = hmm.score_documents(given, rounds=1).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    round(r["base_score"], 4)) for r in got) == brute_base(data)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    got = QUERIES["op7_hidden_markov_scores"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    tokens = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / tokens > sum(r["base_score"] for r in got) / tokens


# --- the pipeline

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "mix_sources", "best_fit_packing"]
    sizes = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(os.path.join(tmp_path, name))
        docs = spark.read.parquet(os.path.join(tmp_path, name))
        sizes.append(docs.count())
    assert sizes[0] < 200 and sizes[1] == sizes[0] and sizes[2] < sizes[1]
    last = docs.collect()
    check_packing(last, 1024)
    assert counted(corpus_pipeline.run(spark, SF001).select("doc_id", "piece", "ids_crc32")) == Counter(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in last)


def test_pipeline_stages_on_clashing_columns(spark, docs):
    """Every stage on awkward rows whose extra columns have the names the operators use."""
    names = {"mix": "label.x", "quality": "mix", "key": "kept"}
    whole = docs.withColumnsRenamed(names).withColumns({
        "row_key": F.lit("k"), "rows": F.lit(3), "removed": F.lit(True), "copy": F.lit(0), "base_failed": F.lit("no"),
        "host_of_document": F.lit(1.5), "a`b": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, whole, SF001)
        rows = out.collect()
        if name == "best_fit_packing":
            check_packing(rows, 1024)
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
        else:
            assert out.columns == whole.columns and out.schema["label.x"] == whole.schema["label.x"]
            assert all(r["row_key"] == "k" and r["removed"] for r in rows)
            assert stage(spark, whole.limit(0), SF001).count() == 0


def test_pipeline_on_awkward_and_empty_rows(spark, awkward_dir, tmp_path):
    check_packing(corpus_pipeline.run(spark, awkward_dir).collect(), 1024)
    empty = str(tmp_path)
    table(spark).limit(0).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(
        f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
