"""Language model scores by a hidden Markov model over the words of a corpus.

1. Every task encodes its texts in blocks: a block has a dictionary of its
   distinct words, and its documents are places in that dictionary.
2. The dictionaries (not the texts) are shuffled by word: each word gets its
   count in all training documents. The ``WORDS`` words of largest count are
   symbols of their own, all others share the symbol of a class of word
   endings: P(word | state) = P(symbol | state) * P(word | symbol), the latter
   by add-one smoothing over all training words of the symbol.
3. The counts go back to the blocks, which become sequences of symbols.
4. Baum-Welch: every task runs the scaled forward-backward recursion over its
   training sequences and emits expected counts by state and symbol, which are
   added up over all tasks. The parameters are ``STATES x symbols`` numbers
   and go to all tasks. Starting values are the symbols' shares in all training
   documents, spread at random by state; no round runs on a sample.
5. The scaled forward recursion gives the likelihood of every whole document.

Words are lower-cased (A-Z); each document ends with one end token. Training
takes the documents whose CRC-32 of the id (as text) modulo ``FOLDS`` is not
``HELD``; a null id is a training document. Null and empty texts consist of
the end token; rows count as often as they occur; an empty table gives an
empty result, and with no training document all words are unknown.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxiframe.llm.common import materialize

FOLDS, HELD = 7, 2
#: Symbols of their own, classes of the other words, hidden states.
WORDS, CLASSES, STATES = 2048, 512, 8
#: Rounds over all training documents; spread of the starting values.
ROUNDS, SPREAD = 3, 1.0
#: A block ends after so many bytes of text; a batch of sequences has so many places.
BLOCK, BATCH = 8 << 20, 1 << 17
END = WORDS + CLASSES
SYMBOLS = END + 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def pack_ids(ids: np.ndarray) -> bytes:
    """Numbers below 2**24 as their low 16 bits, then their high 8 bits."""
    return ids.astype("<u2").tobytes() + (ids >> 16).astype("u1").tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    n = len(data) // 3
    return np.frombuffer(data, "<u2", n).astype(np.int64) + (np.frombuffer(data, "u1", n, 2 * n).astype(np.int64) << 16)


def encode_blocks(docs: DataFrame) -> DataFrame:
    """Rows of documents (``doc_id``, ``held``, ``ids``) and of dictionary entries
    (``id``, ``word``, ``n``: occurrences in training documents), by ``block``.
    ``docs``: ``doc_id, text, held``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def block_rows(block: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        places: dict[bytes, int] = defaultdict()
        places.default_factory = places.__len__
        coded, trained, ids_type = [], [np.zeros(0, np.int32)], rows[0][3]
        for _, text, held, _ in rows:
            words = text.lower().split()
            ids = np.fromiter(map(places.__getitem__, words), np.int32, len(words))
            coded.append(pack_ids(ids))
            if not held:
                trained.append(ids)
        counts = np.bincount(np.concatenate(trained), minlength=len(places))
        for i in range(0, len(rows), 500):
            part = rows[i:i + 500]
            yield build(block, [r[0] for r in part], [r[2] for r in part], coded[i:i + 500], [], [], [], ids_type)
        words = list(places)
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            yield build(block, [], [], [], list(range(i, i + len(part))), part, counts[i:i + 20_000].tolist(), ids_type)

    def build(block, doc_ids, held, ids, places, words, ns, ids_type) -> pa.RecordBatch:
        d, w = len(doc_ids), len(places)
        return pa.RecordBatch.from_arrays([
            pa.array([block] * (d + w), pa.int64()), pa.array(doc_ids + [None] * w, ids_type),
            pa.array(held + [None] * w, pa.bool_()), pa.array(ids + [None] * w, pa.binary()),
            pa.array([None] * d + places, pa.int32()), pa.array([None] * d + words, pa.binary()),
            pa.array([None] * d + ns, pa.int64())],
            ["block", "doc_id", "held", "ids", "id", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, rows = TaskContext.get().partitionId() << 24, 0, []
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text, held in zip(batch.column(0), texts, batch.column(2), strict=True):
                rows.append((doc_id.as_py(), text.as_py() or b"", held.as_py(), batch.column(0).type))
                size += len(rows[-1][1])
                if size >= BLOCK:
                    yield from block_rows(block, rows)
                    block, size, rows = block + 1, 0, []
        if rows:
            yield from block_rows(block, rows)

    return docs.select("doc_id", "text", "held").mapInArrow(
        run, f"block long, doc_id {kind}, held boolean, ids binary, id int, word binary, n long")


def count_words(blocks: DataFrame) -> DataFrame:
    """``block, id, c, symbol, first``: for each dictionary entry the count of
    its word in all training documents; ``first`` marks one entry of a word."""
    entries = blocks.where("id is not null").select("block", "id", "word", "n")
    # A bounded table, by counts of the whole corpus: it doesn't depend on blocks.
    top = entries.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "word").limit(WORDS).select("word", F.lit(1).alias("one"))
    top = materialize(top.withColumn("symbol", (F.row_number().over(Window.partitionBy("one").orderBy("word")) - 1)
                                     ).select("word", "symbol"), "hmm-words")
    ending = F.lit(WORDS) + F.pmod(F.crc32(F.expr("right(hex(word), 4)").cast("binary")), F.lit(CLASSES))
    same = Window.partitionBy("word")
    return (entries.join(F.broadcast(top), "word", "left")
            .withColumn("c", F.sum("n").over(same)).withColumn("one", F.min("block").over(same))
            .select("block", "id", "c", F.coalesce("symbol", ending).cast("int").alias("symbol"),
                    (F.col("one") == F.col("block")).alias("first")))


def to_symbols(blocks: DataFrame, counted: DataFrame) -> DataFrame:
    """Documents as ``doc_id, held, n_tokens, n_known, logs, class_logs, symbols``:
    the sums of log10(c + 1) over all words and over those of shared symbols."""
    kind = blocks.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held", "n_words", "n_known", "logs", "class_logs", "symbols"]

    def join(docs: pa.Table, words: pa.Table) -> pa.Table:
        at = words.column("id").to_numpy()
        c, symbol = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        c[at], symbol[at] = words.column("c").to_numpy(), words.column("symbol").to_numpy()
        logs = np.log10(c + 1.0)
        shared = np.where(symbol >= WORDS, logs, 0.0)
        rows = []
        for data in docs.column("ids"):
            ids = unpack_ids(data.as_py())
            rows.append((len(ids), int((c[ids] > 0).sum()), float(logs[ids].sum()), float(shared[ids].sum()),
                         symbol[ids].astype("<u2").tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        arrays = [docs.column("doc_id").combine_chunks(), docs.column("held").combine_chunks(),
                  *[pa.array(x, t) for x, t in zip(columns, types, strict=True)]]
        return pa.Table.from_arrays(arrays, names)

    docs = blocks.where("ids is not null").select("block", "doc_id", "held", "ids")
    return docs.groupBy("block").cogroup(counted.select("block", "id", "c", "symbol").groupBy("block")).applyInArrow(
        join, f"doc_id {kind}, held boolean, n_words long, n_known long, logs double, class_logs double, "
              "symbols binary")


class Model(NamedTuple):
    start: np.ndarray  # by state
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # symbol, state

    @staticmethod
    def initial(background: np.ndarray, states: int = STATES, seed: int = 7) -> Model:
        random = np.random.default_rng(seed)
        emit = background[:, None] * np.exp(SPREAD * random.normal(size=(len(background), states)))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def batches_of(sequences: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Sequences of similar length, longest first: their places, the symbols by
    time and sequence, and how many sequences there are at each time."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        longest = len(sequences[order[at]])
        n = min(512, max(1, BATCH // longest))
        chosen = order[at:at + n]
        lengths = np.array([len(sequences[i]) for i in chosen])
        symbols = np.zeros((longest, len(chosen)), np.int64)
        for j, i in enumerate(chosen):
            symbols[:lengths[j], j] = sequences[i]
        yield chosen, symbols, np.searchsorted(-lengths, -np.arange(longest), side="left")
        at += n


def forward(model: Model, symbols: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood by sequence; scaled forward values and scales by time."""
    return recursion(model, model.emit[symbols], live, keep)


def recursion(model: Model, emitted: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`forward` from the emission probabilities by time, sequence and state."""
    times, n, states = emitted.shape
    alphas = np.zeros((times, n, states)) if keep else np.zeros((0, 0, 0))
    scales, ones = np.ones((times, n)), np.ones(states)
    alpha = model.start * emitted[0]
    for t in range(times):
        k = live[t]
        if t:
            alpha = alpha[:k] @ model.move
            alpha *= emitted[t, :k]
        scale = alpha @ ones
        alpha /= scale[:, None]
        scales[t, :k] = scale
        if keep:
            alphas[t, :k] = alpha
    return np.log(scales).sum(0), alphas, scales


def expected(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of starts, moves and emissions."""
    states = len(model.start)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((len(model.emit), states))
    for _, symbols, live in batches_of(sequences):
        emitted = model.emit[symbols]
        _, alphas, scales = recursion(model, emitted, live, True)
        times, n = symbols.shape
        # Becomes by time what the next time gives a state (0 where there is none).
        emitted /= scales[:, :, None]
        beta, back = np.ones((n, states)), model.move.T.copy()
        gamma = np.zeros((times, n, states))  # 0 where a sequence has ended
        gamma[-1, :live[-1]] = alphas[-1, :live[-1]]
        for t in range(times - 2, -1, -1):
            k, more = live[t], live[t + 1]
            ahead = emitted[t + 1, :more]
            ahead *= beta[:more]
            emitted[t + 1, more:] = 0.0
            np.matmul(ahead, back, out=beta[:more])
            np.multiply(alphas[t, :k], beta[:k], out=gamma[t, :k])
        start += gamma[0].sum(0)
        emit += by_symbol(symbols.ravel(), gamma.reshape(-1, states), len(emit))
        if times > 1:
            move += model.move * (alphas[:-1].reshape(-1, states).T @ emitted[1:].reshape(-1, states))
    return start, move, emit


def by_symbol(symbols: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` by symbol."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    found = symbols[order]
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    out = np.zeros((size, values.shape[1]))
    out[found[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def estimate(counts: tuple[np.ndarray, np.ndarray, np.ndarray], background: np.ndarray) -> Model:
    """Parameters from expected counts, smoothed by the symbols' shares."""
    start, move, emit = counts
    start, move, emit = start + 1.0, move + 1.0, emit + 2.0 * len(emit) ** 0.5 * background[:, None]
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def sequence(data: bytes) -> np.ndarray:
    return np.append(np.frombuffer(data, "<u2").astype(np.int64), END)


def expected_rows(model: Model):
    """A function for mapInArrow: sums of expected counts of a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = expected(model, [sequence(x.as_py()) for x in batch.column(0)]) if batch.num_rows else None
            if part:
                total = part if total is None else tuple(a + b for a, b in zip(total, part, strict=True))
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.float64())], ["at", "n"])

    return run


def train(documents: DataFrame, background: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training documents of ``to_symbols``."""
    model = Model.initial(background)
    shapes = [model.start.shape, model.move.shape, model.emit.shape]
    for _ in range(rounds):
        # One number per state and state or symbol reaches the driver.
        sums = documents.where("not held").select("symbols").mapInArrow(
            expected_rows(model), "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
        flat = np.zeros(sum(int(np.prod(s)) for s in shapes))
        for r in sums:
            flat[r["at"]] = r["n"]
        parts, i = [], 0
        for s in shapes:
            parts.append(flat[i:i + int(np.prod(s))].reshape(s))
            i += int(np.prod(s))
        model = estimate(tuple(parts), background)
    return model


def score(documents: DataFrame, model: Model, class_logs: np.ndarray, rest: list[str]) -> DataFrame:
    """``rest`` columns and ``likelihood``: log10 of the symbols' probability
    less, for each word of a shared symbol, the log10 of the symbol's mass."""
    fields = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = [sequence(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            out = np.zeros(len(sequences))
            for chosen, symbols, live in batches_of(sequences):
                out[chosen] = forward(model, symbols, live, False)[0] / np.log(10)
            for i, s in enumerate(sequences):
                out[i] -= class_logs[s].sum()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*rest, "likelihood"])

    return documents.select(*rest, "symbols").mapInArrow(run, f"{fields}, likelihood double")


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    given = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"),
                        held_out(docs[doc_id]).alias("held"))
    blocks = materialize(encode_blocks(given), "hmm-blocks")
    counted = materialize(count_words(blocks), "hmm-words-counted")
    documents = materialize(to_symbols(blocks, counted), "hmm-symbols")

    ends = documents.where("not held").count()
    by_symbol = counted.where("first and c > 0").groupBy("symbol").agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()  # a row per symbol at most
    c, v = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for r in by_symbol:
        c[r["symbol"]], v[r["symbol"]] = r["c"], r["v"]
    c[END], v[END] = ends, ends > 0
    tokens, distinct = int(c.sum()), int(v.sum())
    background = (c + 1.0) / (c.sum() + SYMBOLS)
    class_logs = np.where((np.arange(SYMBOLS) >= WORDS) & (np.arange(SYMBOLS) < END), np.log10(c + v + 1.0), 0.0)

    model = train(documents, background, rounds)
    rest = ["doc_id", "held", "n_words", "n_known", "logs", "class_logs"]
    scored = score(documents, model, class_logs, rest)
    base = F.col("logs") + F.lit(float(np.log10(ends + 1.0))) - (F.col("n_words") + 1) * F.lit(
        float(np.log10(tokens + distinct + 1.0)))
    return scored.select(
        "doc_id", F.col("held").alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("likelihood") + F.col("class_logs")).alias("score"))
