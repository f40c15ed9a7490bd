"""Token counts of a unigram tokenizer, once per shared prefix.

A pre-token is a word led by the word mark. Its tokens are the segmentation of
the highest sum of piece scores. The best score and the token count at a place
of a pre-token depend on the characters before it only, so pre-tokens with a
common prefix share them: every task collects the distinct pre-tokens of a
block of documents, walks their trie depth first with the forward scores of
the path from the root on a stack, and keeps the token count of each terminal.
Documents then add up the counts of their pre-tokens. Nothing is shuffled, and
a task holds one block and a bounded table of terminals.

Piece scores come from the order of the pieces in a given vocabulary file
(log probability by Zipf's law); nothing is trained. A character without a
piece counts as one token for each of its UTF-8 bytes. Of equal scores, fewer
tokens win. Null and empty texts have no tokens; other columns, nulls in them
and repeated rows are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import fresh

MARK = "▁"
#: What a character without a piece scores below the last piece.
UNKNOWN = 10.0
#: Characters of text that a task handles together; terminals that it keeps.
BLOCK, TERMINALS = 2_000_000, 500_000


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def piece_scores(path: str) -> dict[str, float]:
    """Log probability of each ordinary piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = log(sum(1.0 / (i + 1) for i in range(len(pieces))))
    return {p: -log(i + 1) - total for i, p in reversed(list(enumerate(pieces)))}


class Trie:
    """Token counts of pre-tokens; the terminals found so far are kept."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN
        self.terminals: dict[str, int] = {}

    def add(self, words: set[str]) -> None:
        """Terminal counts for words, in the order of a depth-first walk."""
        new = sorted(words.difference(self.terminals))
        if len(self.terminals) + len(new) > TERMINALS:
            self.terminals.clear()
            new = sorted(words)
        get, longest, unknown, terminals = self.scores.get, self.longest, self.unknown, self.terminals
        score, count = [0.0], [0]  # by depth, along the path to the last word
        path = ""
        for word in new:
            token = MARK + word
            same, most = 0, min(len(path), len(token))
            while same < most and path[same] == token[same]:
                same += 1
            del score[same + 1:], count[same + 1:]
            for end in range(same + 1, len(token) + 1):
                char = token[end - 1]
                best, tokens = score[end - 1] + unknown, count[end - 1] + len(char.encode("utf-8", "surrogatepass"))
                for start in range(max(0, end - longest), end):
                    s = get(token[start:end])
                    if s is not None:
                        s += score[start]
                        if s > best or s == best and count[start] + 1 < tokens:
                            best, tokens = s, count[start] + 1
                score.append(best)
                count.append(tokens)
            terminals[word] = count[-1]
            path = token


def blocks(texts: pd.Series) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= BLOCK:
            yield held
            held, size = [], 0
    yield held


def count_tokens(docs: DataFrame, text: str = "text", vocab: str | None = None) -> DataFrame:
    """``docs`` with the struct ``tokens`` of ``n_pretokens`` and ``n_tokens``."""
    path = vocab or vocabulary()

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trie = Trie(piece_scores(path))
        for texts in batches:
            rows = []
            for block in blocks(texts):
                words = [[w.decode("utf-8", "surrogatepass") for w in t.split()] for t in block]
                trie.add(set().union(*words))
                rows += [(len(w), sum(map(trie.terminals.__getitem__, w))) for w in words]
            yield pd.DataFrame(rows, columns=["n_pretokens", "n_tokens"], dtype="int64")

    counted = F.pandas_udf(count, "n_pretokens long, n_tokens long")
    return docs.withColumn(fresh("tokens", docs.columns), counted(docs[text]))
