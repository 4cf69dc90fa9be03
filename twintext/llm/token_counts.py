"""Token counts of a unigram vocabulary by dynamic programming over a trie.

The best segmentation of a word is the one of highest total score. Distinct
words go into a trie, and every node holds the forward result of the prefix it
stands for: best score and number of tokens, and the vocabulary entries that are
still being matched at its end. A prefix that words share is thus worked out
once; a word's count is read at its last node. A text's count is the sum over
its words, whole.

Of equal scores the segmentation with fewer tokens counts. Scores are integers,
so sums are exact and the result does not depend on the order of words or on
what shares a trie. The trie is emptied when it is full, which only costs time;
words longer than ``_DEEPEST`` bytes leave it there and go on alone.

A null or empty text has 0 tokens. Repeated rows are counted each; an empty
table gives none. Only the two named columns are read. The file is read by the
executors, so its path has to exist there.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import ship_package
from twintext.llm.pretokens import WordTable

_NODES = 400_000
_DEEPEST = 48
_UNIT = 1_000_000  # scores are millionths of a nat


def zipf_scores(ranks: Mapping[bytes, int]) -> dict[bytes, int]:
    """Log-probabilities by Zipf's law, in millionths: pieces by rank, single bytes last.

    The ranks of merged pieces follow their frequency, those of bytes do not.
    """
    order = sorted(ranks, key=lambda piece: (len(piece) == 1, ranks[piece]))
    share = math.log(sum(1 / n for n in range(1, len(order) + 1)))
    return {piece: -round(_UNIT * (math.log(n) + share)) for n, piece in enumerate(order, 1)}


class PrefixTrie:
    """Forward results of a vocabulary, by prefix. Every single byte has to be in it."""

    def __init__(self, scores: Mapping[bytes, int]):
        # The vocabulary as a trie of its own: (node, byte) to node, node to score.
        self._next: dict[int, int] = {}
        self._score: dict[int, int] = {}
        size = 1
        for piece, score in scores.items():
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in self._next:
                    self._next[key] = size
                    size += 1
                node = self._next[key]
            self._score[node] = score
        if any(b not in self._next or self._next[b] not in self._score for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self._clear()

    def _clear(self) -> None:
        self._children: dict[int, int] = {}
        #: By node: best score, tokens, and the entries that go on: (node in the vocabulary, score and tokens before).
        self._states: list[tuple[int, int, tuple]] = [(0, 0, ())]

    def _step(self, state: tuple[int, int, tuple], byte: int) -> tuple[int, int, tuple]:
        """The forward result one byte further."""
        score, tokens, going = state
        onward, best, fewest = [], None, 0
        for node, before, used in (*going, (0, score, tokens)):
            node = self._next.get(node << 8 | byte)
            if node is None:
                continue
            onward.append((node, before, used))
            own = self._score.get(node)
            if own is not None:
                total = before + own
                if best is None or total > best or total == best and used + 1 < fewest:
                    best, fewest = total, used + 1
        return best, fewest, tuple(onward)

    def count(self, word: bytes) -> int:
        """Tokens of the best segmentation of ``word``."""
        if len(self._states) > _NODES:
            self._clear()
        node = 0
        for byte in word[:_DEEPEST]:
            key = node << 8 | byte
            child = self._children.get(key)
            if child is None:
                child = self._children[key] = len(self._states)
                self._states.append(self._step(self._states[node], byte))
            node = child
        state = self._states[node]
        for byte in word[_DEEPEST:]:
            state = self._step(state, byte)
        return state[1]


@lru_cache
def _counter(path: str) -> WordTable:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    trie = PrefixTrie(zipf_scores(ranks))
    return WordTable(lambda word: trie.count(word.encode()))


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_tokens)``; ``path`` is a file of ranks, one per line."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import token_counts as here
        from twintext.llm.pretokens import splitter

        count, split = here._counter(path).__getitem__, splitter()
        for batch in batches:
            words, tokens = [], []
            for value in batch.column(1):
                found = [w for part in split(value.as_py() or "") for w in part]
                words.append(len(found))
                tokens.append(sum(map(count, found)))
            columns = [batch.column(0), pa.array(np.array(words, "i8")), pa.array(np.array(tokens, "i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
