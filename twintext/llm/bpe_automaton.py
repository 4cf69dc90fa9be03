"""Byte-pair encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that the
merges produce. It starts with one state in which every byte may follow every
byte. Each merge ``u v``, in order, is compiled in as a gadget: arcs labelled
``u`` are led to a copy of their target without the arc ``v``, and wherever
``u`` could be read the new arc ``uv`` may be read too, to where ``v`` led. All
arcs with one label lead to one state, so a merge adds one state, and a copy
needs to be stored as what it lacks only: ``(parent, lacking, made)``. Whether
an arc exists is looked up through these tables and remembered.

A word is encoded by running the automaton over its bytes: every prefix of a
word has exactly one accepted tokenization, hence one state, and the token that
ends a prefix is the one whose arc leaves the state at its start. Decoding emits
the labels of the arcs. The merges themselves are never replayed.

A null text counts as empty and has no tokens; equal rows give equal results; an
empty table gives none. Python tasks need this package: call
:func:`~twintext.llm.common.ship_package` before :func:`encode`. Texts are encoded whole; a word costs time in proportion
to its length. Special strings of the vocabulary file are one token each
wherever they stand. Only the named column is read. The file is read by the
executors, so its path has to exist there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import ship_package
from twintext.llm.pretokens import WordTable, splitter

_ROWS = 1_000  # handled at once
_REMEMBERED = 400_000  # arcs looked up that are kept; then the memory starts anew


@lru_cache
def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """Compiled merges: ``labels`` by token id, and pairs ``(left, right, token)`` in order."""

    def __init__(self, labels: dict[int, bytes], merges: Sequence[tuple[int, int, int]]):
        self.labels = labels
        self._left: dict[int, int] = {}
        made_from = {m[2] for m in merges}
        if len(made_from) < len(merges):
            raise ValueError("two merges make the same token")
        bytes_of = {t for t, label in labels.items() if len(label) == 1 and t not in made_from}
        self._made = dict.fromkeys(bytes_of, 0)
        self.state_after = dict.fromkeys(bytes_of, 0)
        # State 0 has an arc for every byte.
        self._parent, self._lacking, self._at = [-1], [-1], [0]
        self._arcs: dict[int, bool] = {}
        for step, (left, right, token) in enumerate(merges, 1):
            self._add(step, left, right, token)
        self._arcs.clear()
        self._trie = self._words()

    def _add(self, step: int, left: int, right: int, token: int) -> None:
        """The gadget of one merge."""
        source = self.state_after.get(left)
        if source is None or right not in self.state_after or not self._has(source, right):
            return  # earlier merges never leave these two side by side
        self.state_after[token] = self.state_after[right]
        self._left[token], self._made[token] = left, step
        self._parent.append(source)
        self._lacking.append(right)
        self._at.append(step)
        self.state_after[left] = len(self._parent) - 1

    def _has(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc ``token``."""
        made, parent, lacking, at, left = self._made, self._parent, self._lacking, self._at, self._left
        while True:
            if at[state] > made[token]:  # the arc was there, or not, when the state was copied
                if lacking[state] == token:
                    return False
                state = parent[state]
            elif made[token]:  # the arc came with its merge, wherever the left part had one
                token = left[token]
            else:
                return True

    def _words(self) -> dict:
        """Tokens by their bytes: nested tables, token and target state under key -1."""
        root: dict = {}
        for token, state in self.state_after.items():
            node = root
            for b in self.labels[token]:
                node = node.setdefault(b, {})
            node[-1] = (token, state)
        return root

    def encode(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word."""
        size = len(word)
        states: list[int | None] = [None] * (size + 1)
        ends: list[tuple[int, int] | None] = [None] * (size + 1)
        states[0] = 0
        arcs, trie = self._arcs, self._trie
        for start in range(size):
            state, node = states[start], trie
            for end in range(start, size):
                node = node.get(word[end])
                if node is None:
                    break
                found = node.get(-1)
                if found is not None and states[end + 1] is None:
                    key = state << 24 | found[0]
                    has = arcs.get(key)
                    if has is None:
                        if len(arcs) >= _REMEMBERED:
                            arcs.clear()
                        has = arcs[key] = self._has(state, found[0])
                    if has:
                        states[end + 1] = found[1]
                        ends[end + 1] = (start, found[0])
        tokens = []
        while size:
            size, token = ends[size]
            tokens.append(token)
        return tokens[::-1]

    def decode(self, tokens: Sequence[int]) -> bytes:
        """The labels of the arcs, one after the other."""
        labels = self.labels
        return b"".join([labels[t] for t in tokens])


@lru_cache
def load(path: str) -> tuple[Automaton, dict[str, int]]:
    """The automaton of a byte-level vocabulary file, and its special strings."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    byte_of = printable_bytes()
    ids = stored["model"]["vocab"]
    labels = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    specials = {t["content"]: t["id"] for t in stored["added_tokens"]}
    automaton = Automaton(labels, merges)
    automaton.labels.update({i: s.encode() for s, i in specials.items()})
    return automaton, specials


@lru_cache
def word_table(path: str) -> WordTable:
    """Token ids by word, as little-endian 32-bit integers."""
    automaton, specials = load(path)

    def compute(word: str) -> bytes:
        ids = [specials[word]] if word in specials else automaton.encode(word.encode())
        return np.array(ids, "<i4").tobytes()

    return WordTable(compute, limit=450_000)


def ids_of(texts: pa.Array, path: str) -> pa.Array:
    """Token ids of every text, as lists; null gives an empty list."""
    split = splitter(tuple(load(path)[1]))
    known = word_table(path).__getitem__
    rows = []
    for value in texts:
        words = split(value.as_py() or "")
        rows.append(b"".join([b"".join(map(known, part)) for part in words]))
    ends = np.cumsum([0, *map(len, rows)]) // 4
    values = np.frombuffer(b"".join(rows), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


@lru_cache
def _label_table(path: str) -> np.ndarray:
    labels = load(path)[0].labels
    label_of = np.empty(max(labels) + 1, object)
    for token, label in labels.items():
        label_of[token] = label
    return label_of


def texts_of(rows: pa.Array, path: str) -> pa.Array:
    """The texts behind lists of ids, malformed bytes replaced."""
    label_of = _label_table(path)
    texts = []
    for row in rows:
        known = row.values.drop_null().to_numpy() if row.is_valid else np.empty(0, "i4")
        texts.append(b"".join(label_of[known].tolist()).decode("utf-8", "replace"))
    return pa.array(texts, pa.string())


def encode(text: Column, path: str) -> Column:
    """``array<int>`` of the token ids of a text; null gives an empty array."""

    def run(texts: pa.Array) -> pa.Array:
        from twintext.llm import bpe_automaton as here

        return here.ids_of(texts, path)

    return F.arrow_udf(run, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """The text behind token ids, malformed bytes replaced; null ids or tokens are left out."""

    def run(rows: pa.Array) -> pa.Array:
        from twintext.llm import bpe_automaton as here

        return here.texts_of(rows, path)

    return F.arrow_udf(run, "string")(ids)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: every text encoded and its ids decoded.

    In one pass, as two columns would take a second worker with tables of its own.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import bpe_automaton as here

        for batch in batches:
            for k in range(0, len(batch), here._ROWS):
                part = batch.slice(k, here._ROWS)
                ids = here.ids_of(part.column(1), path)
                decoded = here.texts_of(ids, path)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoded], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    return round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
