"""Token sequences kept as strings.

A *token string* holds one code point per token: a byte is the code point of
the same value, a merged token the code point of its id. Replacing an adjacent
pair by its merged token is then the built-in ``replace``, which works left to
right without overlaps and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from twintext.functions.kernels import (
    gatherer,
    id_writer,
    merger,
    reader_of,
    sequence_reader,
    sequence_writer,
    slicer,
    text_reader,
)

_SURROGATES_FROM = 0xD800
_SURROGATES = 0x800


class Merge(NamedTuple):
    """One learned merge: ``left`` followed by ``right`` becomes ``token``."""

    left: int
    right: int
    token: int


def token_char(token: int) -> str:
    """The code point that stands for ``token`` (surrogates are skipped)."""
    return chr(token if token < _SURROGATES_FROM else token + _SURROGATES)


def pair_string(left: int, right: int) -> str:
    return token_char(left) + token_char(right)


def to_byte_tokens(text: Column) -> Column:
    """Token string of the UTF-8 bytes of ``text`` (string or binary)."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def replace_pairs(seq: Column, merges: Iterable[Merge]) -> Column:
    """Apply a few merges in id order as nested replacements."""
    for m in merges:
        seq = F.replace(seq, F.lit(pair_string(m.left, m.right)), F.lit(token_char(m.token)))
    return seq


def encode_tokens(seq: Column, merges: Sequence[Merge]) -> Column:
    """Apply a whole vocabulary to a token string.

    Merging the lowest known id until none is left equals one pass over the
    merges in id order: merge *t* only creates pairs that contain *t*, and all
    merges of such pairs have larger ids. A fold over a literal array keeps the
    expression tree flat for any number of merges.
    """
    if not merges:
        return seq
    ordered = sorted(merges, key=lambda m: m.token)
    pairs = F.lit([pair_string(m.left, m.right) for m in ordered])
    chars = F.lit([token_char(m.token) for m in ordered])
    steps = F.arrays_zip(pairs.alias("pair"), chars.alias("char"))
    return F.aggregate(steps, seq, lambda s, m: F.replace(s, m["pair"], m["char"]))


def token_array(seq: Column, vocab_size: int = _SURROGATES_FROM) -> Column:
    """``array<int>`` of the ids in a token string; empty for an empty string."""

    def to_id(char: Column) -> Column:
        point = F.ascii(char)
        if vocab_size > _SURROGATES_FROM:
            return F.when(point >= _SURROGATES_FROM, point - _SURROGATES).otherwise(point)
        return point

    return F.transform(F.array_remove(F.split(seq, ""), ""), to_id)


def bpe_encode_native(text: Column, merges: Sequence[Merge]) -> Column:
    """:func:`bpe_encode` with built-in expressions only; one scan per merge."""
    return token_array(encode_tokens(to_byte_tokens(text), merges), 256 + len(merges))


def bpe_encode(text: Column, merges: Sequence[Merge]) -> Column:
    """``array<int>`` of byte-pair tokens of ``text``.

    Runs on Arrow batches: the work per row is one lookup per byte and one step
    per merge carried out, where the built-in form scans the row once for every
    merge of the vocabulary.
    """
    vocab_size = 256 + len(merges)
    pieces, read, merge = slicer(), text_reader(vocab_size), merger(merges, vocab_size)

    def encode(texts: pa.Array) -> pa.Array:
        parts = []
        for piece in pieces(texts, texts.nbytes):
            tokens = merge(read(piece))
            closing = tokens == vocab_size
            ends = np.flatnonzero(closing) - np.arange(len(piece))
            offsets = pa.array(np.append(0, ends).astype("int32"))
            values = pa.array(tokens[~closing])
            parts.append(pa.ListArray.from_arrays(offsets, values, mask=piece.is_null()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return F.arrow_udf(encode, "array<int>")(text)


def merge_to_ids(rows: Column, merges: Sequence[Merge], vocab_size: int, column: str) -> Column:
    """Binary token ids after the given merges, on Arrow batches of a corpus column."""
    pieces, read = slicer(), reader_of(column, vocab_size)
    merge, write = merger(merges, vocab_size), id_writer(vocab_size)

    def run(values: pa.Array) -> pa.Array:
        parts = [write(merge(read(p))) for p in pieces(values, values.nbytes)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return F.arrow_udf(run, "binary")(rows)


def merge_sequences(seq: Column, merges: Sequence[Merge], vocab_size: int) -> Column:
    """Token string after the given merges, on Arrow batches."""
    pieces, read = slicer(), sequence_reader(vocab_size)
    merge, write = merger(merges, vocab_size), sequence_writer(vocab_size)

    def run(sequences: pa.Array) -> pa.Array:
        parts = [write(merge(read(p))) for p in pieces(sequences, sequences.nbytes)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.arrow_udf(run, "string")(seq)


def expand_merges(merges: Iterable[Merge]) -> dict[int, bytes]:
    """Bytes behind every token: single bytes, then concatenations in id order."""
    table = {b: bytes([b]) for b in range(256)}
    for m in sorted(merges, key=lambda m: m.token):
        table[m.token] = table[m.left] + table[m.right]
    return table


def bpe_decode(tokens: Column, vocabulary: dict[int, bytes]) -> Column:
    """Text behind an ``array<int>`` of tokens.

    Arrow batches of tokens gather their bytes from one table, at the same cost
    for any vocabulary; joined, they are read as UTF-8 with replacement marks
    for malformed parts. An id outside the vocabulary fails the query, as
    silently dropping it would change the text.
    """
    joined = F.arrow_udf(gatherer(vocabulary, "token"), "binary")(tokens.cast("array<int>"))
    return F.make_valid_utf8(joined.cast("string"))
