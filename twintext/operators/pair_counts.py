"""Counting adjacent token pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.functions.kernels import DENSE_LIMIT, merger, pair_index, reader_of, slicer
from twintext.functions.tokens import Merge, token_array
from twintext.params import BYTE_TOKENS


def adjacent_pairs(corpus: DataFrame, vocab_size: int = BYTE_TOKENS) -> DataFrame:
    """Every adjacent pair as a row ``(ord, side, pos, weight, left, right)``."""
    ids = token_array(F.col("seq"), vocab_size)
    weight = F.col("weight") if "weight" in corpus.columns else F.lit(1).cast("long")
    return (
        corpus.select("ord", "side", weight.alias("weight"), ids.alias("ids"))
        .where(F.size("ids") > 1)
        .select(
            "ord",
            "side",
            "weight",
            F.posexplode(
                F.zip_with(
                    F.slice("ids", F.lit(1), F.size("ids") - 1),
                    F.slice("ids", F.lit(2), F.size("ids") - 1),
                    lambda left, right: F.struct(left.alias("left"), right.alias("right")),
                )
            ).alias("pos", "pair"),
        )
        .select("ord", "side", "pos", "weight", "pair.left", "pair.right")
    )


def count_pairs_native(corpus: DataFrame, vocab_size: int = BYTE_TOKENS) -> DataFrame:
    """``(left, right, n, first)`` with built-in expressions only."""
    return (
        adjacent_pairs(corpus, vocab_size)
        .groupBy("left", "right")
        .agg(F.sum("weight").alias("n"), F.min(F.struct("ord", "side", "pos")).alias("first"))
    )


def count_adjacent_pairs(
    corpus: DataFrame,
    vocab_size: int = BYTE_TOKENS,
    with_first: bool = False,
    merges: Sequence[Merge] = (),
) -> DataFrame:
    """``(left, right, n)`` over all rows, overlaps counted, never across rows.

    A map task reduces its Arrow batches to one count per distinct pair, so the
    shuffle carries at most ``vocab_size``² rows per task instead of one row
    per token. ``with_first`` adds ``first``: the smallest (ord, side, pos) at
    which the pair occurs. ``merges`` are applied to the rows beforehand.
    """
    counted = keyed_pair_counts(corpus, vocab_size, with_first, merges)
    base = F.lit(vocab_size + 1)
    return counted.select(
        F.call_function("div", F.col("pair"), base).cast("int").alias("left"),
        F.pmod(F.col("pair"), base).cast("int").alias("right"),
        "n",
        *(["first"] if with_first else []),
    )


def corpus_column(corpus: DataFrame) -> str:
    """The column that holds the rows' tokens: ids, token strings, or the text itself."""
    return next(c for c in ("ids", "seq", "text") if c in corpus.columns)


def keyed_pair_counts(
    corpus: DataFrame,
    vocab_size: int,
    with_first: bool = False,
    merges: Sequence[Merge] = (),
    watched: Sequence[tuple[int, int]] = (),
) -> DataFrame:
    """``(pair, n)`` with ``pair = left * (vocab_size + 1) + right``.

    For ``watched`` pairs there are further rows: ``-1 - (i * len(watched) + j)``
    counts the places where the j-th one starts at the second token of the i-th.
    """
    weight = F.col("weight") if "weight" in corpus.columns else F.lit(1)
    column = corpus_column(corpus)
    rows = [F.col(column), weight.cast("long").alias("weight")]
    schema = "pair long, n long"
    if with_first:
        rows += [F.col("ord").cast("long").alias("ord"), F.col("side").cast("int").alias("side")]
        schema += ", ord long, side int, pos int"
    counter = _counter(vocab_size, with_first, merges, watched, column)
    measures = [F.sum("n").alias("n")]
    if with_first:
        measures.append(F.min(F.struct("ord", "side", "pos")).alias("first"))
    return corpus.select(*rows).mapInArrow(counter, schema).groupBy("pair").agg(*measures)


def _counter(
    vocab_size: int,
    with_first: bool,
    merges: Sequence[Merge],
    watched: Sequence[tuple[int, int]],
    column: str,
) -> Callable:
    """Arrow batches of rows to partial counts."""
    base = vocab_size + 1
    dense = vocab_size <= DENSE_LIMIT
    pieces, read, merge = slicer(), reader_of(column, vocab_size), merger(merges, vocab_size)
    n_watched, watch_of = len(watched), pair_index(watched, vocab_size)

    def overlaps(pairs, spread):
        """Counts of watched pairs that follow each other with a shared token."""
        watch = watch_of(pairs)
        both = np.flatnonzero((watch[:-1] < n_watched) & (watch[1:] < n_watched))
        cells = watch[both] * n_watched + watch[both + 1]
        return np.bincount(cells, None if spread is None else spread[both], n_watched**2)

    def tally(pairs, spread):
        """Distinct pairs with their counts; the first index only if asked for."""
        if dense:
            n = np.bincount(pairs, spread, base * base).astype("int64")
            square = n.reshape(base, base)
            square[vocab_size, :] = 0
            square[:, vocab_size] = 0
            return n
        inside = np.flatnonzero((pairs % base != vocab_size) & (pairs // base != vocab_size))
        keys, first, group = np.unique(pairs[inside], return_index=True, return_inverse=True)
        n = np.bincount(group, None if spread is None else spread[inside], len(keys))
        return keys, n.astype("int64"), inside[first]

    def first_index(pairs, keys):
        # Of repeated indices the last assignment stays, hence the reversal.
        first = np.empty(base * base, "int64")
        first[pairs[::-1]] = np.arange(len(pairs) - 1, -1, -1)
        return first[keys]

    def places_of(rows, at, ends, lengths):
        """(ord, side, pos) of indexes into the tokens of a piece."""
        row = np.searchsorted(ends, at)
        place = [rows.column(i).to_numpy()[row] for i in (2, 3)]
        return [*place, (at - (ends - lengths + 1)[row]).astype("int32")]

    def earlier(places, others):
        """Element-wise lexicographic comparison."""
        less, equal = np.zeros(len(places[0]), "bool"), np.ones(len(places[0]), "bool")
        for mine, theirs in zip(places, others):
            less |= equal & (mine < theirs)
            equal &= mine == theirs
        return less

    def batch_of(keys, n, places):
        columns = {"pair": keys, "n": n}
        if with_first:
            columns.update(zip(("ord", "side", "pos"), places))
        return pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})

    def count(batches):
        totals = np.zeros(base * base if dense else 0, "int64")
        first = [np.zeros(len(totals) if with_first else 0, t) for t in ("int64", "int32", "int32")]
        shared = np.zeros(n_watched**2, "int64")
        for whole in batches:
            if with_first:
                order = np.lexsort((whole.column(3).to_numpy(), whole.column(2).to_numpy()))
                whole = whole.take(pa.array(order))
            for rows in pieces(whole, whole.nbytes):
                tokens = merge(read(rows.column(0))).astype("int64")
                ends = np.flatnonzero(tokens == vocab_size)
                lengths = np.diff(ends, prepend=-1)
                pairs = tokens[:-1] * base + tokens[1:]
                if not len(pairs):
                    continue
                weights = rows.column(1).to_numpy()
                spread = None if (weights == 1).all() else np.repeat(weights, lengths)[:-1]
                if n_watched:
                    shared += overlaps(pairs, spread).astype("int64")
                if not dense:  # a vocabulary too large for a table: one count per pair and piece
                    keys, n, at = tally(pairs, spread)
                    yield batch_of(keys, n, places_of(rows, at, ends, lengths) if with_first else ())
                    continue
                counts = tally(pairs, spread)
                if with_first:
                    keys = np.flatnonzero(counts)
                    places = places_of(rows, first_index(pairs, keys), ends, lengths)
                    better = (totals[keys] == 0) | earlier(places, [f[keys] for f in first])
                    for stored, place in zip(first, places):
                        stored[keys[better]] = place[better]
                totals += counts
        keys, cells = np.flatnonzero(totals), np.flatnonzero(shared)
        yield batch_of(keys, totals[keys], [f[keys] for f in first] if with_first else ())
        nowhere = [np.zeros(len(cells), f.dtype) for f in first]
        yield batch_of(-1 - cells, shared[cells], nowhere)

    return count
