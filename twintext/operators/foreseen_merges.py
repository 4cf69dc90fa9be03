"""Many merges settled by one pass over the corpus, along a line that was foreseen.

A pass carries out a whole line of foreseen merges, wherever it comes from, and
counts along how each of them changes the counts of its neighbours. With the
pair counts at the start this gives the exact counts of all pairs before every
merge of the line, which show how far the line is the one that counting after
each merge would have taken. What is foreseen decides the number of passes,
never the merges.

The order of neighbours in a line need not be right. The most frequent pair may
be one that stands further down, with some before it passed over. Where it
touches none of these, merging it first leaves the same tokens as merging it in
its place, so what was counted along the line holds: it tells of neighbours with
the passed merges carried out, and these neighbours are taken apart again. The
counts of all pairs are thus exact whenever the next merge is chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.functions.kernels import DENSE_LIMIT, merger, reader_of, slicer
from twintext.functions.tokens import Merge
from twintext.operators.pair_counts import corpus_column

_CELLS = 1 << 20  # counts that a line may change, at most; they go to the driver
_SWAPPED = 64  # merges of a line that may be passed over


class Settled(NamedTuple):
    """What a pass tells."""

    merges: list[tuple[int, int]]  # pairs, with the tokens of the merges before and of these
    tied: bool  # the top count is shared, so places have to decide
    line: list[Merge]  # what is foreseen to follow
    n_pairs: int  # at the start of the pass
    n_left: int  # behind its merges, but for one that is not of the line


def line_limit(vocab_size: int) -> int:
    """Merges that one pass can carry out along a line; 0 beyond vocabularies whose pairs fit a table."""
    return _CELLS // (3 * (vocab_size + 1)) if vocab_size <= DENSE_LIMIT else 0


def settle_foreseen(
    corpus: DataFrame, pending: Sequence[Merge], line: Sequence[Merge], limit: int, vocab_size: int
) -> Settled:
    """One pass along ``line``, whose tokens go on from those learned; at most ``limit`` merges."""
    size = line[0].token
    longest = min(limit, line_limit(vocab_size))
    line, further = line[:longest], line[longest:]
    vocab_size = size + len(line)
    counts, moved = _played(corpus, vocab_size, pending, line)
    n_pairs = int(counts.sum())
    taken: list[Merge] = []
    passed: list[int] = []  # places of merges that wait for later ones
    done, tied, top = 0, False, None
    while len(taken) < limit:
        present = _unmerged(counts, [line[k] for k in passed])
        (pair, n), (_, rival) = _top(present, 2)
        tied = n > 0 and n == rival
        if n <= rival:
            break
        ahead = [*passed, *range(done, min(done + _SWAPPED, len(line)))]
        place = next((k for k in ahead if line[k][:2] == pair), None)
        before = [k for k in ahead if place is not None and k < place]
        if place is None or len(before) > _SWAPPED or any(_touch(line[k], line[place]) for k in before):
            top = pair  # certain, but what follows from it was not counted
            break
        taken.append(line[place])
        _carry_out(counts, line[place], moved[place])
        done = max(done, place + 1)
        passed = sorted({*passed, *before} - {place})
    n_left = int(counts.sum())
    names = {}
    merges = []
    for pair, token in [*((m[:2], m.token) for m in taken), *([(top, None)] if top else [])]:
        names[token] = size + len(merges)
        merges.append(tuple(names.get(t, t) for t in pair))
    rest = [*passed, *range(done, len(line))]
    likely = _likely(counts, [line[k] for k in rest], moved[rest], top, limit - len(merges))
    line = renumbered([*taken, *likely, *further], merges, size)
    return Settled(merges, tied, line, n_pairs, n_left)


def renumbered(
    line: Sequence[tuple[int, int, int | None]], merges: Sequence[tuple[int, int]], size: int
) -> list[Merge]:
    """The rest of a line behind ``merges``, which were learned as tokens from ``size`` on."""
    learned = {pair: size + k for k, pair in enumerate(merges)}
    names: dict[int, int] = {}
    rest: dict[tuple[int, int], Merge] = {}
    for left, right, token in line:
        pair = tuple(names.get(t) if t >= size else t for t in (left, right))
        if None in pair:
            continue
        if pair not in learned and pair not in rest:
            rest[pair] = Merge(*pair, size + len(merges) + len(rest))
        if token is not None:
            names[token] = learned[pair] if pair in learned else rest[pair].token
    return list(rest.values())


def _top(counts: np.ndarray, k: int) -> list[tuple[tuple[int, int], int]]:
    """The ``k`` highest counts with their pairs."""
    flat = counts.ravel()
    keys = np.argpartition(flat, len(flat) - k)[-k:]
    keys = keys[np.argsort(-flat[keys])]
    return [(divmod(int(key), counts.shape[1]), int(flat[key])) for key in keys]


def _touch(first: Merge, second: Merge) -> bool:
    """Whether a merge that comes before another one matters to it."""
    return first.left == second.right or first.right == second.left or first.token in second[:2]


def _unmerged(counts: np.ndarray, passed: Sequence[Merge]) -> np.ndarray:
    """The counts with the tokens of merges that were passed over taken apart where they stand beside others."""
    if not passed:
        return counts
    counts = counts.copy()
    for merge in reversed(passed):
        counts[merge.right] += counts[merge.token]
        counts[merge.token] = 0
        counts[:, merge.left] += counts[:, merge.token]
        counts[:, merge.token] = 0
    return counts


def _carry_out(counts: np.ndarray, merge: Merge, moved: np.ndarray) -> None:
    """What merging changes: pairs that lead to its token, and pairs that follow it."""
    n = len(counts)
    left_before, left_after, right = moved[:, :n]
    counts[merge.left, merge.right] -= moved[0].sum()
    counts[:, merge.left] -= left_before
    counts[merge.right] -= right
    counts[:, merge.token] += left_after
    counts[merge.token] += right


def _likely(
    counts: np.ndarray,
    line: Sequence[Merge],
    moved: np.ndarray,
    top: tuple[int, int] | None,
    room: int,
) -> list[tuple[int, int, int | None]]:
    """What is left of a line by the counts found along it, with ``room`` pairs that it lacks; the counts are used up."""
    rest = {m[:2] for m in line}
    others = counts.copy()  # of pairs that the line lacks
    found: list[tuple[int, tuple[int, int, int | None]]] = []
    if top and top not in rest:
        found.append((int(counts[top]), (*top, None)))
    known = [*rest, *([top] if top else [])]
    held = np.zeros(counts.shape, bool)
    held[tuple(np.array(known, "int64").reshape(-1, 2).T)] = True
    others[held] = 0
    for k in range(len(line)):
        n = int(counts[line[k][:2]])
        # A line settles ``room`` merges at most, so no more pairs are worth a place in it.
        while room and others.max() > n:
            pair = divmod(int(others.argmax()), counts.shape[1])
            found.append((int(others[pair]), (*pair, None)))
            held[pair], others[pair] = True, 0
            room -= 1
        found.append((n, tuple(line[k])))
        _carry_out(counts, line[k], moved[k])
        others = np.where(held, 0, counts)
    # A pair is at most as frequent as its tokens, which stand before it if equal.
    return [m for n, m in sorted(found, key=lambda f: -f[0]) if n > 0]


def _played(
    corpus: DataFrame, vocab_size: int, pending: Sequence[Merge], line: Sequence[Merge]
) -> tuple[np.ndarray, np.ndarray]:
    """Pair counts behind ``pending``, and for each merge of the line how often tokens stand beside it."""
    weight = F.col("weight") if "weight" in corpus.columns else F.lit(1)
    column = corpus_column(corpus)
    player = _player(vocab_size, pending, line, column)
    rows = corpus.select(F.col(column), weight.cast("long").alias("weight"))
    summed = rows.mapInArrow(player, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # as many as pairs of tokens and, beside the line, _CELLS
    cells, n = (found.column(k).to_numpy() for k in range(2))
    base = vocab_size + 1
    counts = np.zeros(base * base, "int64")
    moved = np.zeros(len(line) * 3 * base, "int64")
    counts[cells[cells >= 0]] = n[cells >= 0]
    moved[-1 - cells[cells < 0]] = n[cells < 0]
    counts = counts.reshape(base, base)[:vocab_size, :vocab_size].copy()
    return counts, moved.reshape(len(line), 3, base)


def _player(
    vocab_size: int, pending: Sequence[Merge], line: Sequence[Merge], column: str
) -> Callable:
    """Arrow batches of rows to partial counts of pairs, and of tokens beside the merges of the line."""
    base, steps = vocab_size + 1, len(line)
    pieces, read = slicer(), reader_of(column, vocab_size)
    settle, play = merger(pending, vocab_size), merger(line, vocab_size)

    def count(batches):
        totals = np.zeros(base * base, "int64")
        moved = np.zeros((steps, 3, base), "int64")
        for whole in batches:
            for rows in pieces(whole, whole.nbytes):
                tokens = settle(read(rows.column(0)))
                if len(tokens) < 2:
                    continue
                weights, spread = rows.column(1).to_numpy(), None
                if not (weights == 1).all():
                    lengths = np.diff(np.flatnonzero(tokens == vocab_size), prepend=-1)
                    spread = np.repeat(weights, lengths)
                pairs = tokens[:-1].astype("int64") * base + tokens[1:]
                n = np.bincount(pairs, None if spread is None else spread[:-1], base * base)
                totals += n.astype("int64")

                def beside(rank, at, *sides, spread=spread):
                    for k, (tokens_there, chosen) in enumerate(sides):
                        share = None if spread is None else spread[at if chosen is None else at[chosen]]
                        moved[rank, k] += np.bincount(tokens_there, share, base).astype("int64")

                play(tokens, beside)
        square = totals.reshape(base, base)
        square[vocab_size, :] = 0
        square[:, vocab_size] = 0
        changes = moved.ravel()
        pairs, cells = np.flatnonzero(totals), np.flatnonzero(changes)
        keys = np.append(pairs, -1 - cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.append(totals[pairs], changes[cells]))], ["cell", "n"]
        )

    return count
