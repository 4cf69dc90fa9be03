"""Blocks of token rows, and what their tasks tell about pairs.

A block holds the tokens of some whole rows, each closed by a mark, with the
place and weight of every row. Blocks are the unit an index of pairs points to.
The factories return closures for ``mapInArrow`` that need numpy and pyarrow only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

from twintext.functions.kernels import merger, pair_index, reader_of, slicer
from twintext.functions.tokens import Merge

BLOCK_SCHEMA = "cell int, block long, ids binary, ords binary, sides binary, weights binary"
CHANGE_SCHEMA = "kind int, pair long, n long, cell int, block long"
COUNT, POSTING = 0, 1  # kinds of rows of a change
DESCRIPTION_SCHEMA = "key long, n long, ord long, side int, pos int"
_JOINED = 1 << 18  # tokens that are merged in one array
_HELD = 1 << 22  # bytes of blocks that a task takes apart at a time, whatever the size of an Arrow batch
_MARK = -1  # closes a row in stored blocks, whatever the size of the vocabulary


def block_writer(
    column: str, vocab_size: int, block_tokens: int, n_cells: int, merges: Sequence[Merge] = ()
) -> Callable:
    """Rows ``(tokens, ord, side, weight, part)`` to blocks of about ``block_tokens`` tokens before ``merges``.

    Rows are never cut, so a longer one is a block of its own. A block's number
    is unique, as it begins with the number of the task's partition.
    """
    read, mark, pieces = reader_of(column, vocab_size), _MARK, slicer()

    def write(batches):
        made = 0
        for whole in (piece for batch in batches for piece in pieces(batch, batch.nbytes)):
            places = [whole.column(k).to_numpy() for k in (1, 2)]
            rows = whole.take(pa.array(np.lexsort(places[::-1])))
            if not len(rows):
                continue
            tokens = read(rows.column(0)).astype("int32")
            ends = np.flatnonzero(tokens == vocab_size) + 1
            tokens[ends - 1] = mark
            group = (ends - np.diff(ends, prepend=0)) // block_tokens
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(group)) + 1), len(rows))
            offsets = np.append(0, ends)
            ords, sides, weights, parts = (rows.column(k).to_numpy() for k in (1, 2, 3, 4))
            spans = list(zip(cuts[:-1], cuts[1:]))
            numbers = (int(parts[0]) << 32) + made + np.arange(len(spans))
            made += len(spans)
            columns = [
                pa.array(np.full(len(spans), parts[0] % n_cells, "int32")),
                pa.array(numbers.astype("int64")),
                pa.array([tokens[offsets[a] : offsets[b]].tobytes() for a, b in spans], pa.binary()),
                pa.array([ords[a:b].astype("int64").tobytes() for a, b in spans], pa.binary()),
                pa.array([sides[a:b].astype("int32").tobytes() for a, b in spans], pa.binary()),
                pa.array([weights[a:b].astype("int64").tobytes() for a, b in spans], pa.binary()),
            ]
            names = ["cell", "block", "ids", "ords", "sides", "weights"]
            yield pa.RecordBatch.from_arrays(columns, names)

    if not merges:
        return write
    carry_out = block_merger(vocab_size, merges)
    return lambda batches: carry_out(write(batches))


def joined_merger(vocab_size: int, merges: Sequence[Merge]) -> Callable:
    """Merges carried out in many blocks at once, as a merge costs a constant per array."""
    merge, limit = merger(merges, vocab_size), _JOINED

    def apart(blocks):
        """One array of several blocks, merged and cut where they met."""
        rows = np.cumsum([np.count_nonzero(b == vocab_size) for b in blocks])
        merged = merge(np.concatenate(blocks))
        ends = np.flatnonzero(merged == vocab_size) + 1
        return np.split(merged, ends[rows[:-1] - 1])

    def run(blocks):
        out, waiting, size = [], [], 0
        for block in blocks:
            waiting.append(block)
            size += len(block)
            if size >= limit:
                out += apart(waiting)
                waiting, size = [], 0
        return out + (apart(waiting) if waiting else [])

    return run


def block_reader(vocab_size: int, pending: Sequence[Merge]) -> Callable:
    """Stored ids to the present tokens of each block; rows end with ``vocab_size``."""
    merge, mark = joined_merger(vocab_size, pending), _MARK

    def read(column):
        stored = (np.frombuffer(ids.as_py(), "int32") for ids in column)
        return merge([np.where(t == mark, vocab_size, t).astype("int32") for t in stored])

    return read


def block_merger(vocab_size: int, pending: Sequence[Merge]) -> Callable:
    """Blocks to blocks with the merges carried out."""
    read, mark, pieces = block_reader(vocab_size, pending), _MARK, slicer(_HELD)

    def run(batches):
        for batch in (piece for whole in batches for piece in pieces(whole, whole.nbytes)):
            blocks = []
            for tokens in read(batch.column(2)):
                blocks.append(np.where(tokens == vocab_size, mark, tokens).astype("int32").tobytes())
            columns = [batch.column(k) for k in range(batch.num_columns)]
            columns[2] = pa.array(blocks, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def _counter(vocab_size: int) -> Callable:
    """Tokens of a block and weights of its rows to distinct pair keys and their counts."""
    base = vocab_size + 1

    def count(tokens, weights):
        tokens = tokens.astype("int64")
        inside = np.flatnonzero((tokens[:-1] != vocab_size) & (tokens[1:] != vocab_size))
        pairs = tokens[inside] * base + tokens[inside + 1]
        if (weights == 1).all():
            return np.unique(pairs, return_counts=True)
        keys, group = np.unique(pairs, return_inverse=True)
        spread = np.repeat(weights, np.diff(np.flatnonzero(tokens == vocab_size), prepend=-1))
        # Weights are integers, summed as such.
        sums = np.zeros(len(keys), "int64")
        np.add.at(sums, group, spread[inside])
        return keys, sums

    return count


def change_counter(
    vocab_size: int, pending: Sequence[Merge], batch: Sequence[Merge] | None
) -> Callable:
    """Blocks to what ``batch`` changes in them: signed counts, and postings of new pairs.

    A pair can only come into being together with its younger token, so a
    posting is written once, in the pass that makes this token. Without a batch
    everything is new: all counts and postings of the blocks as they are.
    """
    read, count = block_reader(vocab_size, pending), _counter(vocab_size)
    merge = joined_merger(vocab_size, batch or ())
    pieces, whole, base = slicer(_HELD), batch is None, vocab_size + 1
    youngest = 0 if whole else min((m.token for m in batch), default=vocab_size)
    signed, posting = COUNT, POSTING

    def rows(kind, pairs, n, cells, blocks):
        size = len(pairs)
        none = pa.nulls(size, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, kind, "int32")),
                pa.array(pairs),
                pa.array(n) if n is not None else none,
                pa.array(cells) if cells is not None else pa.nulls(size, pa.int32()),
                pa.array(blocks) if blocks is not None else none,
            ],
            ["kind", "pair", "n", "cell", "block"],
        )

    def run(batches):
        for stored in (piece for held in batches for piece in pieces(held, held.nbytes)):
            keys, sums, new, cells, blocks = [], [], [], [], []
            present = read(stored.column(2))
            merged = present if whole else merge(present)
            for k, (before, after) in enumerate(zip(present, merged)):
                weights = np.frombuffer(stored.column(5)[k].as_py(), "int64")
                if not whole:
                    if len(after) == len(before):
                        continue
                    had, n = count(before, weights)
                    keys.append(had)
                    sums.append(-n)
                has, n = count(after, weights)
                keys.append(has)
                sums.append(n)
                fresh = has[np.maximum(has // base, has % base) >= youngest]
                new.append(fresh)
                cells.append(np.full(len(fresh), stored.column(0)[k].as_py(), "int32"))
                blocks.append(np.full(len(fresh), stored.column(1)[k].as_py(), "int64"))
            if not keys:
                continue
            pairs, group = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(pairs), "int64")
            np.add.at(total, group, np.concatenate(sums))
            changed = total != 0
            yield rows(signed, pairs[changed], total[changed], None, None)
            yield rows(posting, np.concatenate(new), None, np.concatenate(cells), np.concatenate(blocks))

    return run


def pair_describer(
    vocab_size: int, pending: Sequence[Merge], watched: Sequence[tuple[int, int]]
) -> Callable:
    """Blocks to first places and overlaps of ``watched`` pairs.

    A key ``i`` stands for the first place of the i-th pair in the block, a key
    ``-1 - (i * len(watched) + j)`` for the number of places where the j-th
    starts at the second token of the i-th.
    """
    read, pieces, base = block_reader(vocab_size, pending), slicer(_HELD), vocab_size + 1
    size, watch_of = len(watched), pair_index(watched, vocab_size)

    def run(batches):
        for stored in (piece for held in batches for piece in pieces(held, held.nbytes)):
            out = [[] for _ in range(5)]
            for k, block in enumerate(read(stored.column(2))):
                tokens = block.astype("int64")
                ords, sides, weights = (
                    np.frombuffer(stored.column(c)[k].as_py(), t)
                    for c, t in ((3, "int64"), (4, "int32"), (5, "int64"))
                )
                watch = watch_of(tokens[:-1] * base + tokens[1:])
                at = np.flatnonzero(watch < size)
                if not len(at):
                    continue
                ends = np.flatnonzero(tokens == vocab_size)
                starts = np.append(0, ends[:-1] + 1)
                # Rows of a block are in order of their places.
                found, first = np.unique(watch[at], return_index=True)
                row = np.searchsorted(ends, at[first])
                for column, values in zip(
                    out, (found, np.zeros(len(found)), ords[row], sides[row], at[first] - starts[row])
                ):
                    column.append(values.astype("int64"))
                both = at[:-1][(np.diff(at) == 1)]
                if len(both):
                    cells, group = np.unique(
                        watch[both].astype("int64") * size + watch[both + 1], return_inverse=True
                    )
                    n = np.zeros(len(cells), "int64")
                    np.add.at(n, group, weights[np.searchsorted(ends, both)])
                    for column, values in zip(out, (-1 - cells, n, *[np.zeros(len(cells), "int64")] * 3)):
                        column.append(values)
            if out[0]:
                columns = [np.concatenate(c) for c in out]
                types = ("int64", "int64", "int64", "int32", "int32")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(t)) for c, t in zip(columns, types)],
                    ["key", "n", "ord", "side", "pos"],
                )

    return run


def place_finder(vocab_size: int, pending: Sequence[Merge]) -> Callable:
    """Blocks to the first place ``(key, n, ord, side, pos)`` of every pair in them."""
    read, pieces, base = block_reader(vocab_size, pending), slicer(_HELD), vocab_size + 1

    def run(batches):
        for stored in (piece for held in batches for piece in pieces(held, held.nbytes)):
            for k, block in enumerate(read(stored.column(2))):
                tokens = block.astype("int64")
                inside = np.flatnonzero((tokens[:-1] != vocab_size) & (tokens[1:] != vocab_size))
                pairs, first = np.unique(tokens[inside] * base + tokens[inside + 1], return_index=True)
                ends = np.flatnonzero(tokens == vocab_size)
                row = np.searchsorted(ends, inside[first])
                ords = np.frombuffer(stored.column(3)[k].as_py(), "int64")[row]
                sides = np.frombuffer(stored.column(4)[k].as_py(), "int32")[row]
                places = inside[first] - np.append(0, ends[:-1] + 1)[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pairs),
                        pa.array(np.zeros(len(pairs), "int64")),
                        pa.array(ords),
                        pa.array(sides),
                        pa.array(places.astype("int32")),
                    ],
                    ["key", "n", "ord", "side", "pos"],
                )

    return run
