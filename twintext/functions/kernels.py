"""Array helpers that run inside Arrow tasks.

Each factory returns a closure without references to this package, so tasks
need nothing but numpy and pyarrow on the executors. A batch of rows is handled
as one long integer array in which every row ends with a separator, whose id is
one past the last token (``vocab_size``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.compute as pc

DENSE_LIMIT = 2048  # up to here a square table over token pairs fits a task
_PIECE_BYTES = 1 << 20  # rows are handled in pieces of about this size


def slicer(limit: int = _PIECE_BYTES) -> Callable:
    """Cut a column (or batch) into zero-copy pieces of bounded size."""

    def pieces(rows, nbytes):
        step = max(1, len(rows) * limit // max(nbytes, 1))
        for start in range(0, len(rows), step):
            yield rows.slice(start, step)

    return pieces


def text_reader(vocab_size: int) -> Callable:
    """Text column to byte tokens."""

    def read(column):
        wide = "<i8" if "large" in str(column.type) else "<i4"
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
        lengths = np.diff(ends)
        size = int(lengths.sum())
        tokens = np.full(size + len(column), vocab_size, "int32")
        if size:
            place = np.arange(size) + np.repeat(np.arange(len(column)), lengths)
            tokens[place] = np.frombuffer(data, "u1")[ends[0] : ends[-1]]
        return tokens

    return read


ID_BYTES = 4  # of a token in a column of ids


def id_reader(vocab_size: int) -> Callable:
    """Binary column of little-endian token ids to tokens."""
    width = ID_BYTES

    def read(column):
        wide = "<i8" if "large" in str(column.type) else "<i4"
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
        lengths = np.diff(ends) // width
        size = int(lengths.sum())
        tokens = np.full(size + len(column), vocab_size, "int32")
        if size:
            place = np.arange(size) + np.repeat(np.arange(len(column)), lengths)
            tokens[place] = np.frombuffer(memoryview(data)[ends[0] : ends[-1]], "<i4")
        return tokens

    return read


def id_writer(vocab_size: int) -> Callable:
    """Tokens to a binary column of little-endian ids."""
    width = ID_BYTES

    def write(tokens):
        closing = tokens == vocab_size
        ends = (np.flatnonzero(closing) - np.arange(int(closing.sum()))) * width
        offsets = np.append(0, ends).astype("<i4")
        data = tokens[~closing].astype("<i4").tobytes()
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
        )

    return write


def reader_of(column: str, vocab_size: int) -> Callable:
    """The reader for a corpus column: ``text``, token string ``seq`` or binary ``ids``."""
    return {"text": text_reader, "seq": sequence_reader, "ids": id_reader}[column](vocab_size)


def sequence_reader(vocab_size: int) -> Callable:
    """Column of token strings to tokens."""
    surrogates = vocab_size >= 0xD800

    def read(column):
        # The separator is put into the text, as characters differ in width.
        mark = chr(vocab_size + 0x800 if surrogates else vocab_size)
        closed = pc.binary_join_element_wise(column, "", mark)
        wide = "<i8" if "large" in str(closed.type) else "<i4"
        _, offsets, data = closed.buffers()
        ends = np.frombuffer(offsets, wide)[closed.offset : closed.offset + len(closed) + 1]
        text = memoryview(data)[ends[0] : ends[-1]].tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), "<i4")
        return np.where(points >= 0xE000, points - 0x800, points) if surrogates else points.copy()

    return read


def sequence_writer(vocab_size: int) -> Callable:
    """Tokens back to a column of token strings."""
    surrogates = vocab_size >= 0xD800

    def write(tokens):
        points = np.where(tokens >= 0xD800, tokens + 0x800, tokens) if surrogates else tokens
        text = points.astype("<i4").tobytes().decode("utf-32-le")
        mark = chr(vocab_size + 0x800 if surrogates else vocab_size)
        return pa.array(text.split(mark)[:-1], pa.string())

    return write


def pair_index(pairs: Sequence[tuple[int, int]], vocab_size: int) -> Callable:
    """Map pair keys to the position in ``pairs``, or to its length if absent."""
    base, never = vocab_size + 1, len(pairs)
    dense = vocab_size <= DENSE_LIMIT
    keys = np.array([left * base + right for left, right in pairs], "int64")
    built = []  # in the task, as a table over all pairs is not worth shipping

    def find(wanted):
        if not built:
            if dense:
                table = np.full(base * base, never, "int32")
                table[keys] = np.arange(never)
                built.append(table)
            else:
                by_key = np.argsort(keys)
                built.extend((by_key, keys[by_key]))
        if dense:
            return built[0][wanted]
        by_key, sorted_keys = built
        at = np.minimum(np.searchsorted(sorted_keys, wanted), never - 1)
        return np.where(sorted_keys[at] == wanted, by_key[at], never)

    return find


def merger(merges: Sequence[tuple[int, int, int]], vocab_size: int) -> Callable:
    """Apply merges, in id order, to all rows of an array at once.

    The array is treated as a linked list. Places are filed under the merge
    they are due for; carrying out a merge touches its own places only and
    files the new neighbours under later merges. The work is thus one lookup
    per token and a constant per merge carried out, whatever the number of
    merges in the vocabulary.

    ``beside`` is told of each merge carried out: its rank, its places, and the
    tokens before them, those before them once merged, and those behind them, the
    last without places that another one follows (the mask says which are left).
    """
    base = vocab_size + 1
    ordered = sorted((tuple(m) for m in merges), key=lambda m: m[2])
    dense = vocab_size <= DENSE_LIMIT
    rank_of = pair_index([m[:2] for m in ordered], vocab_size)

    def merge(tokens, beside=None):
        size, never = len(tokens), len(ordered)
        if not never or size < 3:
            return tokens
        # Pieces are small, so places always fit 32 bits; pair keys do if dense.
        token = tokens.astype("int32" if dense else "int64")
        following = np.arange(1, size + 1, dtype="int32")
        previous = np.arange(-1, size - 1, dtype="int32")
        due = [[] for _ in range(never)]

        def file(places, ranks):
            known = ranks < never
            places, ranks = places[known], ranks[known]
            if not len(places):
                return
            # Sixteen bits are sorted by radix, in linear time.
            small = ranks.astype("int16") if never < 2**15 else ranks
            by_rank = np.argsort(small, kind="stable")
            places, ranks = places[by_rank], ranks[by_rank]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, group in zip(ranks[np.append(0, cuts)], np.split(places, cuts)):
                due[rank].append(group)

        ranks = rank_of(token[:-1] * base + token[1:])
        known = np.flatnonzero(ranks < never).astype("int32")
        file(known, ranks[known])
        for rank, (left, right, merged) in enumerate(ordered):
            if not due[rank]:
                continue
            at = due[rank][0] if len(due[rank]) == 1 else np.unique(np.concatenate(due[rank]))
            due[rank] = []
            at = at[token[at] == left]
            at = at[token[following[at]] == right]
            if left == right and len(at) > 1:
                # In a run of equal tokens every second place starts a merge.
                chained = np.append(False, at[1:] == following[at[:-1]])
                index = np.arange(len(at))
                start = np.maximum.accumulate(np.where(chained, 0, index))
                at = at[(index - start) % 2 == 0]
            if not len(at):
                continue
            gone = following[at]
            after = following[gone]
            if beside:
                # In front of the first token is -1: the last one, which closes a row.
                led = token[previous[at]]
                apart = np.append(after[:-1] != at[1:], True)
                follow = token[after[apart]]
            token[at] = merged
            token[gone] = -1
            following[at] = after
            previous[after] = at
            if beside:
                beside(rank, at, (led, None), (token[previous[at]], None), (follow, apart))
            before = previous[at]
            behind = at[before >= 0]
            before = before[before >= 0]
            file(before, rank_of(token[before] * base + token[behind]))
            file(at, rank_of(token[at] * base + token[after]))
        return token[token >= 0].astype("int32")

    return merge


def gatherer(table: Mapping[int, bytes], what: str) -> Callable:
    """Lists of ids to the joined bytes behind them, as binary.

    The bytes of all ids lie in one table with offsets, so an id costs the same
    whatever the size of the vocabulary. An id without bytes is an error.
    """
    size = max(table, default=-1) + 1
    lengths = np.array([len(table.get(i, b"")) for i in range(size)], "int64")
    starts = np.cumsum(lengths) - lengths
    known = np.array([i in table for i in range(size)], "bool")
    data = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), "uint8")
    pieces = slicer()

    def gather(lists):
        ids = lists.flatten()
        if ids.null_count:
            raise ValueError(f"{what} not in vocabulary: null")
        ids = ids.to_numpy()
        inside = (ids >= 0) & (ids < size)
        if not inside.all() or not known[ids].all():
            unknown = ids[~inside] if not inside.all() else ids[~known[ids]]
            raise ValueError(f"{what} not in vocabulary: {unknown[0]}")
        taken = lengths[ids]
        ends = np.append(0, np.cumsum(taken))
        # Where each byte comes from: the start of its id, and on from there.
        found = data[np.arange(ends[-1]) + np.repeat(starts[ids] - ends[:-1], taken)]
        counts = lists.value_lengths().fill_null(0).to_numpy()
        offsets = ends[np.append(0, np.cumsum(counts))].astype("int32")
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(found)]
        whole = pa.Array.from_buffers(pa.binary(), len(lists), buffers)
        return pc.if_else(lists.is_null(), None, whole) if lists.null_count else whole

    def run(lists):
        parts = [gather(p) for p in pieces(lists, lists.nbytes)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return run


def character_indexer(index_of: Mapping[int, int], unknown: int, page_bits: int = 8) -> Callable:
    """Strings to lists with an index for every character, looked up by code point.

    The table has pages, of which only those with a known code point exist,
    behind one for all others, so it does not grow with the code points' range.
    """
    page = 1 << page_bits
    numbers = sorted({p >> page_bits for p in index_of})
    place = {number: k for k, number in enumerate(numbers, 1)}
    last = max(numbers, default=-1) + 1  # a page number that has no page
    starts = np.array([place.get(n, 0) * page for n in range(last + 1)], "int64")
    cells = [index_of.get(n * page + k, unknown) for n in numbers for k in range(page)]
    cells = np.array([unknown] * page + cells, "int32")
    pieces = slicer()

    def points_of(texts):
        """Code points of all texts, and the number of each; malformed bytes become marks."""
        wide = "<i8" if "large" in str(texts.type) else "<i4"
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, "uint8")[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, "uint8")
        try:
            joined = raw.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            each = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets - offsets[0], offsets[1:] - offsets[0])]
            return np.frombuffer("".join(each).encode("utf-32-le"), "uint32"), np.array([*map(len, each)])
        leading = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        counts = np.diff(leading[offsets - offsets[0]])
        return np.frombuffer(joined.encode("utf-32-le"), "uint32"), counts

    def index(texts):
        points, counts = points_of(texts)
        ids = cells[starts[np.minimum(points >> page_bits, last)] + (points & (page - 1))]
        offsets = pa.array(np.append(0, np.cumsum(counts)).astype("int32"))
        return pa.ListArray.from_arrays(offsets, pa.array(ids), mask=texts.is_null() if texts.null_count else None)

    def run(texts):
        parts = [index(p) for p in pieces(texts, texts.nbytes)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run
