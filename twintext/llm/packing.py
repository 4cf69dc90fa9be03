"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Bulk-synchronous best-fit. Documents are ranged by length, gaps by size. A
superstep takes all documents of one length, longest first, and sweeps the gaps
upwards from that length: the document of rank *r* goes to the *r*-th place that
the smallest fitting gaps offer, so equal wishes are settled by rank alone;
places beyond all gaps are new sequences. Then the gaps are updated and the next
length follows. The outcome is that of best-fit decreasing, one document after
the other.

Sequences in the same state form runs, and documents of one length differ by
their rank only. A sweep therefore works on counts: at most ``capacity`` lengths
and a few runs for each, however many documents there are. The documents stay on
the executors; each works out its sequence and offset from its length, its rank
and the moves. Ranks are counted in salted groups, as a third of all documents
may have one length.

A null or empty text is a document of the end token alone. Only documents longer
than ``capacity`` are cut. Repeated rows and null ids are packed like any other
row. An empty table gives none. Texts are tokenized whole.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twintext.llm.bpe_automaton import printable_bytes
from twintext.llm.common import Scratch, ship_package
from twintext.llm.pretokens import PLAIN, PLAIN_LETTERS, PLAIN_NUMBERS, WordTable

CAPACITY = 4096
END_ID = 1
_GROUP = 50_000  # documents that are ranked together
_SMALL_PLAN = 200_000  # moves (40 bytes each) that may be sent to every executor


#: The split pattern of the vocabulary file, for lower-case Latin text.
_PARTS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{PLAIN_LETTERS}]+|[{PLAIN_NUMBERS}]|[^ \n{PLAIN_LETTERS}{PLAIN_NUMBERS}]+"
)


@lru_cache
def _encoder(path: str) -> Callable[[str], bytes]:
    """A text's ids, as little-endian 32-bit integers.

    Latin texts are composed already, and their lower case depends on single
    characters only. They are put in lower case and split here, and only their
    distinct parts go to the library's merges: its steps for whole texts cost
    more than the merges. Other texts take the library's whole way, word by word; a word
    ends at a space or line break, which this vocabulary drops.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    encode, merge = tokenizer.encode, tokenizer.model.tokenize
    split, plain = re.compile(_PARTS).findall, re.compile(PLAIN).fullmatch
    shown = str.maketrans({b: c for c, b in printable_bytes().items()})
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def part_ids(part: str) -> bytes:
        coded = part if part.isascii() else part.encode().decode("latin-1").translate(shown)
        return packed([t.id for t in merge(coded)])

    of_part = WordTable(part_ids).__getitem__
    of_word = WordTable(
        lambda word: packed(encode(word, add_special_tokens=False).ids), limit=300_000
    ).__getitem__

    def ids(text: str) -> bytes:
        if plain(text) and not any(s in text for s in specials):
            return b"".join(map(of_part, split(text.lower())))
        return b"".join(map(of_word, text.replace("\n", " ").split(" ")))

    return ids


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the documents' tokens, cut where longer than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers. Only documents whose
    length is more than ``capacity`` have more than one piece.
    """
    ship_package(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _encoder(path)
        for batch in batches:
            row, piece, pieces = [], [], []
            for k, value in enumerate(batch.column(1)):
                ids = ids_of(value.as_py() or "") + end
                cuts = range(0, len(ids), step)
                row += [k] * len(cuts)
                piece += range(len(cuts))
                pieces += [ids[c : c + step] for c in cuts]
            place = np.array(piece, "i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(place),
                    pa.array(place.astype("i8") * capacity),
                    pa.array([len(p) // 4 for p in pieces], pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


class Move(NamedTuple):
    """Documents of one length and consecutive ranks, put into consecutive sequences."""

    length: int
    rank: int  # of the first
    count: int
    sequence: int  # of the first
    each: int  # documents a sequence takes
    offset: int  # of the first in its sequence


class Sweep:
    """The gaps, as runs of sequences in one state, and the moves made so far."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.moves: list[Move] = []
        self._sizes: list[int] = []  # of gaps, in order
        self._runs: dict[int, list[tuple[int, int]]] = {}  # gap to (first sequence, count)

    def _add(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self._runs:
                self._runs[gap] = []
                insort(self._sizes, gap)
            self._runs[gap].append((first, count))

    def _smallest(self, length: int) -> tuple[int, int, int] | None:
        """Take the first run among the smallest gaps of ``length`` or more."""
        at = bisect_left(self._sizes, length)
        if at == len(self._sizes):
            return None
        gap = self._sizes[at]
        first, count = self._runs[gap].pop()
        if not self._runs[gap]:
            del self._runs[gap], self._sizes[at]
        return gap, first, count

    def place(self, length: int, count: int) -> None:
        """One superstep: all documents of one length."""
        rank = 0
        while rank < count:
            found = self._smallest(length)
            if found is None:  # new sequences
                each = self.capacity // length
                opened = -(-(count - rank) // each)
                found = self.capacity, self.sequences, opened
                self.sequences += opened
            gap, first, run = found
            each = gap // length
            taken = min(count - rank, each * run)
            self.moves.append(Move(length, rank, taken, first, each, self.capacity - gap))
            full, rest = divmod(taken, each)
            used = full + (rest > 0)
            self._add(gap - each * length, first, full)
            self._add(gap - rest * length, first + full, int(rest > 0))
            self._add(gap, first + used, run - used)
            rank += taken


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Sweep:
    """All supersteps over the number of documents of each length."""
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    sweep = Sweep(capacity)
    for length in sorted(counts, reverse=True):
        sweep.place(length, counts[length])
    return sweep


def _ranked(rows: DataFrame, length: str, n: int) -> DataFrame:
    """Add ``__rank`` among the rows of equal ``length``: 0, 1, 2, ..."""
    salts = max(1, -(-n // _GROUP))
    group = [length, "__salt"]
    salted = rows.withColumn("__key", F.xxhash64(*rows.columns)).withColumn(
        "__salt", F.pmod("__key", F.lit(salts)).cast("int")
    )
    # Ties are equal rows, so whichever comes first the result is the same.
    inside = F.row_number().over(Window.partitionBy(*group).orderBy("__key", *rows.columns))
    sizes = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(length).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*group, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return (
        salted.withColumn("__row", inside)
        .join(shifts, group)
        .select(*rows.columns, (F.col("__before") + F.col("__row") - 1).alias("__rank"))
    )


def best_fit(rows: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of 1 to ``capacity`` tokens.

    The offsets of a sequence are gapless from 0. Columns that already have
    these names are replaced.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "packing")
    stored = scratch.write(rows.drop("sequence_id", "offset"), "pieces")
    # At most ``capacity`` counts, whatever the number of rows.
    counts = {r[0]: r[1] for r in stored.groupBy(length).count().collect()}
    moves = plan(counts, capacity).moves
    names = ["__length", "__first", "__count", "__sequence", "__each", "__offset"]
    table = spark.createDataFrame([tuple(m) for m in moves], ", ".join(f"{n} long" for n in names))
    if len(moves) <= _SMALL_PLAN:
        table = F.broadcast(table)
    ranked = _ranked(stored, length, sum(counts.values()))
    nth = F.col("__rank") - F.col("__first")
    matched = ranked.join(
        table, (F.col("__length") == F.col(length)) & (nth >= 0) & (nth < F.col("__count"))
    )
    sequence = F.col("__sequence") + F.call_function("div", nth, F.col("__each"))
    offset = F.col("__offset") + (nth % F.col("__each")) * F.col("__length")
    return matched.select(
        *stored.columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed tokens, one row of at most the capacity per sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def packed_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Where each piece of each document lies, with a checksum of its ids."""
    pieces = token_pieces(docs, path, capacity)
    checked = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return best_fit(checked, "length", capacity)
