"""Near-duplicate documents by SimHash, compared through tables of distances to pivots.

Every document gets a 64-bit fingerprint of its shingles; two fingerprints that
differ in at most ``Rule.most`` bits are linked. A table holds the Hamming distances of
fingerprints to ``PIVOTS`` fixed reference fingerprints. By the triangle
inequality no coordinate of two rows differs by more than the distance of their
fingerprints, so pairs with a larger difference in any coordinate are
discarded, and only the survivors are verified bit by bit.

Which rows are held against each other follows from the same inequality. A
pivot and its neighbour, which differs from it in one bit, have distances that
differ by 1 or -1, and the sign tells that bit of the fingerprint. Over a block of bits
these signs are the block's content, so rows with different blocks differ in a
coordinate difference. With the bits in ``most + 2`` blocks, linked fingerprints
agree in two blocks or more: rows meet under each choice of two blocks whose
contents they share. A bucket of more than ``_CROWD`` fingerprints is dealt out
again, by ``most + 1`` blocks of the bits that may still differ in it, of which
one has to be equal; at last so few bits are left that their number bounds the
bucket (by ``_CROWD``, or by ``2 ** most`` where that is more). So no link is lost and no group is collected or compared with itself as
a whole; equal fingerprints are one row from the start.

A null or empty text and one without words has fingerprint 0, linked like any
other. Rows that share an id are one document, linked with whatever any of its
texts is linked with. Rows with a null id are linked with nothing: their
component is null. An empty table gives none. Texts are read whole, in pieces of
1 MB or one word. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, ship_package
from twintext.llm.components import components

SEED = 42  # of the shingles' hashes
PIVOTS = 64
_STEP = 16  # coordinates compared at once
_CROWD = 4_096  # fingerprints in a bucket that are compared with each other
_PIECE = 1 << 20  # bytes of a text, unless a single word is longer
_HASHED = 1 << 15  # shingles whose bits are counted at once
_GAP = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link has at most ``most`` differing bits."""

    words: int = 3
    most: int = 3


def _pieces(text: bytes) -> Iterator[bytes]:
    """Pieces of a text that end at white space."""
    start = 0
    while len(text) - start > _PIECE:
        gap = _GAP.search(text, start + _PIECE)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:]


def _shingles(text: bytes, k: int) -> Iterator[list[bytes]]:
    """The shingles of a text, piece by piece; of fewer words one, of none none."""
    before: list[bytes] = []
    found = False
    for piece in _pieces(text):
        # Of bytes, both calls know ASCII only.
        words = before + piece.lower().split()
        if len(words) >= k:
            found = True
            data = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = [0, *ends[: len(words) - k].tolist()]
            yield [data[s:e] for s, e in zip(starts, (ends[k - 1 :] - 1).tolist())]
            before = words[len(words) - k + 1 :] if k > 1 else []
        else:
            before = words
    if not found and before:
        yield [b" ".join(before)]


def fingerprints_of(texts: Sequence[bytes], k: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text: a bit is set if it is in over half the hashes."""
    from xxhash import xxh64_intdigest

    ones = np.zeros((len(texts), 64), "i8")
    many = np.zeros(len(texts), "i8")
    held: list[int] = []
    owners: list[int] = []
    starts: list[int] = []

    def count() -> None:
        if held:
            bits = np.unpackbits(np.array(held, "<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
            np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype="i8"))
            held.clear()
            owners.clear()
            starts.clear()

    for at, text in enumerate(texts):
        for shingles in _shingles(text, k):
            many[at] += len(shingles)
            for j in range(0, len(shingles), _HASHED):
                owners.append(at)
                starts.append(len(held))
                held.extend([xxh64_intdigest(s, SEED) for s in shingles[j : j + _HASHED]])
                if len(held) >= _HASHED:
                    count()
    count()
    set_bits = 2 * ones > many[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``: the fingerprint as a signed 64-bit integer."""
    ship_package(docs.sparkSession)
    k = rule.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm.simhash_dedup import fingerprints_of

        for batch in batches:
            found = fingerprints_of([v.as_py() or b"" for v in batch.column(1)], k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("i8"))], ["doc_id", "fingerprint"])

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, fingerprint long")


def pivot_table(values: np.ndarray) -> np.ndarray:
    """The distances of each fingerprint to all pivots."""
    from twintext.llm.shingles import mixed, random_words

    pivots = mixed(random_words(PIVOTS, 23))
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype("i1")


def linked_rows(buckets: np.ndarray, values: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of fingerprints in one bucket; equal buckets stand together."""
    table = pivot_table(values)
    past = np.searchsorted(buckets, buckets, "right")
    first = np.arange(len(values))
    apart = 0
    while len(first):
        apart += 1
        first = first[first + apart < past[first]]
        one = first
        for k in range(0, PIVOTS, _STEP):
            gap = np.abs(table[one, k : k + _STEP] - table[one + apart, k : k + _STEP])
            one = one[gap.max(axis=1, initial=0) <= most]
        a, b = values[one], values[one + apart]
        good = np.bitwise_count(a ^ b) <= most
        if good.any():
            yield a[good], b[good]


def _entries(rows: DataFrame, width: int, equal: int, most: int) -> tuple[DataFrame, int]:
    """``(bucket, rest, fingerprint)``: a row for each choice of ``equal`` of ``equal + most`` blocks.

    ``rest`` holds the bits, ``width`` at most, that may differ inside a former
    bucket; the new one leaves the chosen blocks out. Its greatest number of bits
    is returned, too. Buckets are hashes of the choice, the blocks' contents and
    the former bucket.
    """
    number = equal + most
    cuts = [width * k // number for k in range(number + 1)]
    sizes = [b - a for a, b in zip(cuts, cuts[1:])]
    blocks = [F.shiftrightunsigned("rest", a).bitwiseAND((1 << n) - 1) for a, n in zip(cuts, sizes)]
    made, left = [], 0
    for choice, picked in enumerate(combinations(range(number), equal)):
        bucket = F.xxhash64(F.lit(choice), "bucket", *[blocks[k] for k in picked])
        rest, place = F.lit(0).cast("long"), 0
        for k in set(range(number)) - set(picked):
            rest = rest.bitwiseOR(F.shiftleft(blocks[k], place))
            place += sizes[k]
        left = max(left, place)
        made.append(F.struct(bucket.alias("bucket"), rest.alias("rest")))
    return rows.select(F.inline(F.array(*made)), "fingerprint"), left


def _links_in_buckets(entries: DataFrame, most: int) -> DataFrame:
    """``(a, b)``: linked fingerprints of a bucket, a less than b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm.simhash_dedup import linked_rows

        def links(rows: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a, b in linked_rows(*rows, most):
                a, b = a.view("i8"), b.view("i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        held = np.zeros(0, "i8"), np.zeros(0, "u8")
        for batch in batches:
            buckets = np.concatenate([held[0], np.asarray(batch.column(0))])
            values = np.concatenate([held[1], np.asarray(batch.column(1)).view("u8")])
            # The last bucket may go on in the next batch.
            end = int(np.searchsorted(buckets, buckets[-1], "left")) if len(buckets) else 0
            yield from links((buckets[:end], values[:end]))
            held = buckets[end:], values[end:]
        yield from links(held)

    together = entries.repartition("bucket").sortWithinPartitions("bucket", "fingerprint")
    return together.mapInArrow(run, "a long, b long")


def links(scratch: Scratch, values: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(a, b)``: all links, a less than b, between the distinct fingerprints in ``values``."""
    ship_package(scratch.spark)
    rows = values.select(F.lit(0).cast("long").alias("bucket"), F.col("fingerprint").alias("rest"), "fingerprint")
    found, width = [], 64
    while True:
        entries, width = _entries(rows, width, 1 if found else 2, rule.most)
        sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = scratch.write(entries.join(scratch.write(sizes, "sizes"), "bucket"), "entries")
        last = 1 << width <= _CROWD or width <= rule.most
        few = shared if last else shared.where(F.col("size") <= _CROWD)
        found.append(scratch.write(_links_in_buckets(few.select("bucket", "fingerprint"), rule.most), "links"))
        rows = shared.where(F.col("size") > _CROWD)
        if last or rows.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return scratch.write(every.distinct(), "links")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``docs``.

    The fingerprint as 16 hexadecimal digits; ``component_id`` is the least id
    that can be reached over links, itself included.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(fingerprints(docs, rule, doc_id, text), "prints")
    named = prints.where("doc_id IS NOT NULL")
    groups = scratch.write(named.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "groups")
    # The texts of one id are one document: its fingerprints are linked.
    several = named.groupBy("doc_id").agg(F.min("fingerprint").alias("b"), F.max("fingerprint").alias("c"))
    several = scratch.write(several.where("b < c").select("doc_id", "b"), "several")
    same = named.join(several, "doc_id").select(F.col("fingerprint").alias("a"), "b")
    merged = scratch.write(components(scratch, links(scratch, groups, rule).unionByName(same)), "components")
    roots = merged.select(F.col("b").alias("fingerprint"), F.col("b").alias("root")).distinct()
    rooted = scratch.write(
        merged.select(F.col("a").alias("fingerprint"), F.col("b").alias("root")).unionByName(roots), "roots"
    )
    labels = rooted.join(groups, "fingerprint")
    least = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = scratch.write(rooted.join(least, "root").select("fingerprint", "component_id"), "linked")
    alone = F.coalesce("component_id", "least")
    labelled = scratch.write(
        groups.join(linked, "fingerprint", "left").select("fingerprint", alone.alias("component_id")), "labelled"
    )
    shown = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(labelled, "fingerprint", "left").select("doc_id", shown, component)
