"""Near-duplicate documents by b-bit MinHash, with links confirmed on full sets.

Documents with equal shingle sets become one *node*. Every node gets minima of
``HASHES`` hash functions over its set; the first of them make up bands, whose
buckets bring candidates together, and the low bits of all of them are packed
into a signature. A candidate pair is dropped if the number of differing low
bits, corrected for chance collisions, puts its similarity far below the
threshold; the others are confirmed on their full sets.

Only components are wanted, so not every pair in a bucket is listed. First all
nodes of a bucket are compared with two of them, and components grow. What is
then still apart from the largest component of a bucket is compared with the
whole bucket, by sizes and signatures and then on full sets, in blocks of bounded
size; only links found become rows. Buckets with a third of all rows are split
into such blocks, before that by Spark's skew joins, as every table that they are
joined with is written.

A link is lost only by chance: if its nodes share no bucket (at most 10^-6 for a
pair at the threshold), or if more low bits differ than five standard errors
allow (at most 10^-6 by the normal law), and no other path joins the two.

A null or empty text and one without words has an empty set: it is linked with
nothing. Rows that share an id are one document, linked with whatever any of its
texts is linked with. Rows with a null id are linked with nothing: their
component is null, and they are kept. An empty table gives none. Texts are read
whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, fresh, ship_package
from twintext.llm.components import components

HASHES = 128
BITS = 4  # of each minimum in the signature
ROWS = 3  # minima to a band
_MISS = 1e-6  # of a pair at the threshold: the chance to share no bucket
_SPREAD = 5  # standard errors below the threshold at which an estimate drops a pair
_SHINGLES = 100_000, 1_000_000  # on both sides of a block of comparisons
_NODES = 2_000, 10_000  # on both sides of a block of comparisons
_PAIRS = 1 << 20  # whose signatures are compared at once
_WORDS = HASHES * BITS // 64  # 64-bit words of a signature


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link is ``100 * shared >= percent * united``."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> int:
        meets = (self.percent / 100) ** ROWS
        return min(HASHES // ROWS, math.ceil(math.log(_MISS) / math.log(1 - meets)))

    @property
    def most_different(self) -> int:
        """Differing minima, by their low bits, up to which a pair stays a candidate."""
        chance = 0.5**BITS
        agree = chance + (1 - chance) * self.percent / 100
        error = math.sqrt(agree * (1 - agree) / HASHES)
        return math.ceil(HASHES * (1 - agree + _SPREAD * error))


def _prints(docs: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, n, f1, f2, bands, signature)`` per row; null for empty sets but ``n``."""
    words, bands = rule.words, rule.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import shingles

        factors = shingles.random_words(HASHES, 17)
        packing = (np.uint64(1) << (np.arange(64 // BITS, dtype="u8") * np.uint64(BITS))).reshape(1, 1, -1)

        def block(sets: list[np.ndarray]) -> tuple[np.ndarray, ...]:
            """Prints of some non-empty sets."""
            starts = np.cumsum([0, *map(len, sets[:-1])])
            values = np.concatenate(sets)
            minima = np.empty((len(sets), HASHES), "u8")
            for j, factor in enumerate(factors):
                minima[:, j] = np.minimum.reduceat(values * factor, starts)
            f1 = np.add.reduceat(shingles.mixed(values ^ factors[0]), starts)
            f2 = np.add.reduceat(shingles.mixed(values ^ factors[1]), starts)
            keys = np.zeros((len(sets), bands), "u8")
            for r in range(ROWS):
                keys = shingles.mixed(keys + minima[:, r : bands * ROWS : ROWS])
            keys = shingles.mixed(keys + np.arange(bands, dtype="u8"))
            low = (minima & np.uint64(2**BITS - 1)).reshape(len(sets), _WORDS, -1)
            return f1, f2, keys, (low * packing).sum(axis=2, dtype="u8")

        def emit(held: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
            return [block(held)] if held else []

        for batch in batches:
            texts = [v.as_py() or b"" for v in batch.column(1)]
            sizes, blocks, held, size = [], [], [], 0
            for found in shingles.sets_of(texts, words):
                sizes.append(len(found))
                if len(found):
                    held.append(found)
                    size += len(found)
                if size > 1 << 15:
                    blocks += emit(held)
                    held, size = [], 0
            blocks += emit(held)
            sizes = np.array(sizes, "i8")
            if not len(sizes):
                continue
            # Empty sets take no place in the blocks: -1 becomes null.
            place = np.where(sizes > 0, np.cumsum(sizes > 0) - 1, -1)
            index = pa.array(place, mask=place < 0)

            def column(k: int) -> pa.Array:
                if not blocks:
                    whole = np.zeros((0,) if k < 2 else (0, bands if k == 2 else _WORDS), "u8")
                else:
                    whole = np.concatenate([b[k] for b in blocks])
                flat = pa.array(whole.reshape(-1).view("i8"))
                if whole.ndim == 2:
                    ends = pa.array(np.arange(len(whole) + 1, dtype="i4") * whole.shape[1])
                    flat = pa.ListArray.from_arrays(ends, flat)
                return flat.take(index)

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), *map(column, range(4))],
                ["doc_id", "n", "f1", "f2", "bands", "signature"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, f1 long, f2 long, bands array<long>, signature array<long>"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``(node, n, signature, shingles)``: with the sorted set as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import shingles

        for batch in batches:
            texts = [v.as_py() or b"" for v in batch.column("text")]
            found = [s.tobytes() for s in shingles.sets_of(texts, words)]
            kept = [batch.column(c) for c in ("node", "n", "signature")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.binary())], ["node", "n", "signature", "shingles"]
            )

    kind = docs.schema["node"].dataType.simpleString()
    return docs.select("node", "n", "signature", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"node {kind}, n long, signature array<long>, shingles binary"
    )


def _confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough; ``pairs`` carries both as ``left`` and ``right``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                a, b = (np.frombuffer(x.as_buffer(), "u8") for x in (left, right))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                similar.append(100 * shared >= percent * (len(a) + len(b) - shared))
            kept = batch.filter(pa.array(similar, pa.bool_()))
            yield kept.select(["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "left", "right").mapInArrow(run, f"a {kind}, b {kind}")


def _different(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The numbers of differing minima, by their low bits, of each row of ``a`` and each of ``b``."""
    x = a[:, None, :] ^ b[None, :, :]
    half = BITS // 2
    while half:
        x |= x >> np.uint64(half)
        half //= 2
    lowest = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    return np.bitwise_count(x & lowest).sum(axis=2, dtype="i4")


def _links_in_block(apart: pa.Table, others: pa.Table, rule: Rule) -> pa.Table:
    """Links of nodes that are apart with nodes of other components, one per component."""
    found: list[tuple[int, int]] = []
    if len(apart) and len(others):
        sets, many = ([np.frombuffer(x.as_buffer(), "u8") for x in t["shingles"]] for t in (apart, others))
        sizes, many_sizes = np.array([*map(len, sets)]), np.array([*map(len, many)])
        signatures, many_signatures = (
            np.asarray(t["signature"].combine_chunks().flatten()).view("u8").reshape(-1, _WORDS) for t in (apart, others)
        )
        component, other_component = apart["component"].to_numpy(), others["component"].to_numpy()
        names, other_names = apart["node"].to_pylist(), others["node"].to_pylist()
        step = max(1, _PAIRS // len(others))
        for start in range(0, len(sets), step):
            rows = slice(start, start + step)
            least = np.minimum(sizes[rows, None], many_sizes)
            likely = 100 * least >= rule.percent * np.maximum(sizes[rows, None], many_sizes)
            likely &= component[rows, None] != other_component
            likely &= _different(signatures[rows], many_signatures) <= rule.most_different
            for i in np.flatnonzero(likely.any(axis=1)):
                own, linked = sets[start + i], set()
                with_it = np.flatnonzero(likely[i])
                united = np.concatenate([many[j] for j in with_it])
                at = np.minimum(np.searchsorted(own, united), len(own) - 1)
                starts = np.cumsum([0, *many_sizes[with_it][:-1]])
                shared = np.add.reduceat(own[at] == united, starts, dtype="i8")
                similar = 100 * shared >= rule.percent * (len(own) + many_sizes[with_it] - shared)
                for j in with_it[similar]:
                    if other_component[j] not in linked:
                        linked.add(other_component[j])
                        found.append((names[start + i], other_names[j]))
    kind = apart.schema.field("node").type
    return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})


class _Linker:
    """Grows components over the nodes that share buckets."""

    def __init__(self, scratch: Scratch, docs: DataFrame, nodes: DataFrame, rule: Rule):
        self._scratch, self._rule = scratch, rule
        entries = nodes.select("node", F.explode("bands").alias("bucket")).distinct()
        # Two nodes of each bucket: the least one, and one by a hash.
        by_hash = F.min(F.struct(F.xxhash64("node").alias("rank"), "node"))["node"]
        buckets = entries.groupBy("bucket").agg(
            F.min("node").alias("first"), F.max("node").alias("last"), by_hash.alias("second")
        )
        buckets = scratch.write(buckets.where("first < last").select("bucket", "first", "second"), "buckets")
        #: node, bucket and the bucket's two nodes, of shared buckets
        self._entries = scratch.write(entries.join(buckets, "bucket"), "entries")
        members = self._entries.select(F.col("node").alias("member")).distinct()
        chosen = scratch.write(
            nodes.join(members.hint("shuffle_hash"), F.col("node") == F.col("member"), "left_semi")
            .select("node", "n", "signature"),
            "members",
        )
        #: node, size, signature and set
        self._sets = scratch.write(
            _sets(docs.join(chosen.hint("shuffle_hash"), F.col("doc_id") == F.col("node")), rule.words), "sets"
        )

    def _plausible(self) -> Column:
        """By sizes and signatures, before any set is read."""
        least, most = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
        nibble = F.lit(0x1111111111111111)
        different = F.lit(0)
        for k in range(_WORDS):
            x = F.get("a_signature", F.lit(k)).bitwiseXOR(F.get("b_signature", F.lit(k)))
            x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
            x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
            different = different + F.bit_count(x.bitwiseAND(nibble))
        return (100 * least >= self._rule.percent * most) & (different <= self._rule.most_different)

    def _side(self, side: str, *columns: str) -> DataFrame:
        return self._sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])

    def with_two(self) -> DataFrame:
        """The links ``(a, b)`` of the nodes of each bucket with its two chosen nodes."""
        pairs = self._entries.select("node", F.explode(F.array("first", "second")).alias("other")).where("node <> other")
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        for side in ("a", "b"):
            pairs = pairs.join(self._side(side, "n", "signature"), side)
        wanted = self._scratch.write(pairs.where(self._plausible()).select("a", "b").distinct(), "pairs")
        with_sets = wanted.join(self._side("a", "shingles"), "a").join(self._side("b", "shingles"), "b")
        named = with_sets.withColumnsRenamed({"a_shingles": "left", "b_shingles": "right"})
        return self._scratch.write(_confirmed(named, self._rule.percent), "links")

    def in_blocks(self, merged: DataFrame) -> DataFrame:
        """The links left between components: what is apart in a bucket against all of it.

        ``merged`` holds ``(a, b)``: nodes and the least nodes of their components.
        """
        known = merged.select(F.col("a").alias("node"), F.col("b").alias("component"))
        facts = self._sets.select("node", "n").join(known, "node", "left")
        facts = facts.select("node", "n", F.coalesce("component", "node").alias("component")).distinct()
        rows = self._scratch.write(self._entries.select("bucket", "node").join(facts, "node"), "rows")
        sized = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
        whole = sized.groupBy("bucket").agg(
            F.sum("c").alias("nodes"),
            F.sum("n").alias("all"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.max(F.struct("n", "c", "component")).alias("main"),
        )

        def blocks(nodes: Column, shingles: Column, k: int) -> Column:
            return F.greatest(F.ceil(nodes / _NODES[k]), F.ceil(shingles / _SHINGLES[k])).cast("int")

        # Of two nodes the one has been compared with the other.
        opened = whole.where("least < most AND nodes > 2").select(
            "bucket",
            F.col("main.component").alias("main"),
            blocks(F.col("nodes") - F.col("main.c"), F.col("all") - F.col("main.n"), 0).alias("slots"),
            blocks(F.col("nodes"), F.col("all"), 1).alias("parts"),
        )
        placed = rows.join(self._scratch.write(opened, "blocks"), "bucket")
        every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("slots", "parts")]
        own = [F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("slots", "parts")]
        keys, columns = ["bucket", "slot", "part"], ["node", "component", "signature", "shingles"]
        apart = placed.where("component <> main").select(
            "bucket", own[0].alias("slot"), every[1].alias("part"), "node", "component"
        )
        others = placed.select("bucket", every[0].alias("slot"), own[1].alias("part"), "node", "component")
        rule = self._rule

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            from twintext.llm.near_dedup import _links_in_block

            return _links_in_block(left, right, rule)

        kind = rows.schema["node"].dataType.simpleString()
        # Aliases, as both sides stem from the same tables.
        named = [F.col(c).alias(c) for c in (*keys, *columns)]
        sides = [side.join(self._sets, "node").select(*named).groupBy(*keys) for side in (apart, others)]
        links = sides[0].cogroup(sides[1]).applyInArrow(run, f"a {kind}, b {kind}")
        return self._scratch.write(links, "links")


def near_duplicates(
    docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row per row of ``docs``.

    ``component_id`` is the least id that can be reached over links, itself
    included; the document with that id is kept.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "near-dedup")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = scratch.write(_prints(docs, rule), "prints")
    linked = prints.where("n > 0 AND doc_id IS NOT NULL")
    groups = linked.groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("bands", "signature")]
    )
    groups = scratch.write(groups, "groups")
    members = scratch.write(
        prints.join(groups.select("f1", "f2", "n", "node"), ["f1", "f2", "n"], "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("node"),
        ),
        "members",
    )
    # An id with several texts stands in several nodes: they are one document.
    several = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b < c")
    several = scratch.write(several.select("doc_id", "b"), "several")
    ties = members.join(several, "doc_id").select(F.col("node").alias("a"), "b")
    linker = _Linker(scratch, docs, groups, rule)
    merged = components(scratch, linker.with_two().unionByName(ties))
    merged = components(scratch, linker.in_blocks(merged).unionByName(merged))
    merged = merged.select(F.col("a").alias("node"), F.col("b").alias("least"))
    component = F.coalesce("least", "node")
    return members.join(merged, "node", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept documents with all their columns.

    Of rows with one text and one id, or a null id, one stays. Of rows with one
    id and different texts all stay that are linked with no other of them, and
    of linked ones the one with the smallest hash.
    """
    scratch = Scratch(docs.sparkSession, "one-of-each")
    key, number = fresh(docs, "key", "number")
    kept = near_duplicates(docs, rule, doc_id, text).where("kept AND doc_id IS NOT NULL")
    ids = kept.groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias(number))
    ids = scratch.write(ids, "ids")

    def named(chosen: Column) -> DataFrame:
        return docs.join(ids.where(chosen).hint("shuffle_hash"), docs[doc_id] == F.col(key), "left_semi")

    unnamed = docs.where(F.col(doc_id).isNull()).dropDuplicates([text])
    once = named(F.col(number) == 1).unionByName(unnamed)
    if ids.where(F.col(number) > 1).isEmpty():
        return once
    # Kept ids are not linked with each other, so what is linked here shares its id.
    texts = named(F.col(number) > 1).dropDuplicates([doc_id, text])
    texts = scratch.write(texts.withColumn(key, F.xxhash64(doc_id, text)), "texts")
    stay = near_duplicates(texts, rule, key, text).where("kept").select(F.col("doc_id").alias(number)).distinct()
    several = texts.join(stay.hint("shuffle_hash"), F.col(key) == F.col(number), "left_semi").drop(key)
    return once.unionByName(several)
