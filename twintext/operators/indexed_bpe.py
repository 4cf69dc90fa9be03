"""Training large vocabularies over an index from pairs to blocks of rows.

:func:`~twintext.operators.bpe.train_bpe` counts all pairs of the corpus in every
pass, which is right while the pairs worth merging are found everywhere. Later
merges are found in few places. Here each pass reads only the blocks that hold
a pair it asks about:

1. The leading pairs come from a log of signed counts.
2. The index names the blocks that hold them; these tell where the pairs are
   met first and how often they overlap, which settles a batch of merges.
3. The blocks that hold a merged pair are read again; each adds to the log what
   the batch takes away and brings, and to the index the pairs it gains.

A pair comes into being only together with its younger token, so its postings
lie in the directory of the pass that made this token, and a look-up reads the
directories of the pairs it asks for. Postings of pairs that have vanished from
a block stay; they cost a look at the block and change nothing.

A row of the corpus is handled whole. The log holds one row per distinct pair
after each compaction; the index one row per pair and block.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twintext.functions.tokens import Merge
from twintext.operators.bpe import train_bpe
from twintext.operators.corpus import collapse_equal
from twintext.operators.merge_order import PairCount, certain_merges
from twintext.operators.pair_blocks import (
    BLOCK_SCHEMA,
    CHANGE_SCHEMA,
    COUNT,
    DESCRIPTION_SCHEMA,
    POSTING,
    block_merger,
    block_writer,
    change_counter,
    pair_describer,
    place_finder,
)
from twintext.operators.pair_counts import corpus_column
from twintext.params import BYTE_TOKENS
from twintext.sources.storage import Snapshots, delete_path, join_path, shared_directory

BLOCK_TOKENS = 1 << 14
SCANNED_SIZE = 512  # tokens learned before the index is built
_WATCHED = 60  # leading pairs a pass looks at, one bit each of a long
_CELLS = 4096  # directories of blocks
_LISTED = 200_000  # blocks (20 bytes each) that a look-up names; beyond it all are read
_LOG = 16  # changes that are added up on reading before the log is compacted
_REWRITE_SHARE = 0.2
_READ = 128  # blocks decoded at a time
_HANDED = 1 << 23  # bytes of blocks handed to a Python worker at a time


class PassReads(NamedTuple):
    """What one pass merged and read."""

    merges: int
    blocks_described: int
    blocks_changed: int
    blocks: int  # that there are


def _own_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` that reads and hands on a few blocks at a time, as each is large."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.parquet.columnarReaderBatchSize", _READ)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _HANDED)
    return own


class PairIndex:
    """Blocks, signed counts and postings of a corpus under training, in the shared folder."""

    def __init__(
        self,
        corpus: DataFrame,
        vocab_size: int,
        block_tokens: int,
        rewrite_share: float,
        merges: Sequence[Merge] = (),
    ):
        self.spark = _own_session(corpus.sparkSession)
        self.vocab_size = vocab_size
        self._base = join_path(shared_directory(self.spark), f"pair-index-{uuid.uuid4().hex}")
        self._snapshots = Snapshots(self.spark)
        self._rewrite_share = rewrite_share
        self._pending: list[Merge] = []
        self._compacted: str | None = None
        self._log: list[str] = []  # changes since the last compaction
        self._passes: list[str] = []
        self._made_in = [0] * (BYTE_TOKENS + len(merges))  # the pass that made a token
        weight = F.col("weight") if "weight" in corpus.columns else F.lit(1)
        column = corpus_column(corpus)
        rows = corpus.where(F.col(column).isNotNull()).select(
            column,
            F.col("ord").cast("long").alias("ord"),
            F.col("side").cast("int").alias("side"),
            weight.cast("long").alias("weight"),
            F.spark_partition_id().alias("part"),
        )
        write = block_writer(column, vocab_size, block_tokens, _CELLS, merges)
        self._store(rows.mapInArrow(write, BLOCK_SCHEMA))
        self.n_blocks = self._change(None, None)
        self._stored_pairs: int | None = None

    def close(self) -> None:
        self._snapshots.close()
        if self._passes:
            delete_path(self.spark, self._base)

    def _store(self, blocks: DataFrame) -> None:
        self._blocks = self._snapshots.write(blocks, "cell").select("cell", "block", "ids", "ords", "sides", "weights")

    def _of(self, listed: Sequence[tuple[int, int]] | None) -> DataFrame:
        """The listed blocks, or all; at most ``_LISTED`` are sent along."""
        if listed is None or len(listed) == self.n_blocks:
            return self._blocks
        chosen = self.spark.createDataFrame(list(listed), "cell int, block long")
        cells = sorted({cell for cell, _ in listed})
        inside = self._blocks.where(F.col("cell").isin(cells))
        return inside.join(F.broadcast(chosen), ["cell", "block"], "left_semi").select(*self._blocks.columns)

    def _change(self, listed: Sequence[tuple[int, int]] | None, batch: Sequence[Merge] | None) -> int:
        """Write what ``batch`` changes; the number of blocks read."""
        seen = Observation()
        path = join_path(self._base, f"pass={len(self._passes)}")
        change = change_counter(self.vocab_size, self._pending, batch)
        read = self._of(listed).observe(seen, F.count(F.lit(1)).alias("n"))
        changed = read.mapInArrow(change, CHANGE_SCHEMA)
        changed.sortWithinPartitions("kind", "pair").write.partitionBy("kind").parquet(path)
        self._passes.append(path)
        self._log.append(path)
        return seen.get["n"]

    def _rows(self, paths: Sequence[str], kind: int) -> DataFrame:
        return self.spark.read.schema(CHANGE_SCHEMA).option("basePath", self._base).parquet(*paths).where(F.col("kind") == kind)

    def _counts(self) -> DataFrame:
        """``(pair, n)`` of all pairs that occur."""
        rows = self._rows(self._log, COUNT).select("pair", "n") if self._log else None
        if self._compacted:
            stored = self.spark.read.schema("pair long, n long").parquet(self._compacted)
            rows = stored if rows is None else stored.unionAll(rows)
        return rows.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")

    def _pair(self, key: int) -> tuple[int, int]:
        return divmod(key, self.vocab_size + 1)

    def _key(self, pair: tuple[int, int]) -> int:
        return pair[0] * (self.vocab_size + 1) + pair[1]

    def leaders(self) -> list[PairCount]:
        """The most frequent pairs, one more than are looked at; the order of ties is open."""
        if len(self._log) > _LOG:
            path = join_path(self._base, f"counts-{len(self._passes)}")
            self._counts().write.parquet(path)
            self._compacted, self._log = path, []
        seen = Observation()
        counts = self._counts().observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        rows = counts.orderBy(F.desc("n"), "pair").limit(_WATCHED + 1).collect()
        n_pairs = seen.get["n"]
        self._stored_pairs = self._stored_pairs or n_pairs
        if self._pending and n_pairs <= (1 - self._rewrite_share) * self._stored_pairs:
            self._store(self._blocks.mapInArrow(block_merger(self.vocab_size, self._pending), BLOCK_SCHEMA))
            self._pending, self._stored_pairs = [], n_pairs
        return [PairCount(*self._pair(r["pair"]), r["n"]) for r in rows]

    def first_tied(self, n: int) -> list[PairCount]:
        """Of the pairs with count ``n``, those met first, as many as are looked at."""
        tied = self._counts().where(F.col("n") == n).select(F.col("pair").alias("key"))
        places = self._blocks.mapInArrow(place_finder(self.vocab_size, self._pending), DESCRIPTION_SCHEMA)
        first = places.join(tied, "key", "left_semi").groupBy("key").agg(F.min(F.struct("ord", "side", "pos")).alias("at"))
        return [PairCount(*self._pair(r["key"]), n) for r in first.orderBy("at").limit(_WATCHED).collect()]

    def blocks_with(self, pairs: Sequence[PairCount]) -> dict[tuple[int, int], int] | None:
        """Blocks that may hold one of the pairs, with a bit for each; None: too many to list."""
        keys = [self._key(p[:2]) for p in pairs]
        passes = sorted({self._made_in[max(p.left, p.right)] for p in pairs})
        postings = self._rows([self._passes[k] for k in passes], POSTING).where(F.col("pair").isin(keys))
        bit = F.array_position(F.array(*map(F.lit, keys)), F.col("pair")).cast("int") - 1
        held = postings.groupBy("cell", "block").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("held"))
        rows = held.limit(_LISTED + 1).toArrow()
        if len(rows) > _LISTED:
            return None
        cells, blocks, bits = (rows.column(k).to_pylist() for k in range(3))
        return dict(zip(zip(cells, blocks), bits))

    def describe(self, pairs: Sequence[PairCount], listed: Sequence[tuple[int, int]] | None):
        """First places and overlaps of the pairs, and the number of blocks read."""
        seen = Observation()
        watched = [p[:2] for p in pairs]
        describer = pair_describer(self.vocab_size, self._pending, watched)
        read = self._of(listed).observe(seen, F.count(F.lit(1)).alias("n"))
        rows = (
            read.mapInArrow(describer, DESCRIPTION_SCHEMA)
            .groupBy("key")
            .agg(F.sum("n").alias("n"), F.min(F.struct("ord", "side", "pos")).alias("at"))
            .collect()  # at most one row per pair and two pairs
        )
        places = {watched[r["key"]]: tuple(r["at"]) for r in rows if r["key"] >= 0}
        overlaps = {}
        for r in rows:
            if r["key"] < 0:
                i, j = divmod(-1 - r["key"], len(watched))
                overlaps[watched[i], watched[j]] = r["n"]
        return places, overlaps, seen.get["n"]

    def merge(self, batch: Sequence[Merge], listed: Sequence[tuple[int, int]] | None) -> int:
        """Carry out settled merges in the blocks that hold them; the number of blocks read."""
        self._made_in += [len(self._passes)] * len(batch)
        read = self._change(listed, batch)
        self._pending += batch
        return read


def _whole_ties(leaders: Sequence[PairCount]) -> list[PairCount]:
    """Leaders without a last group of equal counts that may go on; empty if there is no other."""
    if len(leaders) <= _WATCHED:
        return list(leaders)
    return [p for p in leaders[:_WATCHED] if p.n > leaders[_WATCHED].n]


def train_bpe_indexed(
    corpus: DataFrame,
    vocab_size: int,
    collapse: bool = False,
    block_tokens: int = BLOCK_TOKENS,
    rewrite_share: float = _REWRITE_SHARE,
    scanned_size: int = SCANNED_SIZE,
    reads: list[PassReads] | None = None,
) -> list[Merge]:
    """The merges of :func:`~twintext.operators.bpe.train_bpe`, with an index of pairs.

    For vocabularies of thousands of tokens. The first ``scanned_size`` tokens,
    whose pairs are found everywhere, are learned by scans, the others over the
    index. Smaller blocks let a pass read less and make the index larger.
    ``reads`` is filled with what each pass over the index read.
    """
    wanted = vocab_size - BYTE_TOKENS
    copies = Snapshots(corpus.sparkSession)
    try:
        stored = copies.write(collapse_equal(corpus)) if collapse else corpus
        merges = train_bpe(stored, min(vocab_size, scanned_size))
        if len(merges) >= wanted or len(merges) < min(vocab_size, scanned_size) - BYTE_TOKENS:
            return merges
        index = PairIndex(stored, vocab_size, block_tokens, rewrite_share, merges)
    finally:
        copies.close()
    try:
        while len(merges) < wanted:
            leaders = index.leaders()
            if not leaders:
                break
            watched = _whole_ties(leaders) or index.first_tied(leaders[0].n)
            held = index.blocks_with(watched)
            listed = None if held is None else list(held)
            places, overlaps, described = index.describe(watched, listed)
            line = sorted(watched, key=lambda p: (-p.n, places[p[:2]]))
            settled, _ = certain_merges(
                line,
                wanted - len(merges),
                BYTE_TOKENS + len(merges),
                True,
                len(watched) == len(leaders),
                places,
                overlaps,
            )
            batch = [Merge(p.left, p.right, BYTE_TOKENS + len(merges) + k) for k, p in enumerate(settled)]
            merges += batch
            if len(merges) == wanted:
                break
            # Pairs made within the batch lie in blocks that hold a pair of the line.
            merged = {p[:2] for p in settled}
            mask = sum(1 << k for k, p in enumerate(watched) if p[:2] in merged)
            chosen = None if held is None else [b for b, bits in held.items() if bits & mask]
            changed = index.merge(batch, chosen)
            if reads is not None:
                reads.append(PassReads(len(batch), described, changed, index.n_blocks))
    finally:
        index.close()
    return merges
