"""Training a byte-pair vocabulary."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twintext.functions.tokens import (
    Merge,
    bpe_decode,
    bpe_encode,
    expand_merges,
    merge_to_ids,
    replace_pairs,
)
from twintext.operators.corpus import collapse_equal
from twintext.operators.foreseen_merges import line_limit, renumbered, settle_foreseen
from twintext.operators.merge_order import PairCount, certain_merges
from twintext.operators.pair_counts import corpus_column, count_adjacent_pairs, keyed_pair_counts
from twintext.params import BYTE_TOKENS, PrepParams, special_tokens
from twintext.sources.storage import Snapshots

_DEFAULTS = PrepParams()
_ROWS = 2048  # result rows of one pass over the corpus
_WATCHED = 32  # pairs whose overlaps are counted along
_REWRITE_SHARE = 0.2  # rewrite the corpus once merges have removed this share of it
_FORESEEN = 1 << 24  # bytes of rows whose merges are learned first, to foresee those of all rows
_FEW, _PATIENCE = 8, 3  # so many passes may settle fewer foreseen merges, then the line is given up

MERGES_SCHEMA = "rank int, left int, right int, token int"
VOCABULARY_SCHEMA = "token int, bytes binary, is_special boolean"


def most_frequent_pair(corpus: DataFrame, vocab_size: int = BYTE_TOKENS) -> DataFrame:
    """The most frequent pair, on ties the one met first; no row without pairs."""
    counted = count_adjacent_pairs(corpus, vocab_size, with_first=True)
    return counted.orderBy(F.desc("n"), "first").limit(1)


def apply_merge(corpus: DataFrame, merge: Merge) -> DataFrame:
    """Replace a pair by its token, left to right and without overlaps."""
    return corpus.withColumn("seq", replace_pairs(F.col("seq"), [merge]))


def train_bpe(
    corpus: DataFrame,
    vocab_size: int = _DEFAULTS.vocab_size,
    collapse: bool = False,
    rewrite_share: float = _REWRITE_SHARE,
) -> list[Merge]:
    """Learn up to ``vocab_size - 256`` merges from ``(ord, side, text)`` rows.

    Every pass over the corpus counts pairs and returns the leading ones; all
    merges that follow from these counts are taken at once. Merges since the
    last rewrite of the corpus are applied on the fly. The first passes read the
    texts as they are, so ``corpus`` should be a stored table; it is rewritten,
    as token ids, whenever merges have removed ``rewrite_share`` of its pairs.
    ``collapse`` combines equal texts first, at the cost of a shuffle of all
    texts. Training ends early when no row has a pair left.

    Of a corpus much larger than ``_FORESEEN`` bytes, so many are trained on
    first. The merges found there are what a pass over all rows then carries out
    and counts along, see :mod:`~twintext.operators.foreseen_merges`; every merge
    is settled by counts over all rows.
    """
    if vocab_size <= BYTE_TOKENS:
        return []
    snapshots = Snapshots(corpus.sparkSession)
    try:
        # Equal texts are combined once, not in every pass.
        stored = snapshots.write(collapse_equal(corpus)) if collapse else corpus
        return _learn(stored, vocab_size, rewrite_share, snapshots, _foreseen(stored, vocab_size))
    finally:
        snapshots.close()


def _foreseen(corpus: DataFrame, vocab_size: int) -> list[Merge]:
    """Merges of about ``_FORESEEN`` bytes of a large corpus; none of a small one."""
    if not line_limit(vocab_size):
        return []
    size = corpus.agg(F.sum(F.octet_length(corpus_column(corpus)))).first()[0] or 0
    if size <= 4 * _FORESEEN:
        return []
    parts = 1 << 20
    part = F.pmod(F.xxhash64("ord", "side"), F.lit(parts))
    snapshots = Snapshots(corpus.sparkSession)
    try:
        some = snapshots.write(corpus.where(part < parts * _FORESEEN // size))
        return _learn(some, vocab_size, _REWRITE_SHARE, snapshots)
    finally:
        snapshots.close()


def _learn(
    stored: DataFrame,
    vocab_size: int,
    rewrite_share: float,
    snapshots: Snapshots,
    line: Sequence[Merge] = (),
) -> list[Merge]:
    """Merges by passes over the corpus, along ``line`` as long as that settles many."""
    wanted = vocab_size - BYTE_TOKENS
    merges: list[Merge] = []
    pending: list[Merge] = []
    stored_pairs, by_place, watched, patience = None, False, [], _PATIENCE
    while len(merges) < wanted:
        size = BYTE_TOKENS + len(merges)
        if line and patience:
            found = settle_foreseen(stored, pending, line, wanted - len(merges), vocab_size)
            learned = [Merge(*pair, size + k) for k, pair in enumerate(found.merges)]
            merges, pending = merges + learned, pending + learned
            line, stored_pairs = found.line, stored_pairs or found.n_pairs
            patience -= len(learned) < _FEW
            by_place |= found.tied
            if pending and found.n_left <= (1 - rewrite_share) * stored_pairs:
                stored = snapshots.write(_merged(stored, pending))
                stored_pairs, pending = found.n_left, []
            if learned and not found.tied:
                continue
            size = BYTE_TOKENS + len(merges)
        counts = _count(stored, size, by_place, pending, watched)
        if not counts.leaders:
            break
        stored_pairs = stored_pairs or counts.n_pairs
        if counts.n_pairs <= (1 - rewrite_share) * stored_pairs:
            stored = snapshots.write(_merged(stored, pending))
            stored_pairs, pending = counts.n_pairs, []
        batch, follow = certain_merges(
            counts.leaders,
            wanted - len(merges),
            size,
            by_place,
            len(counts.leaders) + len(counts.overlaps) < _ROWS,
            watched,
            counts.overlaps,
        )
        # Without a result the top count is shared: from here on places are tracked too.
        by_place = by_place or not batch
        watched = follow[:_WATCHED] if batch else watched
        learned = [Merge(pair.left, pair.right, size + k) for k, pair in enumerate(batch)]
        merges, pending = merges + learned, pending + learned
        line = renumbered(line, [m[:2] for m in learned], size)
    return merges


def _merged(corpus: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    vocab_size = 1 + max(m.token for m in merges)
    column = corpus_column(corpus)
    merged = merge_to_ids(F.col(column), merges, vocab_size, column)
    return corpus.withColumn("ids", merged).select(
        *[c for c in corpus.columns if c != column and c != "ids"], "ids"
    )


class _Counts(NamedTuple):
    leaders: list[PairCount]
    overlaps: dict[tuple[tuple[int, int], tuple[int, int]], int]
    n_pairs: int


def _count(
    corpus: DataFrame,
    vocab_size: int,
    by_place: bool,
    pending: Sequence[Merge],
    watched: Sequence[tuple[int, int]],
) -> _Counts:
    """One pass: the most frequent pairs, overlaps of the watched ones, the number of pairs."""
    seen = Observation()
    total = F.coalesce(F.sum(F.when(F.col("pair") >= 0, F.col("n"))), F.lit(0))
    counted = keyed_pair_counts(corpus, vocab_size, by_place, pending, watched).observe(
        seen, total.alias("n_pairs")
    )
    # Overlaps first: there are at most _WATCHED squared, fewer than _ROWS.
    order = [F.col("pair") >= 0, F.desc("n"), F.col("first" if by_place else "pair")]
    rows = counted.orderBy(*order).limit(_ROWS).select("pair", "n").collect()
    base = vocab_size + 1
    leaders = [PairCount(r["pair"] // base, r["pair"] % base, r["n"]) for r in rows if r["pair"] >= 0]
    overlaps = {}
    for r in rows:
        if r["pair"] < 0:
            i, j = divmod(-1 - r["pair"], len(watched))
            overlaps[watched[i], watched[j]] = r["n"]
    return _Counts(leaders, overlaps, seen.get["n_pairs"])


def merges_table(spark: SparkSession, merges: Sequence[Merge]) -> DataFrame:
    """Merges as ``(rank, left, right, token)``."""
    rows = [(i, m.left, m.right, m.token) for i, m in enumerate(merges)]
    return spark.createDataFrame(rows, MERGES_SCHEMA)


def _special_ids(merges: Sequence[Merge], vocab_size: int) -> dict[str, int]:
    """Ids of the special tokens, refused where learned tokens reach them."""
    last = max((m.token for m in merges), default=BYTE_TOKENS - 1)
    if last >= vocab_size:
        raise ValueError(f"token {last} is learned, but the special tokens begin at {vocab_size}")
    return special_tokens(vocab_size)


def special_token_rows(spark: SparkSession, vocab_size: int = _DEFAULTS.vocab_size) -> DataFrame:
    """The special tokens in the shape of the vocabulary table."""
    rows = [(i, bytearray(name, "utf-8"), True) for name, i in special_tokens(vocab_size).items()]
    return spark.createDataFrame(rows, VOCABULARY_SCHEMA)


def expand_vocab(
    spark: SparkSession,
    merges: Sequence[Merge],
    special: bool = False,
    vocab_size: int = _DEFAULTS.vocab_size,
) -> DataFrame:
    """Vocabulary as ``(token, bytes, is_special)``."""
    rows = [(t, bytearray(b), False) for t, b in expand_merges(merges).items()]
    table = spark.createDataFrame(rows, VOCABULARY_SCHEMA)
    if not special:
        return table
    _special_ids(merges, vocab_size)
    return table.union(special_token_rows(spark, vocab_size))


def vocabulary_bytes(
    merges: Sequence[Merge], special: bool = True, vocab_size: int = _DEFAULTS.vocab_size
) -> dict[int, bytes]:
    """Bytes per token for decoding; special tokens print as their names."""
    table = expand_merges(merges)
    if special:
        table.update({i: name.encode() for name, i in _special_ids(merges, vocab_size).items()})
    return table


def stored_bytes(vocabulary: DataFrame) -> dict[int, bytes]:
    """A vocabulary table as :func:`bpe_decode` takes it; one row per token."""
    return {r["token"]: bytes(r["bytes"]) for r in vocabulary.select("token", "bytes").collect()}


def roundtrip_failures(df: DataFrame, merges: Sequence[Merge], text: str = "text") -> DataFrame:
    """Rows whose text does not come back from encoding and decoding."""
    back = bpe_decode(bpe_encode(F.col(text), merges), vocabulary_bytes(merges, special=False))
    return df.where(~back.eqNullSafe(F.col(text)))
