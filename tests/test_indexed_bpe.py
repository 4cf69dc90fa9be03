"""Training over an index of pairs against counting anew after each merge."""

from collections import Counter

import pytest

import twintext.operators.indexed_bpe as indexed
from tests import brute
from tests.test_bpe import corpus_of, random_texts
from twintext.functions.tokens import Merge
from twintext.operators.indexed_bpe import PairIndex, train_bpe_indexed
from twintext.operators.merge_order import PairCount


def words(seed, n, longest):
    """Texts over a few hundred words of unequal frequency."""
    import random

    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    return {
        (o, 0): " ".join(known[int(300 * rng.random() ** 3)] for _ in range(rng.randrange(longest)))
        for o in range(n)
    }


def counted_anew(texts, wanted):
    """Merges by counting all pairs after each merge; a dictionary keeps the order of first places."""
    rows = [list(t.encode()) for _, t in sorted(texts.items())]
    merges = []
    for token in range(256, 256 + wanted):
        counts = Counter(pair for row in rows for pair in zip(row, row[1:]))
        if not counts:
            break
        pair = max(counts, key=counts.get)
        merges.append((*pair, token))
        for k, row in enumerate(rows):
            if pair in zip(row, row[1:]):
                rows[k] = brute.merge(row, pair, token)
    return merges


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (3, "aé അ")])
def test_equals_brute_force(spark, seed, letters):
    texts = random_texts(seed, 12, letters, 30)
    expected, _ = brute.train(texts, 10)
    found = train_bpe_indexed(corpus_of(spark, texts), 256 + 10, block_tokens=50, scanned_size=256)
    assert [tuple(m) for m in found] == expected


def test_continues_after_scans(spark):
    texts, reads = words(1, 240, 60), []
    corpus = corpus_of(spark, texts).repartition(6)
    found = train_bpe_indexed(corpus, 380, block_tokens=256, scanned_size=300, reads=reads)
    assert [tuple(m) for m in found] == counted_anew(texts, 124)
    assert reads and all(0 < r.blocks_changed <= r.blocks_described <= r.blocks for r in reads)


def counts_of(rows):
    return Counter(pair for row in rows for pair in zip(row, row[1:]))


def test_only_blocks_with_a_merged_pair_are_read(spark):
    texts = {(k, 0): "the same words over again " * 3 + ("qz" * 4 if k == 17 else "") for k in range(40)}
    index = PairIndex(corpus_of(spark, texts).repartition(4), 300, 100, 0.2)
    try:
        assert index.n_blocks >= 20
        rare, common = PairCount(113, 122, 4), PairCount(116, 104, 120)
        held = index.blocks_with([rare, common])
        assert len(held) == index.n_blocks
        listed = [b for b, bits in held.items() if bits & 1]
        assert len(listed) == 1
        assert index.merge([Merge(113, 122, 256)], listed) == 1
        # The new pair is found in that block alone, which is read for the next merge.
        assert list(index.blocks_with([PairCount(256, 256, 3)])) == listed
        assert index.merge([Merge(256, 256, 257)], listed) == 1
        rows = [brute.merge(brute.merge(list(t.encode()), (113, 122), 256), (256, 256), 257) for t in texts.values()]
        found = {index._pair(r["pair"]): r["n"] for r in index._counts().collect()}
        assert found == counts_of(rows)
    finally:
        index.close()


def test_lists_too_long_copies_and_rewriting(spark, monkeypatch):
    monkeypatch.setattr(indexed, "_LISTED", 2)
    monkeypatch.setattr(indexed, "_LOG", 2)
    texts = words(2, 30, 20)
    texts.update({(100 + k, 0): texts[3, 0] for k in range(20)})
    found = train_bpe_indexed(
        corpus_of(spark, texts), 280, collapse=True, block_tokens=64, rewrite_share=0.02, scanned_size=260
    )
    assert [tuple(m) for m in found] == counted_anew(texts, 24)


def test_small_and_empty_inputs(spark):
    texts = {(0, 0): "abab", (1, 0): "x", (2, 0): "", (3, 0): None}
    merges = [(97, 98, 256), (256, 256, 257)]
    assert train_bpe_indexed(corpus_of(spark, texts), 300, scanned_size=256) == merges
    assert train_bpe_indexed(corpus_of(spark, texts), 300) == merges
    assert train_bpe_indexed(corpus_of(spark, texts).where("ord < 0"), 300, scanned_size=256) == []
    assert train_bpe_indexed(corpus_of(spark, texts), 255) == []


def test_blocks_are_handed_on_a_few_at_a_time(spark):
    index = PairIndex(corpus_of(spark, {(0, 0): "abab"}), 300, 100, 0.2, [Merge(97, 98, 256)])
    try:
        own = index._blocks.sparkSession.conf
        assert int(own.get("spark.sql.execution.arrow.maxBytesPerBatch")) == indexed._HANDED
        assert own.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != str(indexed._HANDED)
        assert {index._pair(r["pair"]): r["n"] for r in index._counts().collect()} == {(256, 256): 1}
    finally:
        index.close()
