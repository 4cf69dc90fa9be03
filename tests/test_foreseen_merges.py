"""Merges along a foreseen line against counting anew after each merge."""

import random

import pytest

import twintext.operators.bpe as bpe
from tests.test_bpe import corpus_of
from tests.test_indexed_bpe import counted_anew, words
from twintext.functions.tokens import Merge
from twintext.operators.foreseen_merges import renumbered, settle_foreseen


def moved_about(merges, far, seed):
    """Merges in another order, in which tokens still stand behind the merges that make them."""
    rng = random.Random(seed)
    order = sorted(merges, key=lambda m: m[2] + rng.uniform(0, far))
    return renumbered([Merge(*m) for m in order], [], 256)


@pytest.mark.parametrize("far, least", [(0, 40), (4, 1), (30, 1)])
def test_lines_in_another_order(spark, far, least):
    texts = words(far, 300, 60)
    expected = counted_anew(texts, 40)
    found = settle_foreseen(corpus_of(spark, texts), [], moved_about(expected, far, 1), 40, 296)
    pairs = [m[:2] for m in expected]
    assert found.merges == pairs[: len(found.merges)]
    assert len(found.merges) >= least or found.tied


def test_merges_that_touch_no_earlier_one_are_taken_first(spark):
    # Pairs of a line in rising order of their counts: 29 times ab, 20 times cd, 11 times ef.
    texts = {(k, 0): ("ab", "cd", "ef")[(k > 28) + (k > 48)] for k in range(60)}
    line = [Merge(101, 102, 256), Merge(99, 100, 257), Merge(97, 98, 258)]
    found = settle_foreseen(corpus_of(spark, texts), [], line, 3, 259)
    assert found.merges == [(97, 98), (99, 100), (101, 102)]


def test_the_rest_of_a_line_is_short(spark):
    # The first foreseen pair occurs nowhere, while hundreds of others do.
    texts = words(5, 200, 60)
    line = [Merge(1, 2, 256), Merge(2, 1, 257)]
    found = settle_foreseen(corpus_of(spark, texts), [], line, 10, 266)
    assert len(found.line) <= 10 + len(line)


@pytest.mark.parametrize("far", [0, 6])
def test_corpora_that_are_rewritten_along_a_line(spark, far, monkeypatch):
    texts = words(9, 300, 60)
    expected = counted_anew(texts, 60)
    monkeypatch.setattr(bpe, "_foreseen", lambda *a: moved_about(expected, far, 2))
    found = bpe.train_bpe(corpus_of(spark, texts).repartition(3), 316, rewrite_share=0.05)
    assert [tuple(m) for m in found] == expected
