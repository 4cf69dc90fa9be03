import pytest
from pyspark.sql import functions as F

from twintext.functions.examples import (
    cross_cells,
    decoder_cells,
    encoder_cells,
    end_is_cut,
    length_mask,
    non_pad_count,
    pad_tokens,
    valid_length,
)
from twintext.params import PrepParams
from twintext.plans.examples import eval_examples, example_lengths, train_examples

SMALL = PrepParams(max_length=5)


@pytest.mark.parametrize(
    "tokens, start, end, padded, length",
    [
        ([1, 2], False, False, [1, 2, 501, 501, 501], 2),
        ([1, 2], False, True, [1, 2, 502, 501, 501], 3),
        ([1, 2], True, False, [500, 1, 2, 501, 501], 3),
        ([1, 2, 3, 4, 5], False, True, [1, 2, 3, 4, 5], 5),
        ([1, 2, 3, 4, 5, 6, 7], True, True, [500, 1, 2, 3, 4], 5),
        ([], False, False, [501] * 5, 0),
        ([], True, True, [500, 502, 501, 501, 501], 2),
    ],
)
def test_padding_golden(spark, tokens, start, end, padded, length):
    df = spark.createDataFrame([(tokens,)], "ids array<int>")
    out = df.select(pad_tokens(F.col("ids"), 5, start, end).alias("p")).select(
        "p", valid_length(F.col("p")).alias("n")
    )
    assert tuple(out.first()) == (padded, length)


def test_masks_agree_with_dense_ones(spark):
    for s, t in [(0, 0), (1, 4), (3, 2), (5, 5)]:
        row = spark.range(1).select(
            encoder_cells(F.lit(s)).alias("e"), decoder_cells(F.lit(t)).alias("d"),
            cross_cells(F.lit(s), F.lit(t)).alias("c"), length_mask(F.lit(s), 5).alias("m"),
        ).first()
        cells = [(i, j) for i in range(5) for j in range(5)]
        assert row["e"] == sum(i < s and j < s for i, j in cells)
        assert row["d"] == sum(i < t and j < t and j <= i for i, j in cells)
        assert row["c"] == sum(i < t and j < s for i, j in cells)
        assert row["m"] == [int(i < s) for i in range(5)]


def test_example_forms(spark):
    pairs = spark.createDataFrame(
        [(1, [1, 2], [3, 4]), (2, [1], [3, 4, 5, 6, 7])],
        "pair_id long, src_tokens array<int>, tgt_tokens array<int>",
    )
    train = {r["pair_id"]: r for r in train_examples(pairs, SMALL).collect()}
    assert train[1]["src"] == [1, 2, 501, 501, 501]
    # One more end token lands behind the full row and is cut away.
    assert train[1]["tgt"] == train[1]["label"] == [3, 4, 502, 501, 501]
    held = {r["pair_id"]: r for r in eval_examples(pairs, SMALL).collect()}
    assert held[1]["tgt"] == [500, 3, 4, 501, 501]
    assert held[1]["label"] == [3, 4, 502, 501, 501]
    assert held[2]["tgt"] == [500, 3, 4, 5, 6]
    assert held[2]["label"] == [3, 4, 5, 6, 7]
    lengths = {r["pair_id"]: r for r in example_lengths(eval_examples(pairs, SMALL), SMALL).collect()}
    assert (lengths[1]["src_len"], lengths[1]["tgt_len"], lengths[1]["n_labels"]) == (2, 3, 3)
    assert (lengths[2]["tgt_len"], lengths[2]["n_labels"]) == (5, 5)
    cut = pairs.select("pair_id", end_is_cut(F.col("tgt_tokens"), 5).alias("c")).collect()
    assert {r["pair_id"]: r["c"] for r in cut} == {1: False, 2: True}


def test_non_pad_count(spark):
    df = spark.createDataFrame([([3, 501, 4, 501],)], "l array<int>")
    assert df.select(non_pad_count(F.col("l")).alias("n")).first()["n"] == 2
