import math
import random

import pytest
from pyspark.sql import functions as F

from twintext.operators.evaluate import batch_loss, batch_loss_of_costs, score_tokens
from twintext.operators.sharded import merge_partials, scores_of, shard_logits, shard_partials, sharded_scores

SCHEMA = "id long, batch_id long, label int, logits array<float>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return {r["id"]: (r["cross_entropy"], r["picked"]) for r in df.collect()}


@pytest.mark.parametrize("width", [1, 7, 64, 100])
def test_equal_to_whole_rows(spark, width):
    random.seed(width)
    rows = [(i, i % 3, i % 50, [random.choice((-300.0, -2.5, 0.0, 2.5, 90.0, 400.0)) for _ in range(50)]) for i in range(60)]
    whole = table(spark, rows)
    expected = found(score_tokens(whole, pad_id=9).select("id", "cross_entropy", "picked"))
    actual = found(sharded_scores(shard_logits(whole, width), ["id"], pad_id=9))
    assert actual.keys() == expected.keys()
    for i, (cost, picked) in expected.items():
        assert actual[i][1] == picked
        assert actual[i][0] == pytest.approx(cost, rel=1e-9, abs=1e-9)


def test_ties_go_to_the_smallest_index_over_shards(spark):
    rows = [(1, 0, 1, [0.0, 3.0, 1.0, 3.0, 3.0]), (2, 0, 1, [-0.0, 0.0, 0.0])]
    assert {i: p for i, (_, p) in found(sharded_scores(shard_logits(table(spark, rows), 2), ["id"])).items()} == {1: 1, 2: 0}


def test_nulls_infinities_and_missing_labels(spark):
    low, inf = float("-inf"), float("inf")
    rows = [
        (1, 0, 2, [low, low, 1.0, 1.0]),  # a shard that rules out all its entries
        (2, 0, 7, [0.0, 1.0]),  # a label that no shard holds
        (3, 0, None, [0.0, 1.0]),
        (4, 0, 1, []),
        (5, 0, 1, None),
        (6, 0, 0, [0.0, None, 0.0]),
        (7, 0, 0, [low, low, low]),
        (8, 0, 0, [inf, 0.0, 0.0]),
    ]
    got = found(sharded_scores(shard_logits(table(spark, rows), 2), ["id"], pad_id=9))
    assert got[1] == (pytest.approx(math.log(2)), 2)
    assert got[2] == (None, 1) and got[3] == (None, 1)
    assert got[4] == (None, None) and got[5] == (None, None)
    assert got[6] == (pytest.approx(math.log(2)), 0)
    assert math.isnan(got[7][0]) and got[7][1] == 0
    assert math.isnan(got[8][0]) and got[8][1] == 0
    assert shard_logits(table(spark, []), 2).count() == 0
    assert sharded_scores(shard_logits(table(spark, []), 2), ["id"]).count() == 0


def test_merging_in_steps_changes_nothing(spark):
    rows = [(i, 0, i, [float((i * k) % 11) * 40 for k in range(24)]) for i in range(12)]
    partials = shard_partials(shard_logits(table(spark, rows), 4), ["id"])
    once = found(scores_of(merge_partials(partials, ["id"]), ["id"]))
    odd = F.col("chosen").isNull()
    parts = merge_partials(partials.where(odd), ["id"]).unionByName(merge_partials(partials.where(~odd), ["id"]))
    again = found(scores_of(merge_partials(parts, ["id"]), ["id"]))
    assert {i: p for i, (_, p) in once.items()} == {i: p for i, (_, p) in again.items()}
    for i in once:
        assert once[i][0] == pytest.approx(again[i][0])


def test_batch_losses(spark):
    rows = [(i, i % 4, i % 10, [float((i * k) % 7) for k in range(10)]) for i in range(40)]
    whole = table(spark, rows)
    costs = sharded_scores(shard_logits(whole, 3), ["id", "batch_id"], pad_id=9)
    expected = {r["batch_id"]: (r["n_tokens"], r["loss"]) for r in batch_loss(whole, pad_id=9).collect()}
    for r in batch_loss_of_costs(costs, pad_id=9).collect():
        n, loss = expected.pop(r["batch_id"])
        assert r["n_tokens"] == n and r["loss"] == pytest.approx(loss)
    assert not expected


def test_logits_are_not_shuffled(spark):
    rows = sharded_scores(shard_logits(table(spark, []), 2), ["id"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    lists = plan.split("Aggregate")[-1].split("Project")[0]
    assert "logits" not in lists and "__values" not in lists


def test_width_is_checked(spark):
    with pytest.raises(ValueError):
        shard_logits(table(spark, []), 0)
