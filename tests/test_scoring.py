import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from twintext.functions.scoring import argmax_token, cut_at_end, decode_generated, global_step
from twintext.operators.bpe import vocabulary_bytes
from twintext.operators.evaluate import batch_loss, best_so_far, epoch_loss, metric_rollup, score_tokens
from twintext.plans.scoring import validation_report

PAD = 3


def scored(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    rows = [
        (i // 20, i // 10, [float(x) for x in rng.normal(0, 30, 4)], int(rng.integers(0, 4)))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "epoch long, batch_id long, logits array<double>, label int")


def cost(logits, label):
    if label == PAD:
        return 0.0
    peak = max(logits)
    return peak + math.log(sum(math.exp(x - peak) for x in logits)) - logits[label]


def test_losses(spark):
    rows, df = scored(spark)
    tokens = score_tokens(df, pad_id=PAD).collect()
    for r in tokens:
        assert r["cross_entropy"] == pytest.approx(cost(r["logits"], r["label"]), abs=1e-9)
        assert r["picked"] == int(np.argmax(r["logits"]))
    batches = {}
    for epoch, batch, logits, label in rows:
        batches.setdefault((epoch, batch), []).append((cost(logits, label), label != PAD))
    losses = {k: sum(c for c, _ in v) / sum(real for _, real in v) for k, v in batches.items()}
    for r in batch_loss(df, ("epoch", "batch_id"), pad_id=PAD).collect():
        assert r["loss"] == pytest.approx(losses[(r["epoch"], r["batch_id"])])
    report = {r["epoch"]: r for r in validation_report(df, PAD).collect()}
    best = math.inf
    for epoch in range(3):
        mean = np.mean([v for (e, _), v in losses.items() if e == epoch])
        assert report[epoch]["loss"] == pytest.approx(mean)
        assert report[epoch]["is_best"] == (mean < best)
        best = min(best, mean)


def test_label_outside_the_logits_when_padding(spark):
    df = spark.createDataFrame([([1.0, 2.0], 501)], "logits array<double>, label int")
    assert score_tokens(df).first()["cross_entropy"] == 0.0


def test_huge_logits_do_not_overflow(spark):
    df = spark.createDataFrame([([5000.0, 4999.0], 0)], "logits array<float>, label int")
    assert score_tokens(df).first()["cross_entropy"] == pytest.approx(math.log(1 + math.exp(-1)))


def test_batch_of_padding_has_no_loss(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], PAD)], "batch_id long, logits array<double>, label int")
    row = batch_loss(df, pad_id=PAD).first()
    assert row["n_tokens"] == 0 and math.isnan(row["loss"])


def test_epoch_mean_is_not_weighted(spark):
    df = spark.createDataFrame([(0, 1.0, 100), (0, 3.0, 1)], "epoch long, loss double, n_tokens long")
    assert epoch_loss(df).first()["loss"] == 2.0


def test_argmax_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0],), ([math.nan, 9.0],)], "l array<double>")
    assert [r["p"] for r in df.select(argmax_token(F.col("l")).alias("p")).collect()] == [1, 0]


@pytest.mark.parametrize(
    "ids, cut",
    [([500, 97, 98, 502, 99, 502], [97, 98, 502]), ([500, 97, 98], [97, 98]), ([500, 502], [502]), ([500], [])],
)
def test_cut_at_end(spark, ids, cut):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert df.select(cut_at_end(F.col("ids")).alias("c")).first()["c"] == cut
    text = df.select(decode_generated(F.col("ids"), vocabulary_bytes([])).alias("t")).first()["t"]
    assert text == "".join("<END>" if i == 502 else chr(i) for i in cut)


def test_best_so_far(spark):
    losses = [5.0, 5.0, 4.0, math.nan, 4.5, math.inf, 3.0, 3.0]
    rows = [("r", i, x) for i, x in enumerate(losses)] + [("nan", 0, math.nan), ("nan", 1, math.inf), ("nan", 2, 9.0)]
    df = spark.createDataFrame(rows, "run string, epoch long, loss double")
    found = {(r["run"], r["epoch"]): r["is_best"] for r in best_so_far(df, ("run",)).collect()}
    best = {"r": math.inf, "nan": math.inf}
    for run, epoch, loss in rows:
        assert found[(run, epoch)] == (loss < best[run]), (run, epoch)
        best[run] = loss if loss < best[run] else best[run]


def test_best_so_far_across_blocks(spark):
    rng = np.random.default_rng(3)
    losses = [float(x) for x in rng.normal(0, 1, 5000) - np.arange(5000) / 2000]
    df = spark.createDataFrame(list(enumerate(losses)), "epoch long, loss double")
    found = {r["epoch"]: r["is_best"] for r in best_so_far(df).collect()}
    low = np.minimum.accumulate([math.inf, *losses[:-1]])
    assert found == {i: bool(x < low[i]) for i, x in enumerate(losses)}


def test_metric_rollup(spark):
    rows = [("a", 0, 0, 1.0), ("a", 0, 3, 2.0), ("a", 1, 2, 9.0), ("b", 1, 1, 4.0)]
    df = spark.createDataFrame(rows, "tag string, epoch int, batch int, value double")
    out = {(r["tag"], r["epoch"]): tuple(r)[2:] for r in metric_rollup(df, 10).collect()}
    assert out == {("a", 0): (1.5, 2, 0, 3), ("a", 1): (9.0, 1, 12, 12), ("b", 1): (4.0, 1, 11, 11)}
    assert spark.range(1).select(global_step(F.lit(2), F.lit(5), 100).alias("s")).first()["s"] == 205


def test_best_so_far_keeps_null_keys_and_reads_once(spark):
    rows = [("a", 1, 2.0), (None, 1, 3.0), (None, 2, 1.0), ("a", None, 5.0)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    log = spark.createDataFrame(rows, "tag string, epoch long, loss double")
    best = best_so_far(log.mapInArrow(count, log.schema), ("tag",))
    found = {(r["tag"], r["epoch"]): r["is_best"] for r in best.collect()}
    assert found == {("a", 1): True, (None, 1): True, (None, 2): True, ("a", None): True}
    assert seen.value == len(rows)


@pytest.mark.parametrize("keys", [(), ("run",)])
def test_running_minimum_over_wide_epochs(spark, keys):
    """Epochs far apart, negative, null and repeated losses; no task may see a whole run."""
    rng = np.random.default_rng(11)
    numbers = {0, 1023, 1024, 1025, -1, -1024, -1025, 2**62, -(2**62), 2**63 - 1, -(2**63)}
    numbers |= {int(x) for x in rng.integers(-(10**6), 10**6, 400)} | {int(x) for x in rng.integers(-(2**62), 2**62, 100)}
    rows, expected = [], {}
    for run in ("a", None) if keys else ("a",):
        order = [None, *sorted(numbers)]
        losses = [float(x) for x in np.round(rng.normal(0, 1, len(order)) - np.arange(len(order)) / 300, 2)]
        losses[7], losses[50], losses[200] = math.nan, math.inf, None
        low = math.inf
        for e, x in zip(order, losses):
            rows.append((run, e, x))
            expected[run, e] = None if x is None else x < low
            if x is not None and x < low:
                low = x
    df = spark.createDataFrame(rows, "run string, epoch long, loss double").repartition(3)
    best = best_so_far(df, keys)
    assert {(r["run"], r["epoch"]): r["is_best"] for r in best.collect()} == expected
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_best_so_far_of_nothing(spark):
    assert best_so_far(spark.createDataFrame([], "epoch long, loss double")).count() == 0
