"""Losses and rollups over tables of model scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twintext.functions.scoring import argmax_token, global_step, token_cross_entropy
from twintext.params import PrepParams
from twintext.sources.storage import shared_directory

_DEFAULTS = PrepParams()
_BLOCK_BITS = 10  # 1,024 epoch numbers to a block of a running minimum
_MIDDLE = 1 << (63 - _BLOCK_BITS)  # place of epoch 0 among the blocks, which begin at 1
_LEVELS = 66 - _BLOCK_BITS  # of a binary tree over all blocks


def score_tokens(
    scored: DataFrame, logits: str = "logits", label: str = "label", pad_id: int = _DEFAULTS.pad_id
) -> DataFrame:
    """Add ``cross_entropy`` and the greedy ``picked`` token to every row."""
    return scored.withColumns(
        {
            "cross_entropy": token_cross_entropy(F.col(logits), F.col(label), pad_id),
            "picked": argmax_token(F.col(logits)),
        }
    )


def batch_loss(
    scored: DataFrame,
    keys: Sequence[str] = ("batch_id",),
    logits: str = "logits",
    label: str = "label",
    pad_id: int = _DEFAULTS.pad_id,
) -> DataFrame:
    """Loss per batch: summed cross-entropy over the number of real labels.

    A batch of padding only has no loss (NaN).
    """
    cost = token_cross_entropy(F.col(logits), F.col(label), pad_id)
    return _mean_cost(scored, cost, keys, label, pad_id)


def batch_loss_of_costs(
    costs: DataFrame,
    keys: Sequence[str] = ("batch_id",),
    cost: str = "cross_entropy",
    label: str = "label",
    pad_id: int = _DEFAULTS.pad_id,
) -> DataFrame:
    """:func:`batch_loss` where each row holds its cross-entropy already."""
    return _mean_cost(costs, F.col(cost), keys, label, pad_id)


def _mean_cost(rows: DataFrame, cost: Column, keys: Sequence[str], label: str, pad_id: int) -> DataFrame:
    real = F.count_if(F.col(label) != pad_id)
    return (
        rows.groupBy(*keys)
        .agg(F.sum(cost).alias("__cost"), real.alias("n_tokens"))
        .withColumn(
            "loss",
            F.when(F.col("n_tokens") > 0, F.col("__cost") / F.col("n_tokens")).otherwise(
                F.lit(float("nan"))
            ),
        )
        .drop("__cost")
    )


def epoch_loss(
    batches: DataFrame, keys: Sequence[str] = ("epoch",), loss: str = "loss"
) -> DataFrame:
    """Plain mean of the batch losses; batches are not weighted by tokens."""
    return batches.groupBy(*keys).agg(
        F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n_batches")
    )


def metric_rollup(
    log: DataFrame,
    batches_per_epoch: int,
    keys: Sequence[str] = ("tag",),
    epoch: str = "epoch",
    batch: str = "batch",
    value: str = "value",
) -> DataFrame:
    """Per epoch: mean value, number of entries, first and last global step."""
    step = global_step(F.col(epoch), F.col(batch), batches_per_epoch)
    return log.groupBy(*keys, F.col(epoch).alias("epoch")).agg(
        F.avg(value).alias("avg_value"),
        F.count(F.lit(1)).alias("n"),
        F.min(step).alias("first_step"),
        F.max(step).alias("last_step"),
    )


def best_so_far(
    epochs: DataFrame, keys: Sequence[str] = (), epoch: str = "epoch", loss: str = "loss"
) -> DataFrame:
    """Add ``is_best``: the loss is strictly below that of every earlier epoch.

    A running minimum as a scan over segments, so that no task sees all epochs
    of a run: windows go over blocks of 1,024 epoch numbers. What comes before a
    block is made up of at most one node of each level of a binary tree over the
    blocks, so its minimum is a join of block rows with tree nodes and an
    aggregation. The rows are computed once and cut from their lineage.

    ``epoch`` is a number. A null key is a run of its own, null epochs come
    before all others of their run; rows of one epoch come in any order.
    """
    shared_directory(epochs.sparkSession)
    rows = epochs.checkpoint()
    place, own, first, known = "__place", "__own", "__first", "__before"
    number = F.shiftright(F.floor(F.col(epoch)).cast("long"), _BLOCK_BITS)
    inside = Window.partitionBy(*keys, place)
    ordered = inside.orderBy(epoch)
    marked = rows.withColumn(place, F.coalesce(number + _MIDDLE + 1, F.lit(0))).withColumns(
        {
            own: F.min(loss).over(inside),
            known: F.min(loss).over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
            first: F.row_number().over(ordered) == 1,
        }
    )
    blocks = marked.where(F.col(first)).select(*keys, place, own)
    before = _minima_before(blocks, keys, place, own)
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, place)]
    joined = marked.alias("m").join(before.alias("b"), reduce(and_, same), "left")
    # least() skips nulls and ranks NaN last, so an infinite start is implied.
    lowest = F.least(F.col(f"m.{known}"), F.col("b.__minimum"), F.lit(float("inf")))
    return joined.select(*[F.col(f"m.{c}").alias(c) for c in epochs.columns], (F.col(f"m.{loss}") < lowest).alias("is_best"))


def _minima_before(blocks: DataFrame, keys: Sequence[str], place: str, own: str) -> DataFrame:
    """``(*keys, place, __minimum)``: the minimum of all blocks of a run at smaller places.

    The places below one with the binary digits ... are, for each digit that is
    set, the node of that level to the left of the place's own node.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1))).alias("__level")
    node = F.call_function("shiftright", F.col(place), F.col("__level"))
    leveled = blocks.select(*keys, place, own, level).withColumn("__node", node)
    left = leveled.where(F.col("__node") % 2 == 0).groupBy(*keys, "__level", "__node").agg(F.min(own).alias("__minimum"))
    asked = leveled.where(F.col("__node") % 2 == 1).withColumn("__node", F.col("__node") - 1)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    same += [F.col(f"a.{c}") == F.col(f"n.{c}") for c in ("__level", "__node")]
    found = asked.alias("a").join(left.alias("n"), reduce(and_, same))
    return found.groupBy(*[F.col(f"a.{k}").alias(k) for k in (*keys, place)]).agg(F.min("n.__minimum").alias("__minimum"))
