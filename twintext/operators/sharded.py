"""Scores over vocabularies too large for one row.

The logits of a position are stored in shards, each a run of neighbouring
vocabulary entries that begins at ``offset``. A shard is reduced to four numbers
where it lies: the sum of its exponentials at a scale near its peak, the logit of
the label if it holds it, its peak, and the first index of that. Shards that share
a scale are added by ordinary partial sums; scales are multiples of 64, so the
positions of one model have one or two of them, and those are joined last. No
logits are shuffled and no task holds a whole row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.params import PrepParams

_DEFAULTS = PrepParams()
_SCALE = 64.0  # e^32 either way is far from the limits of a double
_LOWEST = float("-inf")


def shard_logits(scored: DataFrame, width: int, logits: str = "logits") -> DataFrame:
    """Cut each row's logits into shards of ``width``: adds ``offset``, ``logits`` become shorter.

    A row without logits keeps one shard without any.
    """
    if width < 1:
        raise ValueError("width must be positive")
    rest = [F.col(c) for c in scored.columns if c != logits]
    last = F.greatest(F.coalesce(F.size(logits), F.lit(0)) - 1, F.lit(0))
    cut = scored.select(*rest, F.col(logits), F.explode(F.sequence(F.lit(0), last, F.lit(width))).alias("offset"))
    return cut.select(*rest, F.col("offset").cast("long"), F.slice(logits, F.col("offset") + 1, width).alias(logits))


def shard_partials(
    shards: DataFrame,
    keys: Sequence[str],
    logits: str = "logits",
    label: str = "label",
    offset: str = "offset",
) -> DataFrame:
    """``(*keys, label, scale, total, chosen, pick)`` for every shard, without a shuffle."""
    values = F.transform(logits, lambda x: F.coalesce(x.cast("double"), F.lit(_LOWEST)))
    read = shards.select(*keys, F.col(label).alias("label"), F.col(offset).alias("__offset"), values.alias("__values"))
    peaked = read.withColumn("__peak", F.array_max("__values")).withColumn("scale", F.rint(F.col("__peak") / _SCALE) * _SCALE)
    total = F.aggregate("__values", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("scale")))
    # A shard that rules out all its entries adds nothing.
    total = F.when(F.col("__peak").isNull() | (F.col("__peak") == _LOWEST), F.lit(0.0)).otherwise(total)
    inside = (F.col("label") - F.col("__offset")).cast("int")
    held = F.when((inside >= 0) & (inside < F.size("__values")), F.get("__values", inside))
    first = F.col("__offset") + F.array_position("__values", F.col("__peak")) - 1
    pick = F.when(F.col("__peak").isNotNull(), F.struct(F.col("__peak").alias("peak"), (-first).alias("before")))
    return peaked.select(*keys, "label", "scale", total.alias("total"), held.alias("chosen"), pick.alias("pick"))


def merge_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partials of equal scale; the result has the columns of ``partials``.

    Merging may be repeated, and done on parts first: shards of one model that
    are written at different times are merged as they come.
    """
    return partials.groupBy(*keys, "label", "scale").agg(
        F.sum("total").alias("total"), F.max("chosen").alias("chosen"), F.max("pick").alias("pick")
    )


def sharded_scores(
    shards: DataFrame,
    keys: Sequence[str],
    logits: str = "logits",
    label: str = "label",
    offset: str = "offset",
    pad_id: int = _DEFAULTS.pad_id,
) -> DataFrame:
    """``(*keys, label, cross_entropy, picked)``: one row per position.

    Equal to scoring the whole row: a padding label costs nothing, the first of
    equal largest logits is picked. ``keys`` name one position, all of whose
    shards carry its label. Null logits count as ruled out; a label that no
    shard holds, or none at all, has no cost (null).
    """
    return scores_of(merge_partials(shard_partials(shards, keys, logits, label, offset), keys), keys, pad_id)


def scores_of(partials: DataFrame, keys: Sequence[str], pad_id: int = _DEFAULTS.pad_id) -> DataFrame:
    """Costs and picks from merged partials; joins the few scales of a position."""
    by_scale = F.collect_list(F.struct("scale", "total"))
    joined = partials.groupBy(*keys, "label").agg(
        by_scale.alias("__parts"), F.max("scale").alias("__top"), F.max("chosen").alias("__chosen"), F.max("pick").alias("__pick")
    )
    total = F.aggregate(
        "__parts", F.lit(0.0), lambda s, p: s + F.when(p["total"] == 0, F.lit(0.0)).otherwise(p["total"] * F.exp(p["scale"] - F.col("__top")))
    )
    # Without an entry that is not ruled out there is no distribution.
    log_total = F.when(total > 0, F.log(total)).otherwise(F.lit(float("nan")))
    cost = F.col("__top") + log_total - F.col("__chosen")
    return joined.select(
        *keys,
        "label",
        F.when(F.col("label") == pad_id, F.lit(0.0)).otherwise(cost).alias("cross_entropy"),
        (-F.col("__pick.before")).cast("int").alias("picked"),
    )
