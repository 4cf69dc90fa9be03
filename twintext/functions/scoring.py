"""Expressions over rows of model scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from twintext.functions.tokens import bpe_decode
from twintext.params import PrepParams

_DEFAULTS = PrepParams()


def token_cross_entropy(logits: Column, label: Column, pad_id: int = _DEFAULTS.pad_id) -> Column:
    """-log softmax(logits)[label]; a padding label costs nothing.

    The largest logit is taken out of the exponent first, so that large scores
    cannot overflow.
    """

    def log_total(peak: Column) -> Column:
        total = F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x.cast("double") - peak))
        return peak + F.log(total)

    chosen = F.element_at(logits, (label + 1).cast("int")).cast("double")
    cost = _bind(F.array_max(logits).cast("double"), log_total) - chosen
    return F.when(label == pad_id, F.lit(0.0)).otherwise(cost)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    An expression used inside a lambda is evaluated for every element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def argmax_token(logits: Column) -> Column:
    """Index of the largest logit, the first one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def cut_at_end(tokens: Column, end_id: int = _DEFAULTS.end_id) -> Column:
    """Tokens up to and including the first end, without the leading start."""
    end = F.array_position(tokens, F.lit(end_id)).cast("int")
    last = F.when(end > 0, end).otherwise(F.size(tokens))
    return F.slice(tokens, F.lit(2), F.greatest(last - 1, F.lit(0)))


def decode_generated(
    tokens: Column, vocabulary: dict[int, bytes], end_id: int = _DEFAULTS.end_id
) -> Column:
    """Text of a generated sequence; the end token prints as its name."""
    return bpe_decode(cut_at_end(tokens, end_id), vocabulary)


def global_step(epoch: Column, batch: Column, batches_per_epoch: Column | int) -> Column:
    """Running step over all epochs."""
    per_epoch = F.lit(batches_per_epoch) if isinstance(batches_per_epoch, int) else batches_per_epoch
    return epoch.cast("long") * per_epoch.cast("long") + batch.cast("long")
