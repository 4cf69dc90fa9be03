"""Losses of a scored table, from tokens to the epochs worth keeping."""

from __future__ import annotations

from pyspark.sql import DataFrame

from twintext.operators.evaluate import batch_loss, best_so_far, epoch_loss
from twintext.params import PrepParams

_DEFAULTS = PrepParams()


def validation_report(scored: DataFrame, pad_id: int = _DEFAULTS.pad_id) -> DataFrame:
    """``(epoch, loss, n_batches, is_best)`` of rows ``(epoch, batch_id, logits, label)``."""
    batches = batch_loss(scored, ("epoch", "batch_id"), pad_id=pad_id)
    return best_so_far(epoch_loss(batches), loss="loss")
