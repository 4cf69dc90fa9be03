"""Epoch order, batches and samples of batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.functions.text import order_key
from twintext.operators.order import keys_at_ranks, with_ordinal
from twintext.params import PrepParams

_DEFAULTS = PrepParams()


def shuffle_epoch(
    df: DataFrame,
    epoch: int,
    row_id: str = "pair_id",
    params: PrepParams = _DEFAULTS,
    ordinal: str = "ordinal",
    total: str | None = None,
) -> DataFrame:
    """Add each row's position in the order of one epoch."""
    return with_ordinal(df, order_key(F.col(row_id), params.seed, epoch), ordinal, total)


def assign_batches(
    df: DataFrame,
    epoch: int = 0,
    row_id: str = "pair_id",
    params: PrepParams = _DEFAULTS,
) -> DataFrame:
    """Add ``batch_id`` and ``slot``; a short last group is dropped."""
    size = params.batch_size
    placed = shuffle_epoch(df, epoch, row_id, params, "__ordinal", "__total")
    whole = F.col("__total") - F.pmod(F.col("__total"), F.lit(size))
    return (
        placed.where(F.col("__ordinal") < whole)
        .withColumns(
            {
                "batch_id": F.call_function("div", F.col("__ordinal"), F.lit(size)),
                "slot": F.pmod(F.col("__ordinal"), F.lit(size)).cast("int"),
            }
        )
        .drop("__ordinal", "__total")
    )


def sample_every_k(batches: DataFrame, k: int = _DEFAULTS.log_every) -> DataFrame:
    """Batches 0, k, 2k, ..."""
    return batches.where(F.pmod(F.col("batch_id"), F.lit(k)) == 0)


def preview_batches(batches: DataFrame, n: int = 5) -> DataFrame:
    """Batches 0 to n, the last one included, of a table that is in batches already."""
    return batches.where(F.col("batch_id") <= n)


def first_batches(
    df: DataFrame, n: int = 5, epoch: int = 0, row_id: str = "pair_id", params: PrepParams = _DEFAULTS
) -> DataFrame:
    """Batches 0 to n of an epoch, the last one included; a short last batch is dropped.

    The last place shown is looked up first, so that only the rows shown are
    put in order.
    """
    key = order_key(F.col(row_id), params.seed, epoch)

    def last(total: int) -> list[int]:
        return [min((n + 1) * params.batch_size, total - total % params.batch_size)]

    _, (cut,) = keys_at_ranks(df, key, last)
    shown = df.where(F.lit(False) if cut is None else key <= cut)
    return assign_batches(shown, epoch, row_id, params)
