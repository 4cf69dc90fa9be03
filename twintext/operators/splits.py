"""Train / validation / test membership and leading rows."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.functions.text import numeric_key, numeric_key_value, order_key
from twintext.operators.filters import split_counts
from twintext.operators.order import keys_at_ranks
from twintext.params import SPLITS, PrepParams

_DEFAULTS = PrepParams()
_KEY_DIGITS = 32  # of an order key


def _exact(share: float) -> Fraction:
    return Fraction(str(share))


def split_sizes(n: int, params: PrepParams = _DEFAULTS) -> dict[str, int]:
    """Two-stage sizes: the held-out part is rounded up, then its test part."""
    held_share = _exact(params.val_ratio) + _exact(params.test_ratio)
    held = math.ceil(n * held_share)
    test = math.ceil(held * _exact(params.test_ratio) / held_share)
    return {"train": n - held, "val": held - test, "test": test}


def random_split_exact(
    df: DataFrame, row_id: str = "pair_id", params: PrepParams = _DEFAULTS, split: str = "split"
) -> DataFrame:
    """Add ``split`` with exact sizes, by a seeded pseudo-random order of the ids.

    The first rows of the order are test, the next validation, the rest train.
    Finding the two cut keys takes a few passes over the id column; labelling
    the rows is then a projection, so the payload is never shuffled.
    """
    key = order_key(F.col(row_id), params.seed)

    def cuts(n: int) -> list[int]:
        sizes = split_sizes(n, params)
        return [sizes["test"], sizes["test"] + sizes["val"]]

    _, (test_cut, held_cut) = keys_at_ranks(df, key, cuts)
    return df.withColumn(
        split,
        F.when(_upto(key, test_cut), "test").when(_upto(key, held_cut), "val").otherwise("train"),
    )


def _upto(key: Column, cut: str | None) -> Column:
    return F.lit(False) if cut is None else key <= cut


def random_split_hash(
    df: DataFrame, row_id: str = "pair_id", params: PrepParams = _DEFAULTS, split: str = "split"
) -> DataFrame:
    """Add ``split`` by the range of a hash: one pass, sizes approximate, and a row keeps
    its split when other rows are added."""
    key = order_key(F.col(row_id), params.seed)
    test = _exact(params.test_ratio)
    held = test + _exact(params.val_ratio)
    return df.withColumn(
        split, F.when(_below(key, test), "test").when(_below(key, held), "val").otherwise("train")
    )


def _below(key: Column, share: Fraction) -> Column:
    """Whether a key lies in the first ``share`` of all keys."""
    cut = int(share * 16**_KEY_DIGITS)
    return F.lit(True) if share >= 1 else key < f"{cut:0{_KEY_DIGITS}x}"


def take_first_n(df: DataFrame, n: int, row_id: str = "pair_id", key: Column | None = None) -> DataFrame:
    """The first ``n`` rows by id, or by ``key``; all rows if there are fewer.

    By id the result is a range filter, which file statistics can serve.
    """
    if key is not None:
        _, (cut,) = keys_at_ranks(df, key, lambda total: [n])
        return df.where(_upto(key, cut))
    low, high = df.agg(F.min(row_id), F.max(row_id)).first()
    if low is None:
        return df
    _, (cut,) = keys_at_ranks(df, numeric_key(F.col(row_id), low, high), lambda total: [n])
    if cut is None:
        return df.where(F.lit(False))
    return df.where(F.col(row_id) <= numeric_key_value(cut, low, high))


def take_first_n_per_split(
    df: DataFrame, row_id: str = "pair_id", params: PrepParams = _DEFAULTS, split: str = "split"
) -> DataFrame:
    """Cap every split at its size limit, in the seeded order of the split.

    A split without a limit is kept whole; without any, nothing is counted. One count settles the splits that are within their limit; only the others
    need their cut key looked up.
    """
    if all(params.cap(name) is None for name in SPLITS):
        return df
    key = order_key(F.col(row_id), params.seed)
    sizes = {r[split]: r["n_rows"] for r in split_counts(df, split).collect()}
    kept = F.lit(False)
    for name in SPLITS:
        here = F.col(split) == name
        cap = params.cap(name)
        if cap is not None and sizes.get(name, 0) > cap:
            _, (cut,) = keys_at_ranks(df.where(here), key, lambda total, n=cap: [n])
            here = here & _upto(key, cut)
        kept = kept | here
    return df.where(kept)
