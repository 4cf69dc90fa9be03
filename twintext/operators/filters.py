"""Row filters and the counts that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.functions.text import valid_utf8, within_length
from twintext.params import PrepParams

_DEFAULTS = PrepParams()


def drop_features(df: DataFrame, *names: str) -> DataFrame:
    """Remove columns that are not needed further on; the scan skips them."""
    return df.drop(*names)


def filter_valid_utf8(pairs: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Keep a pair iff both sides are well-formed UTF-8 and not null."""
    return pairs.where(valid_utf8(F.col(src)) & valid_utf8(F.col(tgt)))


def pair_fits(
    src: Column,
    tgt: Column,
    src_limit: int = _DEFAULTS.max_length,
    tgt_limit: int | None = None,
    unit: str = "text",
) -> Column:
    """Whether a pair is short enough; one place of the target is kept free.

    ``unit="text"`` measures code points of text columns, ``unit="tokens"``
    entries of token arrays.
    """
    tgt_limit = src_limit - 1 if tgt_limit is None else tgt_limit
    if unit == "text":
        return within_length(src, src_limit) & within_length(tgt, tgt_limit)
    if unit == "tokens":
        fits = (F.size(src) <= src_limit) & (F.size(tgt) <= tgt_limit)
        return F.coalesce(fits, F.lit(False))
    raise ValueError(f"unit must be 'text' or 'tokens', not {unit!r}")


def filter_length(
    pairs: DataFrame,
    src_limit: int = _DEFAULTS.max_length,
    tgt_limit: int | None = None,
    src: str = "src",
    tgt: str = "tgt",
    unit: str = "text",
) -> DataFrame:
    """Keep the pairs that fit."""
    return pairs.where(pair_fits(F.col(src), F.col(tgt), src_limit, tgt_limit, unit))


def length_report(
    pairs: DataFrame,
    src_limit: int = _DEFAULTS.max_length,
    tgt_limit: int | None = None,
    src: str = "src",
    tgt: str = "tgt",
) -> DataFrame:
    """One row: how many of ``total`` pairs exceed the limits."""
    fits = pair_fits(F.col(src), F.col(tgt), src_limit, tgt_limit)
    return pairs.agg(F.count_if(~fits).alias("exceeded"), F.count(F.lit(1)).alias("total"))


def validity_report(pairs: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """One row: how many of ``total`` pairs are malformed or null."""
    valid = valid_utf8(F.col(src)) & valid_utf8(F.col(tgt))
    return pairs.agg(F.count_if(~valid).alias("invalid"), F.count(F.lit(1)).alias("total"))


def split_counts(rows: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split."""
    return rows.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
