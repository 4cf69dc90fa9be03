"""Model inputs: encoded pairs and padded batches."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twintext.functions.examples import (
    cross_cells,
    decoder_cells,
    encoder_cells,
    end_is_cut,
    non_pad_count,
    pad_tokens,
    valid_length,
)
from twintext.functions.tokens import Merge, bpe_encode
from twintext.operators.batches import assign_batches
from twintext.operators.filters import filter_length, pair_fits, split_counts
from twintext.operators.splits import take_first_n_per_split
from twintext.params import PrepParams
from twintext.sources.storage import fingerprint, is_published, materialize_once

log = logging.getLogger(__name__)

_DEFAULTS = PrepParams()


def encode_pairs(pairs: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """Replace ``src`` and ``tgt`` by their token arrays."""
    return pairs.withColumns(
        {
            "src_tokens": bpe_encode(F.col("src"), merges),
            "tgt_tokens": bpe_encode(F.col("tgt"), merges),
        }
    ).drop("src", "tgt")


def build_token_pairs(
    splits: DataFrame,
    merges: Sequence[Merge],
    params: PrepParams = _DEFAULTS,
    tgt_limit: int | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Cap every split if asked to, drop long pairs, encode the rest.

    The length test reads text only, so it comes before the costly encoding.
    ``seen`` counts, in the same pass, the ``exceeded`` pairs of ``total``.
    """
    capped = take_first_n_per_split(splits, "pair_id", params)
    if seen is not None:
        fits = pair_fits(F.col("src"), F.col("tgt"), params.max_length, tgt_limit)
        counts = F.count_if(~fits).alias("exceeded"), F.count(F.lit(1)).alias("total")
        capped = capped.observe(seen, *counts)
    return encode_pairs(filter_length(capped, params.max_length, tgt_limit), merges)


def token_pairs_once(
    spark: SparkSession,
    path: str,
    splits: DataFrame,
    merges: Sequence[Merge],
    params: PrepParams = _DEFAULTS,
) -> DataFrame:
    """The token-pair table published at ``path``, computed first if there is none."""
    seen = Observation()
    fresh = not is_published(spark, path)
    stored = materialize_once(
        spark,
        path,
        lambda: build_token_pairs(splits, merges, params, seen=seen),
        partition_by=("split",),
        made_with={"params": asdict(params), "merges": [list(m) for m in merges]},
        made_from=fingerprint(splits),
    )
    if fresh:
        log.info("%d of %d pairs are too long", seen.get["exceeded"], seen.get["total"])
    for row in split_counts(stored).collect():
        log.info("%s token pairs: %d", row["split"], row["n_rows"])
    return stored


def train_examples(token_pairs: DataFrame, params: PrepParams = _DEFAULTS) -> DataFrame:
    """``src`` bare, ``tgt`` with end, ``label`` equal to ``tgt``.

    The label repeats the target because one more end token, put behind a row
    that is full already, is cut away again. Training on shifted labels uses
    :func:`eval_examples`.
    """
    n = params.max_length
    tgt = pad_tokens(F.col("tgt_tokens"), n, end=True, params=params)
    return token_pairs.withColumns(
        {
            "src": pad_tokens(F.col("src_tokens"), n, params=params),
            "tgt": tgt,
            "label": pad_tokens(tgt, n, end=True, params=params),
        }
    ).drop("src_tokens", "tgt_tokens")


def eval_examples(token_pairs: DataFrame, params: PrepParams = _DEFAULTS) -> DataFrame:
    """``src`` bare, ``tgt`` led by start, ``label`` closed by end: shifted by one."""
    n = params.max_length
    return token_pairs.withColumns(
        {
            "src": pad_tokens(F.col("src_tokens"), n, params=params),
            "tgt": pad_tokens(F.col("tgt_tokens"), n, start=True, params=params),
            "label": pad_tokens(F.col("tgt_tokens"), n, end=True, params=params),
        }
    ).drop("src_tokens", "tgt_tokens")


def example_lengths(examples: DataFrame, params: PrepParams = _DEFAULTS) -> DataFrame:
    """Valid lengths, visible mask cells and real labels of padded examples."""
    pad = params.pad_id
    lengths = examples.withColumns(
        {
            "src_len": valid_length(F.col("src"), pad),
            "tgt_len": valid_length(F.col("tgt"), pad),
            "n_labels": non_pad_count(F.col("label"), pad),
        }
    )
    return lengths.withColumns(
        {
            "encoder_cells": encoder_cells(F.col("src_len")),
            "decoder_cells": decoder_cells(F.col("tgt_len")),
            "cross_cells": cross_cells(F.col("src_len"), F.col("tgt_len")),
        }
    )


def cut_ends(token_pairs: DataFrame, params: PrepParams = _DEFAULTS) -> DataFrame:
    """One row: how many sources are cut at the length limit, and targets with their end token."""
    cut = end_is_cut(F.col("tgt_tokens"), params.max_length)
    source_cut = F.size("src_tokens") > params.max_length
    return token_pairs.agg(
        F.count_if(cut).alias("n_cut"),
        F.count_if(source_cut).alias("n_src_cut"),
        F.count(F.lit(1)).alias("total"),
    )


def epoch_batches(
    token_pairs: DataFrame, epoch: int, params: PrepParams = _DEFAULTS, training: bool = False
) -> DataFrame:
    """Padded examples of one split in the batches of one epoch.

    Rows are placed while the arrays are still ragged; padding comes last, so
    the shuffle carries no padding.
    """
    placed = assign_batches(token_pairs, epoch, "pair_id", params)
    return train_examples(placed, params) if training else eval_examples(placed, params)
