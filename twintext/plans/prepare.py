"""Corpus preparation: pairs to splits and a vocabulary."""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from twintext.functions.tokens import Merge
from twintext.operators.bpe import train_bpe
from twintext.operators.corpus import unpivot_corpus
from twintext.operators.filters import filter_valid_utf8, split_counts
from twintext.operators.splits import random_split_exact, random_split_hash
from twintext.params import PrepParams
from twintext.sources.pairs import read_split, write_splits
from twintext.sources.storage import fingerprint, join_path, publish_once
from twintext.sources.vocabulary import read_merges, write_merges

log = logging.getLogger(__name__)


class Prepared(NamedTuple):
    splits: DataFrame
    merges: list[Merge]


def prepare_corpus(
    spark: SparkSession,
    pairs: DataFrame,
    directory: str,
    params: PrepParams = PrepParams(),
    exact_split: bool = True,
    collapse: bool = False,
) -> Prepared:
    """Split, drop malformed pairs, train on the train split, store both.

    Results that were published in ``directory`` are reused; if they were made
    with other parameters or from other pairs, they are refused. ``collapse``
    combines equal texts before training.
    """
    split_with = {
        "seed": params.seed,
        "shares": [params.train_ratio, params.val_ratio, params.test_ratio],
        "exact": exact_split,
    }
    splitter = random_split_exact if exact_split else random_split_hash
    made_from = fingerprint(pairs)
    splits_path = publish_once(
        spark,
        join_path(directory, "splits"),
        lambda path: write_splits(filter_valid_utf8(splitter(pairs, "pair_id", params)), path),
        split_with,
        made_from,
    )
    splits = spark.read.parquet(splits_path)
    for row in split_counts(splits).collect():
        log.info("%s rows: %d", row["split"], row["n_rows"])

    def train(path: str) -> None:
        rows = read_split(spark, splits_path, "train")
        write_merges(spark, path, train_bpe(unpivot_corpus(rows), params.vocab_size, collapse))

    train_with = {**split_with, "vocab_size": params.vocab_size}
    vocabulary = publish_once(spark, join_path(directory, "bpe"), train, train_with, made_from)
    return Prepared(splits, read_merges(spark, vocabulary))
