"""Preparing pairs that keep arriving.

The filters and the encoder look at one row at a time, so they hold on a
streaming DataFrame as they are; this module only adds source and sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from twintext.functions.tokens import Merge
from twintext.operators.filters import filter_length, filter_valid_utf8
from twintext.operators.splits import random_split_hash
from twintext.params import PrepParams
from twintext.plans.examples import encode_pairs
from twintext.sources.pairs import PAIRS_SCHEMA

_DEFAULTS = PrepParams()


def stream_pairs(spark: SparkSession, path: str, schema: str = PAIRS_SCHEMA) -> DataFrame:
    """Pairs from Parquet files as they appear in a directory."""
    return spark.readStream.schema(schema).parquet(path)


def encode_stream(
    pairs: DataFrame,
    merges: Sequence[Merge],
    params: PrepParams = _DEFAULTS,
    tgt_limit: int | None = None,
) -> DataFrame:
    """Valid, short, split and encoded pairs. Membership comes from the hash of
    the id, as exact split sizes do not exist for an open-ended table."""
    kept = filter_length(filter_valid_utf8(pairs), params.max_length, tgt_limit)
    return encode_pairs(random_split_hash(kept, "pair_id", params), merges)


def write_token_stream(token_pairs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table by split, each file's pairs exactly once."""
    return (
        token_pairs.writeStream.format("parquet")
        .partitionBy("split")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
