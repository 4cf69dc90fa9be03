"""Merge and vocabulary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from twintext.functions.tokens import Merge
from twintext.operators.bpe import (
    MERGES_SCHEMA,
    VOCABULARY_SCHEMA,
    expand_vocab,
    merges_table,
    special_token_rows,
)
from twintext.params import PrepParams
from twintext.sources.storage import data_path, join_path


def write_merges(spark: SparkSession, path: str, merges: Sequence[Merge]) -> None:
    """Write ``merges`` and ``vocabulary`` under ``path``; both are small."""
    merges_table(spark, merges).coalesce(1).write.mode("overwrite").parquet(join_path(path, "merges"))
    expand_vocab(spark, merges).coalesce(1).write.mode("overwrite").parquet(
        join_path(path, "vocabulary")
    )


def read_merges(spark: SparkSession, path: str) -> list[Merge]:
    """The learned merges in id order; as many as the vocabulary has learned."""
    table = spark.read.schema(MERGES_SCHEMA).parquet(join_path(data_path(spark, path), "merges"))
    rows = table.orderBy("rank").collect()
    return [Merge(r["left"], r["right"], r["token"]) for r in rows]


def read_vocabulary(
    spark: SparkSession, path: str, special: bool = True, vocab_size: int = PrepParams().vocab_size
) -> DataFrame:
    """Token bytes, by default with the special tokens added."""
    table = spark.read.schema(VOCABULARY_SCHEMA).parquet(join_path(data_path(spark, path), "vocabulary"))
    return table.union(special_token_rows(spark, vocab_size)) if special else table
