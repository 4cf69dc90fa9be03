"""Tables of encoded pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOKEN_PAIRS_SCHEMA = "pair_id long, src_tokens array<int>, tgt_tokens array<int>, split string"


def write_token_pairs(token_pairs: DataFrame, path: str) -> None:
    """One directory per split."""
    token_pairs.write.mode("overwrite").partitionBy("split").parquet(path)


def read_token_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKEN_PAIRS_SCHEMA).parquet(path)
