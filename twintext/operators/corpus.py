"""The training corpus: both sides of every pair as separate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.functions.tokens import to_byte_tokens


def unpivot_corpus(
    pairs: DataFrame, row_id: str = "pair_id", src: str = "src", tgt: str = "tgt"
) -> DataFrame:
    """``(ord, side, text)``: source as side 0, target as side 1, in id order."""
    return pairs.select(
        F.col(row_id).alias("ord"), F.posexplode(F.array(src, tgt)).alias("side", "text")
    )


def text_corpus(df: DataFrame, row_id: str, text: str = "text") -> DataFrame:
    """A one-sided corpus."""
    return df.select(F.col(row_id).alias("ord"), F.lit(0).alias("side"), F.col(text).alias("text"))


def byte_tokens(corpus: DataFrame) -> DataFrame:
    """Replace ``text`` by its token string ``seq``."""
    return corpus.withColumn("seq", to_byte_tokens(F.col("text"))).drop("text")


def collapse_equal(corpus: DataFrame) -> DataFrame:
    """One row per distinct text with its ``weight`` and first place.

    Copies are combined in the map tasks already, so a text that makes up a
    large part of all rows arrives as one row per task. The first place is kept
    as one id per side, as numbers can be aggregated by hashing and structs
    only by sorting all texts.
    """
    first = [F.min(F.when(F.col("side") == s, F.col("ord"))).alias(f"__first{s}") for s in (0, 1)]
    on_source = F.coalesce(F.col("__first0") <= F.col("__first1"), F.col("__first1").isNull())
    return (
        corpus.groupBy("text")
        .agg(F.count(F.lit(1)).alias("weight"), *first)
        .select(
            F.least("__first0", "__first1").alias("ord"),
            F.when(on_source, 0).otherwise(1).alias("side"),
            "weight",
            "text",
        )
    )
