"""Sentence pairs and their splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twintext.params import SPLITS
from twintext.sources.storage import data_path

PAIRS_SCHEMA = "pair_id long, src string, tgt string"
_RANGE_BITS = 8  # 256 turn numbers to a range that one task puts in order
FORMATS = ("parquet", "orc", "json", "csv")


def read_pairs(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: str = PAIRS_SCHEMA,
    columns: dict[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Pairs as ``(pair_id, src, tgt)`` from files on any Hadoop file system.

    The schema is given, never inferred. ``columns`` maps the three names to
    those in the files. Columnar files may hold the sides as ``binary``: the
    bytes are then taken over as they are, to be tested for validity.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    names = {"pair_id": "pair_id", "src": "src", "tgt": "tgt", **(columns or {})}
    raw = spark.read.schema(schema).options(**options).format(format).load(path)
    return raw.select(
        F.col(names["pair_id"]).cast("long").alias("pair_id"),
        F.col(names["src"]).cast("string").alias("src"),
        F.col(names["tgt"]).cast("string").alias("tgt"),
    )


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs of a user turn and the turn that comes next, if it is the assistant's.

    Turn numbers may have gaps. ``pair_id`` is the conversation's id times a
    stride plus the turn; the stride is the power of ten above the largest turn,
    1000 at least, so ids never meet. Negative turn numbers are refused. A row
    without a conversation or a turn number is in no pair.

    A conversation is put in order in ranges of 256 turn numbers, each on its
    own, and the edge of a range, its first row, is carried over to the last row
    of the range before. So a conversation with a third of all rows is spread
    over tasks; ranges are looked for without texts, and only texts of edges
    are read again, in conversations that have more than one range.
    """
    turns = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    low, high = turns.agg(F.min("turn"), F.max("turn")).first()
    if low is not None and low < 0:
        raise ValueError("turn numbers must not be negative")
    stride = 10 ** max(3, len(str(high or 0)))
    here = ["conv_id", "__range"]
    turns = turns.select("conv_id", "turn", "role", "text", F.shiftright("turn", _RANGE_BITS).alias("__range"))
    order = Window.partitionBy(*here).orderBy("turn", "role", "text")
    following = turns.select(
        *here,
        "turn",
        "role",
        F.col("text").alias("src"),
        F.lead(F.struct("role", "text")).over(order).alias("__next"),
    )
    edges = _edges(turns)
    following = following.join(edges, here, "left").withColumn("__next", F.coalesce("__next", "__edge"))
    return following.where("role = 'user' AND __next.role = 'assistant'").select(
        (F.col("conv_id") * stride + F.col("turn")).alias("pair_id"), "src", F.col("__next.text").alias("tgt")
    )


def _edges(turns: DataFrame) -> DataFrame:
    """``(conv_id, __range, __edge)``: the first row of the next range of the conversation."""
    ranges = turns.select("conv_id", "__range").distinct()
    after = F.lead("__range").over(Window.partitionBy("conv_id").orderBy("__range"))
    steps = ranges.select("conv_id", F.col("__range").alias("__from"), after.alias("__range")).where("__range IS NOT NULL")
    first = F.min(F.struct("turn", "role", "text")).alias("first")
    firsts = turns.join(steps, ["conv_id", "__range"]).groupBy("conv_id", F.col("__from").alias("__range")).agg(first)
    return firsts.select("conv_id", "__range", F.struct("first.role", "first.text").alias("__edge"))


def write_splits(pairs: DataFrame, path: str, split: str = "split") -> None:
    """One table with a directory per split."""
    pairs.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    """The rows of one split; the other directories are not read."""
    if name not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, not {name!r}")
    return spark.read.parquet(data_path(spark, path)).where(_is(split, name))


def _is(split: str, name: str) -> Column:
    return F.col(split) == name
