"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch


def _least(scratch: Scratch, around: DataFrame) -> DataFrame:
    """``(a, least, degree)``: the least node around each node, itself included."""
    least = F.least("a", F.min("b")).alias("least")
    return scratch.write(around.groupBy("a").agg(least, F.count(F.lit(1)).alias("degree")), "least")


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``(a, b)``: every linked node but the least of its component, and that least one.

    ``links`` has two columns ``a`` and ``b`` of one orderable type; nulls and
    loops count for nothing. Large stars, which lead larger neighbours to the
    least node around each node, and small stars, which do so with the others,
    alternate until only stars are left: nodes with a smaller neighbour then have
    no other one. The number of rounds grows with the logarithm of the longest
    path. Every step is written, so that nothing is computed twice and Spark can
    divide the rows of a hot node; no node's neighbours are gathered in one place.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = scratch.write(ordered.distinct(), "links")
    while True:
        around = now.union(now.select("b", "a"))
        least = _least(scratch, around)
        if not least.agg(F.sum(F.when(F.col("least") < F.col("a"), F.col("degree") - 1))).first()[0]:
            scratch.drop(least)
            return now
        large = around.join(least, "a").where("b > a AND b > least")
        after = scratch.write(large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "links")
        for done in (now, least):
            scratch.drop(done)
        least = _least(scratch, after)
        # The node itself is led to the least one, too.
        small = after.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.union(least.select("a", F.col("least").alias("b"))).where("a > b")
        now = scratch.write(small.distinct(), "links")
        for done in (after, least):
            scratch.drop(done)
