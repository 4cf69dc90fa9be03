"""Exact positions in a total order without a single-task sort.

Everything here works on a *key*: a fixed-width lower-case hex string whose
string order is the wanted order (:func:`twintext.functions.text.order_key` or
:func:`~twintext.functions.text.numeric_key`). Key prefixes cut the rows into
ranges, and row counts per range turn a position in a range into a global one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 3  # hex digits per refinement: at most 4096 counts per wanted position
_FINISH = 100_000  # a range of at most this many rows is looked at key by key
_BUCKET_DIGITS = 4  # 65,536 ranges for whole orderings


def keys_at_ranks(
    df: DataFrame, key: Column, ranks: Callable[[int], Sequence[int]]
) -> tuple[int, list[str | None]]:
    """Row count, and for every rank *r* the largest of the *r* smallest keys.

    ``ranks`` maps the row count to the wanted ranks. A rank of 0 gives
    ``None``; ranks past the end are clamped. ``key <= result`` then holds for
    exactly *r* rows, so cutting a table at counts is a plain filter: only
    bounded histograms of the keys reach the driver and no row is shuffled.

    Each step reads the key column only and narrows the range by 4096, so
    10^12 rows need three steps. Equal keys cannot be told apart; a cut that
    would have to divide them is refused.
    """
    keys = df.select(key.alias("key"))
    histogram = _prefix_counts(keys, [""], _DIGITS)
    total = sum(n for _, n in histogram)
    wanted = [max(0, min(r, total)) for r in ranks(total)]
    # Per wanted rank: the range that holds it and the rank inside that range.
    open_ranges = {i: ("", r) for i, r in enumerate(wanted) if r > 0}
    found: list[str | None] = [None] * len(wanted)
    width = 0
    while open_ranges:
        width += _DIGITS
        leaves: dict[int, tuple[str, int]] = {}
        narrowed: dict[int, tuple[str, int]] = {}
        for i, (prefix, rank) in open_ranges.items():
            child, rest, size = _descend(histogram, prefix, rank)
            if size <= _FINISH or len(child) < width:
                leaves[i] = (child, rest)
            else:
                narrowed[i] = (child, rest)
        if leaves:
            counts = _key_counts(keys, {p for p, _ in leaves.values()})
            for i, (prefix, rank) in leaves.items():
                found[i], rest, size = _descend(counts, prefix, rank)
                if rest != size:
                    raise ValueError(f"order key {found[i]} is not unique: cannot cut {size} equal rows")
        open_ranges = narrowed
        if open_ranges:
            prefixes = sorted({p for p, _ in open_ranges.values()})
            histogram = _prefix_counts(keys, prefixes, width + _DIGITS)
    return total, found


def _under(prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col("key").startswith(p) for p in prefixes])


def _prefix_counts(keys: DataFrame, prefixes: Sequence[str], width: int) -> list[tuple[str, int]]:
    rows = keys if list(prefixes) == [""] else keys.where(_under(prefixes))
    counted = rows.groupBy(F.substring("key", 1, width).alias("prefix")).count()
    return sorted((r["prefix"], r["count"]) for r in counted.collect())


def _key_counts(keys: DataFrame, prefixes: set[str]) -> list[tuple[str, int]]:
    counted = keys.where(_under(sorted(prefixes))).groupBy("key").count()
    return sorted((r["key"], r["count"]) for r in counted.collect())


def _descend(counts: list[tuple[str, int]], prefix: str, rank: int) -> tuple[str, int, int]:
    """The entry under ``prefix`` that holds ``rank`` (1-based), the rank in it, its size."""
    for value, size in counts:
        if not value.startswith(prefix):
            continue
        if rank <= size:
            return value, rank, size
        rank -= size
    raise RuntimeError("rows changed between two passes over the keys")


def with_ordinal(
    df: DataFrame, key: Column, ordinal: str = "ordinal", total: str | None = None
) -> DataFrame:
    """Add the 0-based position of every row in ``key`` order.

    Rows are numbered inside 65,536 key ranges and shifted by the number of
    rows in earlier ranges. The shifts are at most 65,536 rows, so they can be
    summed up in one task and broadcast whatever the table size. One shuffle,
    by range; nothing depends on physical partition ids, so recomputed tasks
    give the same numbers. Meant for uniform keys (``order_key``).
    """
    bucket = F.substring(key, 1, _BUCKET_DIGITS)
    sizes = df.select(bucket.alias("__bucket")).groupBy("__bucket").agg(
        F.count(F.lit(1)).alias("__size")
    )
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "__bucket",
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(whole).alias("__total"),
    )
    within = Window.partitionBy("__bucket").orderBy("__key")
    columns = [F.col(c) for c in df.columns]
    numbered = (
        df.withColumns({"__key": key, "__bucket": bucket})
        .withColumn("__row", F.row_number().over(within))
        .join(F.broadcast(offsets), "__bucket")
    )
    extra = [(F.col("__before") + F.col("__row") - 1).cast("long").alias(ordinal)]
    if total:
        extra.append(F.col("__total").cast("long").alias(total))
    return numbered.select(*columns, *extra)
