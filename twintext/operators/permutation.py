"""Epoch orders as arithmetic on stored positions.

Rows are numbered once. After that the order of every epoch is a keyed
bijection of the positions, so a row's place in it follows from the row alone:
no epoch sorts or shuffles the table. The bijection also runs backwards, which
gives the stored positions of a chosen batch, and so the files that hold them,
without looking at any row.

A position is a cell of a grid of nearly square shape with at least as many
cells as rows. Rounds add to one coordinate a keyed function of the other,
which permutes the grid whatever the function is. A row that lands on a cell
beyond the last row goes on until it lands on one that is not (*cycle walking*);
as its walk began among the rows, it ends among them, and no two rows meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from math import isqrt, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.functions.text import order_key
from twintext.operators.order import with_ordinal
from twintext.params import PrepParams

_DEFAULTS = PrepParams()
_ROUNDS = 4  # each of them moves both coordinates
_PRIME = 2**31 - 1  # products of two remainders stay below 2^62
_CHANCE = 1e-30  # that some row needs more steps than are made; it would be an error, never a wrong place


@dataclass(frozen=True)
class Permutation:
    """A bijection of 0 ... ``total - 1``, one for every seed and epoch."""

    total: int
    seed: int
    epoch: int

    @property
    def shape(self) -> tuple[int, int]:
        """Rows and columns of the grid; less than a column is left over."""
        high = max(1, isqrt(max(0, self.total - 1)) + 1)
        return high, max(1, -(-self.total // high))

    @property
    def keys(self) -> list[tuple[int, int]]:
        """The two keys of every round."""

        def key(i: int) -> int:
            digest = hashlib.md5(f"{self.seed}:{self.epoch}:{i}".encode()).hexdigest()
            return int(digest[:8], 16) % _PRIME

        return [(key(2 * i), key(2 * i + 1)) for i in range(_ROUNDS)]

    @property
    def steps(self) -> int:
        """Steps after which every row is among the rows again."""
        high, low = self.shape
        left_over = high * low - self.total
        if left_over <= 0:
            return 1
        if left_over < 64:
            return left_over + 1  # a walk meets each cell beyond the rows once at most
        return 1 + min(left_over, int(log(_CHANCE / self.total) / log(left_over / (high * low))) + 1)

    def __post_init__(self) -> None:
        if max(self.shape) > _PRIME:
            raise ValueError("too many rows")

    def forward(self, position: Column) -> Column:
        """The place of a stored position in the epoch."""
        high, low = self.shape
        rounds = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in self.keys])

        def whole(x: Column) -> Column:
            start = F.struct(_div(x, low).alias("l"), F.pmod(x, _long(low)).alias("r"))

            def turn(cell: Column, key: Column) -> Column:
                left = F.pmod(cell["l"] + _mixed(cell["r"], key["a"]), _long(high))
                return F.struct(left.alias("l"), F.pmod(cell["r"] + _mixed(left, key["b"]), _long(low)).alias("r"))

            return F.aggregate(rounds, start, turn, lambda cell: cell["l"] * _long(low) + cell["r"])

        place = whole(position.cast("long"))
        if self.steps > 1:
            again = F.sequence(F.lit(2), F.lit(self.steps))
            place = F.aggregate(again, place, lambda x, _: F.when(x < self.total, x).otherwise(whole(x)))
        failed = F.raise_error(F.lit("a walk of the permutation is too long")).cast("long")
        named = F.transform(F.array(place), lambda x: F.when(x < self.total, x).otherwise(failed))
        return F.get(named, F.lit(0))

    def backward(self, places: Sequence[int]) -> list[int]:
        """The stored positions at some places of the epoch."""
        return [self._back(p) for p in places]

    def _back(self, place: int) -> int:
        high, low = self.shape
        if not 0 <= place < self.total:
            raise ValueError(f"no place {place} among {self.total}")
        while True:
            left, right = divmod(place, low)
            for a, b in reversed(self.keys):
                right = (right - _mix(left, b)) % low
                left = (left - _mix(right, a)) % high
            place = left * low + right
            if place < self.total:
                return place


def _mix(x: int, key: int) -> int:
    x = (x + key) % _PRIME
    return x * x % _PRIME * x % _PRIME


def _mixed(x: Column, key: Column) -> Column:
    """:func:`_mix` of a column; the sum is written out three times, as an expression has no names."""
    x, prime = F.pmod(x + key, _long(_PRIME)), _long(_PRIME)
    return F.pmod(F.pmod(x * x, prime) * x, prime)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, _long(by))


def store_positions(
    df: DataFrame,
    path: str,
    row_id: str = "pair_id",
    params: PrepParams = _DEFAULTS,
    rows_per_part: int = 1_000_000,
) -> int:
    """Store the rows with a ``position`` from 0 without gaps; returns their number.

    The table is divided by ranges of positions, ``part``, so that the place of
    a row says in which directory it lies. Shuffled here, once, for all epochs.
    """
    placed = with_ordinal(df, order_key(F.col(row_id), params.seed, "stored"), "position")
    parted = placed.withColumn("part", _div(F.col("position"), rows_per_part))
    parted.repartitionByRange("part").write.partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(parted.schema).parquet(path).count()


def permuted_epoch(
    stored: DataFrame, total: int, epoch: int, params: PrepParams = _DEFAULTS, ordinal: str = "ordinal"
) -> DataFrame:
    """Add each stored row's position in the order of one epoch, without a shuffle."""
    return stored.withColumn(ordinal, Permutation(total, params.seed, epoch).forward(F.col("position")))


def permuted_batches(stored: DataFrame, total: int, epoch: int = 0, params: PrepParams = _DEFAULTS) -> DataFrame:
    """Add ``batch_id`` and ``slot``, without a shuffle; a short last group is dropped."""
    size = params.batch_size
    placed = permuted_epoch(stored, total, epoch, params, "__ordinal")
    return (
        placed.where(F.col("__ordinal") < total - total % size)
        .withColumns({"batch_id": _div(F.col("__ordinal"), size), "slot": F.pmod("__ordinal", _long(size)).cast("int")})
        .drop("__ordinal")
    )


def read_batches(
    stored: DataFrame,
    total: int,
    batch_ids: Sequence[int],
    epoch: int = 0,
    params: PrepParams = _DEFAULTS,
    rows_per_part: int = 1_000_000,
) -> DataFrame:
    """Some batches of an epoch; only the directories that hold their rows are read.

    ``rows_per_part`` is that of :func:`store_positions`. The stored positions
    are worked out backwards from the places of the batches.
    """
    size = params.batch_size
    chosen = [b for b in sorted(set(batch_ids)) if 0 <= b < total // size]
    found = Permutation(total, params.seed, epoch).backward([b * size + k for b in chosen for k in range(size)])
    parts = sorted({x // rows_per_part for x in found})
    there = stored.where(F.col("part").isin(parts) & F.col("position").isin(found))
    return permuted_batches(there, total, epoch, params)
