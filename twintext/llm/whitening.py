"""Whitening of vectors by their principal components, with equal vectors done once.

Entries become whole numbers ``x = floor(64 * c) + 1000000``. Rows with equal x
are one *distinct vector* with a weight, the number of its rows; all sums run
over distinct vectors with these weights, or with weight one each
(``weights="one"``). Tasks multiply blocks of centred vectors, scaled by the
weights, with their transposes and send one matrix each; these are summed on
Spark, and only the sum, of bounded size, goes to the driver, where its
eigenvectors are taken once. Distinct vectors are whitened once and joined back
to their rows. A vector with more than a thousandth of all rows is sent to every
task instead, of which there are at most a thousand, so that its rows need not
meet in one.

A null vector, one with a null or non-finite entry or an entry beyond 2^40 takes
no part, nor does one of another length than the most frequent one (of equally
frequent ones the longest; at most ``MOST_LENGTH``). Components without variance, to
double precision, are left out, so equal vectors only, or none, give no rows.
Repeated rows and ids count and are returned as often as they occur; a null id
is an id as others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, ship_package

SCALE, SHIFT = 64, 1_000_000
MOST_LENGTH = 4096  # the covariance of longer vectors does not go to the driver
_LARGEST = 2.0**40  # of an entry
_PIECE = 1 << 14  # vectors multiplied at once
_LEAST_VARIANCE = 1e-11  # of a component, of the largest one: below, doubles do not tell it from none
_HOT = 1000  # vectors with more than a thousandth of all rows: at most so many


def _quantised(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, length, x)``: x as its 64-bit integers in a row; only vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.asarray(lists.value_lengths().fill_null(0)).astype("i8")
            # Without the values that null lists may hide.
            flat = lists.drop_null().flatten()
            entries = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            good = np.abs(entries) <= _LARGEST  # false for NaN
            with np.errstate(invalid="ignore"):
                x = (np.floor(np.where(good, entries, 0) * SCALE)).astype("i8") + SHIFT
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~good)])
            takes = (lengths > 0) & (bad[ends] == bad[ends - lengths])
            data = x.tobytes()
            cells = [data[8 * (e - n) : 8 * e] for e, n in zip(ends[takes], lengths[takes])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(takes)), pa.array(lengths[takes], pa.int64()), pa.array(cells, pa.binary())],
                ["vec_id", "length", "x"],
            )

    plain = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    kind = plain.schema["vec_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"vec_id {kind}, length long, x binary")


def _matrix(column: pa.Array, kind: str, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), kind).reshape(-1, d)


def _exact_sums(distinct: DataFrame, d: int) -> list[int]:
    """Weighted sums of the entries, in whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), "i8", d)
            weight = np.asarray(batch.column("weight")).reshape(-1, 1)
            # Upper and lower halves on their own: neither sum passes 64 bits.
            high, low = (x >> 24), x & ((1 << 24) - 1)
            sums = [(part * weight).sum(axis=0) for part in (high, low)]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), *map(pa.array, sums)], ["dim", "high", "low"])

    parts = distinct.select("x", "weight").mapInArrow(run, "dim int, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    found = {r["dim"]: (int(r["high"]) << 24) + int(r["low"]) for r in parts.groupBy("dim").agg(*wide).collect()}
    return [found[k] for k in range(d)]


def _summed(parts: DataFrame, d: int) -> np.ndarray:
    """The sum of the tasks' matrices, given as rows ``(i, cells)`` of doubles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows[i] = rows.get(i, 0) + np.frombuffer(cells.as_buffer(), "f8")
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())],
                ["i", "cells"],
            )

    # One row of the matrix from every task meet; a task keeps one sum per row.
    out = np.zeros((d, d))
    for row in parts.repartition("i").mapInArrow(run, "i int, cells binary").collect():
        out[row["i"]] += np.frombuffer(row["cells"], "f8")
    return out


def _covariance(vectors: DataFrame, n: int, d: int, kind: str, mean: np.ndarray, scale: int = 1) -> np.ndarray:
    """Covariance, divisor ``n``, of ``(cells, weight)``: entries times ``scale`` less ``mean``, over ``scale``.

    ``mean`` holds whole numbers for whole entries, so that the difference is exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(0, len(batch), _PIECE):
                part = batch.slice(k, _PIECE)
                values = _matrix(part.column(0), kind, d)
                centred = _less(values, scale, mean) / scale
                centred *= np.sqrt(np.asarray(part.column(1)).astype("f8")).reshape(-1, 1)
                total = centred.T @ centred + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "cells"]
            )

    return _summed(vectors.mapInArrow(run, "i int, cells binary"), d) / n


def _less(values: np.ndarray, scale: int, mean: np.ndarray) -> np.ndarray:
    """``scale * values - mean`` in 64-bit integers, or in Python's where these may not hold it."""
    if values.dtype.kind == "i" and len(values):
        bound = max(abs(int(values.max())), abs(int(values.min()))) * scale + max(map(abs, map(int, mean)))
        if bound >= 1 << 62:
            return (values.astype(object) * scale - mean).astype(object)
        return values * np.int64(scale) - mean.astype("i8")
    return values * scale - mean


def _deviations(values: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of squares of ``n * x - S`` by row; none where they pass 64 bits."""
    less = _less(values, n, sums)
    if less.dtype != object and len(less):
        largest = max(abs(int(less.max())), abs(int(less.min())))
        if largest * largest * less.shape[1] < 1 << 63:
            return (less * less).sum(axis=1).tolist()
    out = [sum(int(v) * int(v) for v in row) for row in less]
    return [v if v < 1 << 63 else None for v in out]


@dataclass(frozen=True)
class Whitening:
    """Sizes and sums of the fitted vectors, and their components by falling variance."""

    n: int
    sums: tuple[int, ...]
    variances: np.ndarray
    total: float
    vectors: np.ndarray  # one component to a column


def _fitted(distinct: DataFrame, d: int, components: int) -> Whitening | None:
    n = distinct.agg(F.sum("weight")).first()[0]
    if not n:
        return None
    sums = _exact_sums(distinct, d)
    covariance = _covariance(distinct.select("x", "weight"), n, d, "i8", np.array(sums, object), n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(int((values > max(values[0], 0) * _LEAST_VARIANCE).sum()), components)
    return Whitening(n, tuple(sums), values[:kept].copy(), float(np.trace(covariance)), vectors[:, :kept].copy())


def _whitened(distinct: DataFrame, fit: Whitening, d: int) -> DataFrame:
    """``(x, deviation, z)``: z as doubles in a row."""
    n, sums = fit.n, np.array(fit.sums, object)
    turned = fit.vectors / np.sqrt(fit.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), _PIECE):
                part = batch.slice(k, _PIECE)
                x = _matrix(part.column("x"), "i8", d)
                z = (_less(x, n, sums) / n).astype("f8") @ turned
                columns = [part.column("x"), pa.array(_deviations(x, n, sums), pa.int64()), part.column("weight")]
                cells = pa.array([row.tobytes() for row in z], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, cells], ["x", "deviation", "weight", "z"])

    return distinct.select("x", "weight").mapInArrow(run, "x binary, deviation long, weight long, z binary")


def _identity_error(whitened: DataFrame, n: int, m: int) -> float:
    """The largest difference of the covariance of whitened vectors from the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m)
        for batch in batches:
            total += (_matrix(batch.column(0), "f8", m) * np.asarray(batch.column(1)).reshape(-1, 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(m), pa.int32()), pa.array(total)], ["dim", "total"])

    vectors = whitened.select("z", "weight")
    totals = vectors.mapInArrow(run, "dim int, total double").groupBy("dim").agg(F.sum("total").alias("total"))
    mean = np.array([r["total"] for r in totals.orderBy("dim").collect()]) / n
    return float(np.abs(_covariance(vectors, n, m, "f8", mean) - np.eye(m)).max())


def whitened(
    rows: DataFrame,
    components: int = 32,
    weights: str = "count",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per row and component.

    ``n`` is the sum of the weights, ``deviation`` the exact sum of squares of
    ``n * x - S`` (null beyond 64 bits), ``whitened`` the coordinate on the
    component over its standard deviation, ``explained`` the share of the
    component in the variance, ``identity_error`` the largest entry of the
    whitened vectors' covariance less the identity.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    spark = rows.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "whitening")
    taken = scratch.write(_quantised(rows, vec_id, vector), "rows")
    kind = taken.schema["vec_id"].dataType.simpleString()
    nothing = spark.createDataFrame(
        [],
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
    lengths = taken.where(f"length <= {MOST_LENGTH}").groupBy("length").agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    if usual is None:
        return nothing
    d = usual["length"]
    taken = taken.where(F.col("length") == d)
    grouped = scratch.write(taken.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "distinct")
    weight = F.col("rows") if weights == "count" else F.lit(1).cast("long")
    distinct = grouped.withColumn("weight", weight)
    fit = _fitted(distinct, d, components)
    if fit is None or not len(fit.variances):
        return nothing
    m = len(fit.variances)
    done = scratch.write(_whitened(distinct, fit, d), "whitened")
    error = _identity_error(done, fit.n, m)
    hot = scratch.write(grouped.where(F.col("rows") * _HOT > usual["rows"]).select("x"), "hot")
    named = taken.select("vec_id", "x")
    often, seldom = (done.join(F.broadcast(hot), "x", how) for how in ("left_semi", "left_anti"))
    joined = named.join(F.broadcast(often), "x").unionByName(
        named.join(F.broadcast(hot), "x", "left_anti").join(seldom, "x")
    )
    explained, n, names = fit.variances / fit.total, fit.n, nothing.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), _PIECE):
                part = batch.slice(k, _PIECE)
                size = len(part) * m
                which = pa.array(np.repeat(np.arange(len(part)), m))
                constant = [pa.array(np.full(size, n)), pa.array(np.full(size, error))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(which),
                        pa.array(np.tile(np.arange(1, m + 1, dtype="i4"), len(part))),
                        constant[0],
                        part.column("deviation").take(which),
                        pa.array(_matrix(part.column("z"), "f8", m).reshape(-1)),
                        pa.array(np.tile(explained, len(part))),
                        constant[1],
                    ],
                    names,
                )

    return joined.select("vec_id", "deviation", "z").mapInArrow(run, nothing.schema)
