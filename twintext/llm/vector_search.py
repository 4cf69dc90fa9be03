"""Nearest neighbours by cross-polytope hashing with several probes.

A table of the index rotates unit vectors by three rounds of random signs and a
fast Hadamard transform and files each under the signed axis it lies nearest to.
A query looks into the buckets of its nearest axes in every table; what it finds
there is ranked by the exact distance of the original vectors. Every vector is
in every table. Buckets are the keys of the only shuffle. One that holds many
vectors or queries is cut into blocks of bounded size, and every block of
vectors meets every block of queries of its bucket in a task of its own, which
returns the nearest few for each query: no list of candidates is ever written.

What the tables find need not be enough. A query that found fewer than ``MET``
different vectors for each one it asked for has seen too little around it to be
trusted; it also meets all vectors of its length, through the same blocks, and
its result is exact. So every query has its full number of rows, or all
candidates if there are fewer, whatever the size of the table.

Vectors that are null, empty or zero, or hold null or non-finite components,
take no part, nor do rows with a null id. Vectors are compared with those of
their own length only. Rows that share an id are one item: its nearest vector
counts. Ties go to the smaller id. A query without any candidate has no rows; an
empty table gives none. Only the two named columns are read. Hashing looks at
directions, so the share of true neighbours found is best where lengths differ
little.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, ship_package

TABLES, PROBES = 10, 16
_VECTORS, _QUERIES = 20_000, 4_000  # to a block
MET = 10  # vectors found for each one asked for, below which a query meets all
_SEED = 23


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


@lru_cache
def _signs(size: int, tables: int) -> np.ndarray:
    return np.random.default_rng(_SEED).choice([-1.0, 1.0], (tables, 3, size))


def _rotated(unit: np.ndarray, table: int, tables: int) -> np.ndarray:
    """Pseudo-rotation: signs and a Hadamard transform, three times."""
    size = unit.shape[1]
    for signs in _signs(size, tables)[table]:
        unit = unit * signs
        half = 1
        while half < size:
            pairs = unit.reshape(len(unit), -1, 2, half)
            unit = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            half *= 2
        unit = unit.reshape(-1, size)
    return unit


def _axes(vectors: np.ndarray, table: int, tables: int, probes: int) -> np.ndarray:
    """The nearest signed axes of every vector, nearest first: ``2 i`` and ``2 i + 1`` for axis *i*."""
    n, length = vectors.shape
    size = 1 << max(0, length - 1).bit_length()
    padded = np.zeros((n, size))
    # By the largest component first, as squares of very small or large ones are out of range.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    padded[:, :length] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    turned = _rotated(padded, table, tables)
    if probes == 1:
        axis = np.abs(turned).argmax(axis=1)
        return (2 * axis + (turned[np.arange(n), axis] < 0))[:, None]
    near = np.stack([turned, -turned], axis=2).reshape(n, -1)
    return np.argsort(-near, axis=1, kind="stable")[:, :probes]


def _filed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """``(space, bucket, id, vector)``: rows once per table and probe; ``space`` is the vectors' length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import vector_search as here

        for batch in batches:
            for piece in here.equal_lengths(batch):
                vectors, ids = here.matrix(piece.column(1)), piece.column(0)
                length = vectors.shape[1]
                for table in range(tables):
                    axes = here._axes(vectors, table, tables, probes)
                    row = pa.array(np.repeat(np.arange(len(ids)), axes.shape[1]))
                    bucket = pa.array((table << 40) + axes.reshape(-1).astype("i8"))
                    space = pa.array(np.full(len(row), length, "i4"))
                    yield pa.RecordBatch.from_arrays(
                        [space, bucket, ids.take(row), piece.column(1).take(row)],
                        ["space", "bucket", "id", "vector"],
                    )

    return rows.mapInArrow(run, "space int, bucket long, id long, vector array<double>")


def equal_lengths(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors have one length each."""
    lengths = np.asarray(batch.column(1).value_lengths())
    for length in np.unique(lengths):
        yield batch.filter(pa.array(lengths == length))


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def nearest_in_block(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest items of each query in a block, by exact distance."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(vectors) and len(queries):
        vectors = vectors.sort_by("id")
        base, ids = matrix(vectors["vector"]), vectors["id"].to_numpy()
        # Rows that share an id are one item and take one of the k places.
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        squares = (base**2).sum(axis=1)
        for query, point in zip(queries["id"].to_numpy(), matrix(queries["vector"])):
            # A quick pass leaves a few; rounding cannot hide a nearest one behind the margin.
            rough = squares - 2 * (base @ point) + point @ point
            rough[ids == query] = np.inf
            near = np.flatnonzero(ids != query)
            if len(starts) > k:
                limit = np.partition(np.minimum.reduceat(rough, starts), k - 1)[k - 1]
                margin = 1e-9 * (squares.max() + point @ point)
                # Squares out of range give NaN, which drops nothing.
                near = near[~(rough[near] > limit + margin)]
            score = np.sqrt(((base[near] - point) ** 2).sum(axis=1))
            order = np.lexsort((ids[near], score))
            best = order[np.sort(np.unique(ids[near][order], return_index=True)[1])[:k]]
            found.append((np.full(len(best), query), ids[near][best], score[best]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tables: int = TABLES,
    probes: int = PROBES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: ``k`` vectors for every query, or all if there are fewer, nearest first.

    ``score`` is the Euclidean distance of the original vectors. A query never
    finds vectors with its own id.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "vector-search")

    def chosen(df: DataFrame) -> DataFrame:
        kept = df.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
        return kept.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        from twintext.llm.vector_search import nearest_in_block

        found = nearest_in_block(left, right, k)
        return found.add_column(0, "space", pa.array([key[0].as_py()] * len(found), pa.int32()))

    bucket, key = ["space", "bucket"], ["space", "bucket", "block", "part"]

    def met(base: DataFrame, asked: DataFrame, name: str) -> DataFrame:
        """``(space, query_id, vec_id, score)``: the nearest of each block of a bucket that both have."""
        sizes = (
            base.select(*bucket, F.lit(1).alias("v"), F.lit(0).alias("q"))
            .union(asked.select(*bucket, F.lit(0).alias("v"), F.lit(1).alias("q")))
            .groupBy(*bucket)
            .agg(F.sum("v").alias("v"), F.sum("q").alias("q"))
            .where("v > 0 AND q > 0")
            .select(
                *bucket, F.ceil(F.col("v") / _VECTORS).cast("int").alias("blocks"), F.ceil(F.col("q") / _QUERIES).cast("int").alias("parts"),
            )
        )
        sizes = scratch.write(sizes, f"{name}-sizes")

        def dealt(rows: DataFrame, own: str, own_number: str, all_: str, all_number: str) -> DataFrame:
            """To one of its own blocks, and there to meet all blocks of the other side."""
            return rows.join(sizes, bucket).select(
                *[F.col(c).alias(c) for c in bucket],
                F.pmod(F.xxhash64("id"), F.col(own_number)).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.col(all_number) - 1)).alias(all_),
                F.col("id").alias("id"),
                F.col("vector").alias("vector"),
            )

        blocks = (
            dealt(base, "block", "blocks", "part", "parts")
            .groupBy(*key)
            .cogroup(dealt(asked, "part", "parts", "block", "blocks").groupBy(*key))
            .applyInArrow(run, "space int, query_id long, vec_id long, score double")
        )
        once = blocks.groupBy("space", "query_id", "vec_id").agg(F.min("score").alias("score"))
        return scratch.write(once, name)

    hashed = met(_filed(chosen(vectors), tables, 1), _filed(chosen(queries), tables, probes), "hashed")

    # Queries for which that proves too little meet all vectors of their length, as one bucket.
    def together(df: DataFrame) -> DataFrame:
        return chosen(df).select(F.size("vector").alias("space"), F.lit(-1).cast("long").alias("bucket"), "id", "vector")

    every = together(vectors)
    enough = hashed.groupBy("space", F.col("query_id").alias("id")).count().where(F.col("count") >= MET * k)
    enough = scratch.write(enough.select("space", "id"), "enough")
    rest = together(queries).join(enough, ["space", "id"], "left_anti").select(*bucket, "id", "vector")
    whole = met(every, rest, "whole")

    once = hashed.union(whole).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = once.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
