"""Pairs from text formats, with what cannot be read set aside.

A plain reading turns a damaged line into nulls, and its bytes are lost. Here
every record ends on one of two sides: as a pair, or set aside with its file, the
reason and the record as it stands.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintext.sources.pairs import PAIRS_SCHEMA
from twintext.sources.storage import join_path

_RAW = "__record"
UNREADABLE, WITHOUT_ID, WITHOUT_TEXT = "unreadable", "no id", "no text"
REASONS = (UNREADABLE, WITHOUT_ID, WITHOUT_TEXT)


class Sides(NamedTuple):
    pairs: DataFrame  # (pair_id, src, tgt)
    set_aside: DataFrame  # (file, reason, record)


def _read(spark: SparkSession, path: str, format: str, schema: str, columns: dict[str, str] | None, options: dict) -> DataFrame:
    """``(pair_id, src, tgt, file, record, reason)``: all records of the files."""
    if format not in ("json", "csv"):
        raise ValueError(f"format must be json or csv, not {format!r}")
    if {"mode", "columnNameOfCorruptRecord"} & set(options):
        raise ValueError("mode and columnNameOfCorruptRecord are fixed here")
    names = {"pair_id": "pair_id", "src": "src", "tgt": "tgt", **(columns or {})}
    # A CSV line is tested in all its columns, also where few of them are asked for.
    fixed = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW, "columnPruning": "false"}
    reader = spark.read.schema(f"{schema}, {_RAW} string").options(**options).options(**fixed)
    raw = reader.format(format).load(path)
    read = raw.select(
        F.col(names["pair_id"]).cast("long").alias("pair_id"),
        F.col(names["src"]).cast("string").alias("src"),
        F.col(names["tgt"]).cast("string").alias("tgt"),
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(_RAW), F.to_json(F.struct(*[c for c in raw.columns if c != _RAW]))).alias("record"),
        F.col(_RAW).isNotNull().alias("__unreadable"),
    )
    reason = (
        F.when(F.col("__unreadable"), UNREADABLE)
        .when(F.col("pair_id").isNull(), WITHOUT_ID)
        .when(F.col("src").isNull() | F.col("tgt").isNull(), WITHOUT_TEXT)
    )
    return read.select("pair_id", "src", "tgt", "file", "record", reason.alias("reason"))


def read_sides(
    spark: SparkSession,
    path: str,
    format: str = "json",
    schema: str = PAIRS_SCHEMA,
    columns: dict[str, str] | None = None,
    **options: str,
) -> Sides:
    """The pairs of JSON or CSV files, and the records that are none.

    ``reason`` is ``unreadable`` where a record does not fit the format or a value
    its type; ``record`` is then the line itself. Records that can be read but
    lack the id or a side are ``no id`` and ``no text``, written as JSON. Both
    sides are read from the files when asked for, in one pass each; to have them
    as tables after a single pass, see :func:`store_sides`.
    """
    rows = _read(spark, path, format, schema, columns, options)
    return _sides(rows)


def _sides(rows: DataFrame) -> Sides:
    pairs = rows.where(F.col("reason").isNull()).select("pair_id", "src", "tgt")
    return Sides(pairs, rows.where(F.col("reason").isNotNull()).select("file", "reason", "record"))


def store_sides(
    spark: SparkSession,
    path: str,
    target: str,
    format: str = "json",
    schema: str = PAIRS_SCHEMA,
    columns: dict[str, str] | None = None,
    **options: str,
) -> Sides:
    """As :func:`read_sides`, with the files parsed once.

    One write puts both sides into directories of their own below ``target``,
    which must not hold a table yet; readers of a side skip the other.
    """
    rows = _read(spark, path, format, schema, columns, options)
    kept = F.col("reason").isNull()
    stored = join_path(target, "sides")
    rows.withColumn("record", F.when(~kept, F.col("record"))).withColumn("is_pair", kept).write.partitionBy("is_pair").parquet(stored)
    layout = "pair_id long, src string, tgt string, file string, record string, reason string, is_pair boolean"
    read = spark.read.schema(layout).parquet(stored)
    return Sides(
        read.where(F.col("is_pair")).select("pair_id", "src", "tgt"),
        read.where(~F.col("is_pair")).select("file", "reason", "record"),
    )


def set_aside_report(sides: Sides) -> DataFrame:
    """``(file, reason, n)``: how many records of each file were set aside and why."""
    return sides.set_aside.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
