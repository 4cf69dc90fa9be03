"""Epoch rollups of a metric log that grows while a model is trained.

The log is a directory to which files are appended. The stream keeps a sum, a
count and the first and last step per tag and epoch, in state that is written to
the checkpoint. The epoch is the event time: an epoch is closed, appended to the
rollup and taken out of the state once the log has gone ``late_epochs`` beyond
it. So the state holds the open epochs only, however long the training is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twintext.operators.evaluate import metric_rollup

LOG_SCHEMA = "tag string, epoch int, batch int, value double"
_TIME = "__time"
_STATE_PARTITIONS = 8
_START = 1 << 32  # seconds; nothing may come before the first watermark, which is zero


def stream_log(
    spark: SparkSession,
    path: str,
    schema: str = LOG_SCHEMA,
    files_per_batch: int | None = None,
    state_partitions: int = _STATE_PARTITIONS,
) -> DataFrame:
    """The entries of a log of Parquet files as they appear in a directory.

    Every micro-batch writes each partition of the state, which holds a few rows
    per open epoch. So the stream has a session of its own, whose number of
    partitions follows the state and not the tables of the caller's session. The
    first start of a checkpoint fixes the number.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", state_partitions)
    reader = own.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def streamed_rollup(
    log: DataFrame, batches_per_epoch: int, keys: Sequence[str] = ("tag",), late_epochs: int = 1
) -> DataFrame:
    """:func:`metric_rollup` of a stream, a row per key and closed epoch.

    An epoch is closed when an entry ``late_epochs`` or more after it has been
    seen in an earlier micro-batch; entries that come for it later are dropped.
    Entries without an epoch are never closed, so they give no row.
    """
    if late_epochs < 0:
        raise ValueError("late_epochs must not be negative")
    at = F.timestamp_seconds(F.col("epoch").cast("long") + _START)
    timed = log.withColumn(_TIME, at).withWatermark(_TIME, f"{late_epochs} seconds")
    return metric_rollup(timed, batches_per_epoch, (*keys, _TIME)).drop(_TIME)


def append_log(entries: DataFrame, path: str) -> None:
    """Add entries ``(tag, epoch, batch, value)`` to a log."""
    entries.select(
        F.col("tag").cast("string"), F.col("epoch").cast("int"), F.col("batch").cast("int"), F.col("value").cast("double")
    ).write.mode("append").parquet(path)


def end_log(spark: SparkSession, path: str, last_epoch: int, late_epochs: int = 1) -> None:
    """Mark the end of a log, so that its last epochs are closed too.

    The mark is an entry without a tag, so far ahead that all epochs up to
    ``last_epoch`` are closed; it stays open itself and is in no rollup.
    """
    append_log(spark.createDataFrame([(None, last_epoch + late_epochs + 1, None, None)], LOG_SCHEMA), path)


def write_rollup_stream(rollup: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed epochs to a Parquet table, each exactly once; ends when all files are read.

    Started again with the same checkpoint it goes on where it ended: files that
    were read are not read again, and open epochs come from the stored state.
    """
    return (
        rollup.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
