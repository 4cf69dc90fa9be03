"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import io
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twintext.sources.storage import delete_path, join_path, shared_directory

WHITE = "\\x20\\x09-\\x0D"  # the white space of the word and line definitions
_WORD_GAPS = f"[{WHITE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python tasks of this application import this package.

    Its sources go to the shared folder as one archive, which Spark hands to the
    executors; what a task compiles once then stays in its worker's modules.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    path = join_path(shared_directory(spark), f"{package.name}-{uuid.uuid4().hex}.zip")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    stream = fs.create(target)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """``array<string>`` of the runs of characters that are not white space; null: empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _WORD_GAPS), "")


class Scratch:
    """Intermediate tables in the folder that all executors share.

    Writing a table cuts the lineage: what reads it starts from files that
    outlive any executor. Tables are dropped when they are superseded, the rest
    when the driver's process ends, as a lazily read result still needs them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = join_path(shared_directory(spark), f"{name}-{uuid.uuid4().hex}")
        self._tables = 0
        atexit.register(self._close)

    def path(self, name: str) -> str:
        self._tables += 1
        return join_path(self.base, f"{self._tables:04d}-{name}")

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that :meth:`write` returned and nothing reads any more."""
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if self.base.split(":", 1)[-1].lstrip("/") in folder:
                delete_path(self.spark, folder)

    def _close(self) -> None:
        try:
            delete_path(self.spark, self.base)
        except Exception:  # the session has ended; the folder is the cluster's to clean
            pass
