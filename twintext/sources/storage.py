"""Paths, published tables and intermediate tables on any Hadoop file system."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def join_path(base: str, *parts: str) -> str:
    """Append to a path or URI; the scheme is left alone."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def ensure_directory(spark: SparkSession, path: str) -> str:
    """Create a directory with its parents, wherever the URI points; return it."""
    fs, target = _hadoop(spark, path)
    fs.mkdirs(target)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def fingerprint(df: DataFrame) -> dict[str, str]:
    """Tells tables with other rows apart, whatever the order of rows: one scan, no shuffle."""
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    n, total, mixed = df.agg(
        F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(row, F.lit(1)))
    ).first()
    return {"rows": str(n), "sum": str(total), "mixed": str(mixed), "columns": df.schema.simpleString()}


_MANIFEST = "manifest.json"


def _read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, target = _hadoop(spark, join_path(path, _MANIFEST))
    if not fs.exists(target):
        return None
    return json.loads(spark.read.text(target.toString(), wholetext=True).first()[0])


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files under a directory with their lengths."""
    fs, target = _hadoop(spark, path)
    base, found = fs.makeQualified(target).toString().rstrip("/") + "/", {}
    listed = fs.listFiles(target, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString().removeprefix(base)
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            found[name] = status.getLen()
    return found


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether a table was published at ``path``."""
    return _read_manifest(spark, path) is not None


def data_path(spark: SparkSession, path: str) -> str:
    """Where the files of a published table lie; ``path`` itself if it holds a plain table.

    The manifest alone says which files belong to a table; if any of them is
    missing or has another length, the table is refused.
    """
    manifest = _read_manifest(spark, path)
    if manifest is None:
        return path
    data = join_path(path, manifest["data"])
    if _files(spark, data) != manifest["files"]:
        raise ValueError(f"{path} does not hold the files that its manifest names")
    return data


def publish_once(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    made_with: dict | None = None,
    made_from: dict | None = None,
) -> str:
    """Let ``write`` fill a directory and publish it at ``path``, unless that was done; return where it lies.

    Files are written to a directory of their own. The manifest, which names
    them together with the parameters and the fingerprint of the input, is put
    in place last, by a rename that does not replace another one. So a run that
    stops earlier leaves nothing that is read, and of two writers one publishes
    its whole table, which the other then reads. A published table made with
    other parameters or from other rows is refused.
    """
    wanted = json.loads(json.dumps({"made_with": made_with, "made_from": made_from}))
    manifest = _read_manifest(spark, path)
    if manifest is None:
        name = f"data-{uuid.uuid4().hex}"
        data = join_path(path, name)
        write(data)
        if not _publish(spark, path, {"data": name, "files": _files(spark, data), **wanted}):
            delete_path(spark, data)
        manifest = _read_manifest(spark, path)
    if manifest["made_with"] != wanted["made_with"]:
        raise ValueError(f"{path} was made with other parameters; use another folder")
    if manifest["made_from"] != wanted["made_from"]:
        raise ValueError(f"{path} was made from other rows; use another folder")
    return data_path(spark, path)


def _publish(spark: SparkSession, path: str, manifest: dict) -> bool:
    """Put a manifest in place; false if there is one."""
    fs, staged = _hadoop(spark, join_path(path, f"_{uuid.uuid4().hex}.json"))
    stream = fs.create(staged, False)
    stream.write(json.dumps(manifest, sort_keys=True).encode())
    stream.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(join_path(path, _MANIFEST))
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        if not is_published(spark, path):
            raise error
        fs.delete(staged, False)
        return False
    return True


def materialize_once(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    made_with: dict | None = None,
    made_from: dict | None = None,
) -> DataFrame:
    """Read the table published at ``path``, computing it first if there is none.

    See :func:`publish_once`; a directory without a manifest holds no table.
    """

    def write(data: str) -> None:
        build().write.partitionBy(*partition_by).parquet(data)

    return spark.read.parquet(publish_once(spark, path, write, made_with, made_from))


def shared_directory(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Sessions whose tasks run in the driver's own process get a temporary folder
    if it is unset, as in tests; all others have to name one that executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="twintext-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


class Snapshots:
    """Successive versions of one intermediate table.

    Writing a version cuts the lineage: later jobs, and tasks rerun after a
    lost executor, start from the files. Only the latest version is kept.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._base = join_path(shared_directory(spark), f"twintext-{uuid.uuid4().hex}")
        self._version = 0
        self._path: str | None = None

    def write(self, df: DataFrame, *partitions: str) -> DataFrame:
        path = join_path(self._base, f"v{self._version}")
        df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
        if self._path:
            delete_path(self._spark, self._path)
        self._version += 1
        self._path = path
        return self._spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        if self._path:
            delete_path(self._spark, self._base)
            self._path = None
