"""Where intermediate results that must survive an executor live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_collected: ContextVar[list[str] | None] = ContextVar("collected", default=None)
_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) may fall back to a temporary folder; on a
    cluster such a folder would be on one machine and is refused.
    """
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="tabweave-")
    return _local_fallback[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage now and go on from there, partitioning kept."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was staged under ``path``; nothing happens if it is not there."""
    place, files = _filesystem(spark, path)
    files.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there as a whole or not at all; a file of that name must not exist."""
    place, files = _filesystem(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if files.exists(place) or not files.rename(beside, place):
        files.delete(beside, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    place, files = _filesystem(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if it is not there."""
    place, files = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`stage`, for as long as the block runs; the copy is deleted behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        remove(df.sparkSession, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it from there.

    For frames that are read several times and slow to make; later reads skip unused columns.
    """
    path = scratch_path(df.sparkSession, name)
    if (made := _collected.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """Collects the paths that :func:`stage` makes while the block runs, for a caller that removes them later."""
    made: list[str] = []
    token = _collected.set(made)
    try:
        yield made
    finally:
        _collected.reset(token)
