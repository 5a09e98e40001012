"""The folder that driver and executors share, and written tables in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_recorders: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. A local master, whose tasks run on this machine,
    gets a temporary one where the session names none; on a cluster that is an error, as executors write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="ionloom-"))
            atexit.register(shutil.rmtree, _own_dir[0], True)
        found = f"file://{_own_dir[0]}"
    if "://" not in found:  # a plain path lies in the cluster's default store, which only its configuration names
        path = spark._jvm.org.apache.hadoop.fs.Path(found)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().replace("file:/", "file:///", 1)
    return found.rstrip("/")


def temporary(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, which goes when the driver ends in good order."""
    name = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path.getParent())
    store.create(path, True).close()  # only what exists can be marked
    store.deleteOnExit(path)
    store.delete(path, False)
    for made in _recorders:
        made.append(name)
    return name


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The temporary paths that are given out inside."""
    _recorders.append(made := [])
    try:
        yield made
    finally:
        _recorders[:] = [r for r in _recorders if r is not made]


def release(spark: SparkSession, paths: list[str], kept: DataFrame) -> list[str]:
    """Delete the temporary ``paths`` that ``kept`` doesn't read, and return the others. Whoever calls this knows that no
    other DataFrame still reads them, as when a step's result is written."""
    names = {name.rsplit("/", 1)[-1] for name in paths}
    read = {part for file in kept.inputFiles() for part in file.split("/") if part in names}
    for name in paths:
        if name.rsplit("/", 1)[-1] not in read:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return [name for name in paths if name.rsplit("/", 1)[-1] in read]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so that lost executors cost no rerun of what led to it."""
    path = temporary(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
