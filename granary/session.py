"""Session helpers: the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
_marked: set[str] = set()
_path_class: WeakKeyDictionary[SparkContext, Callable] = WeakKeyDictionary()
_batch_folder: ContextVar[str | None] = ContextVar("batch_folder", default=None)


def hadoop_path(spark: SparkSession, path: str):
    """A path as file systems know it. Its class is looked up once: each part of that name is a call to the JVM."""
    context = spark.sparkContext
    if context not in _path_class:
        _path_class[context] = context._jvm.org.apache.hadoop.fs.Path
    return _path_class[context](path)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that knows it."""
    place = hadoop_path(spark, path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` named.

    A local folder is only made up where all tasks run in the driver's own
    process, as in tests. Elsewhere executors would each write to their own disk,
    so a session without a shared folder is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="granary-")
    return _fallback[app]


def _application_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; the driver's JVM deletes it when it ends."""
    folder = f"{shared_folder(spark)}/granary/{spark.sparkContext.applicationId}"
    if folder not in _marked:
        files, place = hadoop(spark, folder)
        files.mkdirs(place)
        files.deleteOnExit(place)
        _marked.add(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, or under that of the running batch."""
    folder = _batch_folder.get() or _application_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def batch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """Keep what is staged inside in one folder, and delete that at the end."""
    folder = scratch_path(spark, name)
    before = _batch_folder.set(folder)
    try:
        yield folder
    finally:
        _batch_folder.reset(before)
        delete_path(spark, folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors, is computed once however often it is
    used, and has its real size in the file statistics, so Catalyst broadcasts
    it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = hadoop(spark, path)
    files.delete(place, True)


def at_once(*work: Callable[[], object], limit: int = 8) -> list:
    """Run independent steps side by side, so that small jobs do not wait for each other."""
    with ThreadPoolExecutor(max_workers=limit) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, w) for w in work]]
