"""Intermediate tables in the shared folder of the cluster.

A staged frame is written once as parquet and read back, so that several passes over it
do not repeat the joins behind it, later scans read only the columns they use, and a lost
executor costs a re-read instead of the whole lineage.

What is staged while a ``Workspace`` is active belongs to it and goes when it is closed; frames that
read it must not be used after that. Without one, staged files stay until the session ends in local mode, and on a cluster until the
folder's lifetime rule removes them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_active: ContextVar[Workspace | None] = ContextVar("workspace", default=None)


@cache
def _local_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"splitmetrics-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get(_SETTING, None)
    local = spark.conf.get("spark.master", "").startswith("local")
    if folder:
        if folder.startswith("file:") and not local:
            warnings.warn(
                f"{_SETTING} is {folder}: every executor has to reach it there", stacklevel=2
            )
        return folder.rstrip("/")
    if not local:
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    return _local_folder(_application(spark))


def _application(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "application")


def new_path(spark: SparkSession, label: str) -> str:
    workspace = _active.get()
    folder = workspace.folder if workspace else _session_folder(spark)
    return f"{folder}/{label}-{uuid4().hex}"


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/splitmetrics/{_application(spark)}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """A folder for what one piece of work stages; ``folder`` defaults to one in the shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or _session_folder(spark)}/work-{uuid4().hex}"
        self.tables: list[str] = []

    @contextmanager
    def active(self) -> Iterator[Workspace]:
        """What is staged in this context goes to this workspace."""
        token = _active.set(self)
        try:
            yield self
        finally:
            _active.reset(token)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
        remove(self.spark, self.folder)


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and return the frame that reads it back."""
    spark = frame.sparkSession
    path = new_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stage_bucketed(frame: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``stage``, in ``buckets`` files by hash of ``key``.

    Frames staged with as many buckets by the same key are joined on it, or grouped by it, where they lie. A bucket is one
    task's work from then on, so the key must not be hot. Spark knows buckets from its catalog alone: the
    files get an entry there, which goes with the workspace.
    """
    spark = frame.sparkSession
    name = f"staged_{label}_{uuid4().hex}"
    if workspace := _active.get():
        workspace.tables.append(name)
    written = frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    written.option("path", new_path(spark, label)).saveAsTable(name)
    return spark.read.table(name)
