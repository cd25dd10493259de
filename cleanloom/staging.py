"""The folder that driver and executors share, for what a run writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}
_SWEPT: set[str] = set()


def is_local(master: str) -> bool:
    return master.split("[")[0] == "local"


def hadoop(spark: SparkSession, path: str):
    """(the file system of a path, the path) in the JVM"""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def shared_dir(spark: SparkSession) -> str:
    """The application's folder in what driver and executors share, spark.checkpoint.dir; it goes when the application ends.
    Where that is unset, a local session, as in tests, has a temporary folder of our own; on a cluster, whose machines
    would each write to their own disk, it is an error."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not at:
        if not is_local(context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = _OWN.setdefault("dir", tempfile.mkdtemp(prefix="cleanloom-"))
    path = f"{at.rstrip('/')}/cleanloom-{context.applicationId}"
    if path not in _SWEPT:
        files, to = hadoop(spark, path)
        files.mkdirs(to)
        files.deleteOnExit(to)  # by the driver's JVM, when it ends, whatever has become of Python
        _SWEPT.add(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    files, at = hadoop(spark, path)
    files.delete(at, True)
