"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import SparkSession

#: Hadoop's names of a scheme, and Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system and the path in it for a path as Spark takes it; one without a scheme is local."""
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return pafs.FileSystem.from_uri(f"file://{uri.removeprefix('file:')}")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where none is set and all runs on one machine."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='riverlog-')}"
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def drop(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone by now
        pass


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    atexit.register(drop, spark, path)
    return path
