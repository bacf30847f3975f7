"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_MADE: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which also becomes the checkpoint folder.

    Where it is unset, a local session gets a temporary folder; on a cluster executors wouldn't see it, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    named = (named or tempfile.mkdtemp(prefix="terrace-")).rstrip("/")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system; both are Hadoop's, as only that reaches every store that Spark writes to."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path below this application's folder in the shared one; the folder goes when the application ends."""
    home = f"{shared_folder(spark)}/terrace-tables-{spark.sparkContext.applicationId}"
    if home not in _MADE:
        _MADE.add(home)
        folder, fs = hadoop_path(spark, home)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return f"{home}/{kind}-{uuid.uuid4().hex}"
