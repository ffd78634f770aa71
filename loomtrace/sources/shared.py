"""The folder for checkpoints and tables of a session that all machines of a cluster share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_checkpoints(spark: SparkSession) -> None:
    """Sets the folder of ``spark.checkpoint.dir`` where the session has none; a temporary one on one machine only, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loomtrace-"))


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the shared one, deleted when the session ends."""
    ensure_checkpoints(spark)
    above = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    uri = f"{above.rstrip('/')}/loomtrace/{name}-{uuid.uuid4().hex}"
    files, path = file_system(spark, uri)
    files.deleteOnExit(path)
    return uri


def file_system(spark: SparkSession, uri: str):
    """(file system, path) of a URI."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
