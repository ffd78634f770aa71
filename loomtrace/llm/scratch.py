"""Intermediate tables in the folder that the driver and all executors share.

The folder is the one that ``spark.checkpoint.dir`` names; where the setting is
absent, as in tests, the checkpoint folder of the SparkContext is used. With neither,
a session on one machine sets a temporary folder, and a cluster is an error: its
executors would write to their own disks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """URI of the folder that all machines see."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomtrace-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def _path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


class Scratch:
    """Tables of one run of an operator, under one new folder.

    ``keep`` writes a frame as Parquet and gives it back reread, which cuts its
    lineage: a lost executor costs a reread, not a recomputation. ``drop`` frees a
    table that no later step reads. What is left goes when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.uri = f"{shared_folder(spark)}/loomtrace/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.held: dict[str, None] = {}
        files, path = _path(spark, self.uri)
        files.deleteOnExit(path)

    def folder(self, name: str) -> str:
        """URI of a new folder of this run."""
        self.count += 1
        return f"{self.uri}/{self.count}-{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        uri = self.folder(name)
        frame.write.parquet(uri)
        kept = self.spark.read.schema(frame.schema).parquet(uri)
        kept._scratch_uri = uri
        self.held[uri] = None
        return kept

    def drop(self, frame: DataFrame) -> None:
        self.held.pop(frame._scratch_uri, None)
        files, path = _path(self.spark, frame._scratch_uri)
        files.delete(path, True)

    def only(self, *frames: DataFrame) -> None:
        """Frees all tables but those of ``frames``."""
        for uri in [u for u in self.held if u not in {f._scratch_uri for f in frames}]:
            del self.held[uri]
            files, path = _path(self.spark, uri)
            files.delete(path, True)
