"""Tables in versions: small files of state, each put once, and a keyed table of rows that is updated by them.

A version is a file that names the folders of rows it consists of. A writer writes new
folders first and then puts the next version, which fails if another writer was faster;
it then looks again. A writer that dies leaves folders that no version names, and
readers of a version never see a half of another.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loomtrace.sources.shared import file_system

_DIGITS = 20


class Conflict(RuntimeError):
    """Other writers were faster in all attempts."""


class Snapshots:
    """The versions 1, 2, ... of one table below a URI.

    A version is put by a rename that fails where the name is taken, or on one machine by
    a link; the store has to keep that promise, as HDFS and local disks do.
    """

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.uri}/log/{version:0{_DIGITS}d}.json"

    def versions(self) -> list[int]:
        files, path = file_system(self.spark, f"{self.uri}/log")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n[:_DIGITS]) for n in names if len(n) == _DIGITS + 5 and n[:_DIGITS].isdigit())

    def read(self, version: int) -> dict:
        files, path = file_system(self.spark, self._path(version))
        stream = files.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """(version, state), or (0, {}) before the first."""
        there = self.versions()
        return (there[-1], self.read(there[-1])) if there else (0, {})

    def put(self, version: int, state: dict) -> bool:
        """Whether the version was put; not so if it is there already."""
        jvm = self.spark.sparkContext._jvm
        files, target = file_system(self.spark, self._path(version))
        _, draft = file_system(self.spark, f"{self.uri}/log/.{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        try:
            if files.getUri().getScheme() == "file":
                local = lambda p: jvm.java.nio.file.Paths.get(p.toUri())
                jvm.java.nio.file.Files.createLink(local(files.makeQualified(target)), local(files.makeQualified(draft)))
            else:
                kinds = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri()).rename(draft, target, kinds)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        finally:
            files.delete(draft, False)
        return True

    def new_folder(self) -> str:
        return f"{self.uri}/data/{uuid.uuid4().hex}"

    def vacuum(self, keep: int, named, age_seconds: float = 86_400) -> int:
        """Deletes all versions but the last ``keep`` and the folders that none of those names, if older than ``age_seconds``.

        ``named`` gives the folders of a state. The age leaves writers alone that have not put their version yet.
        """
        there = self.versions()
        kept = {f for v in there[-keep:] for f in named(self.read(v))}
        files, path = file_system(self.spark, f"{self.uri}/data")
        gone = 0
        for status in files.listStatus(path) if files.exists(path) else ():
            old = status.getModificationTime() <= (time.time() - age_seconds) * 1000
            if old and not any(f"/data/{status.getPath().getName()}" in f for f in kept):
                gone += files.delete(status.getPath(), True)
        for version in there[:-keep]:
            files.delete(file_system(self.spark, self._path(version))[1], False)
        return gone


class KeyedStore:
    """Rows by key, of which the last counts, in versions; an update rewrites only the buckets of keys that it touches.

    The last row of a key is the one with the greatest ``order``, of equal ones the one whose
    other columns are greatest, so updates give the same rows in any order and twice as
    well as once. With ``gone``, the name of a boolean column, keys whose last row has it set are not read.
    Nulls are keys like others. Rows have the columns of the first update.
    """

    def __init__(self, spark: SparkSession, uri: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64, gone: str | None = None, attempts: int = 20):
        self.spark, self.keys, self.order, self.buckets, self.gone, self.attempts = spark, list(keys), list(order), buckets, gone, attempts
        self.log = Snapshots(spark, uri)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys and c not in self.order]
        picked = rows.groupBy(*self.keys).agg(F.max(F.struct(*self.order, *rest)).alias("_row"))
        return picked.select(*[F.col(c) if c in self.keys else F.col(f"_row.`{c}`").alias(c) for c in rows.columns])

    def _stored(self, state: dict, buckets: Sequence[int] | None = None) -> DataFrame | None:
        folders = [f for b, f in state.get("folders", {}).items() if buckets is None or int(b) in buckets]
        schema = StructType.fromJson(json.loads(state["schema"])) if state else None
        if not folders:
            return self.spark.createDataFrame([], schema) if schema else None
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default."""
        state = self.log.read(version) if version else self.log.latest()[1]
        if not state:
            raise ValueError("nothing has been stored yet")
        rows = self._stored(state)
        return rows.filter(~F.coalesce(F.col(self.gone), F.lit(False))) if self.gone else rows

    def upsert(self, rows: DataFrame, writer: str | None = None, batch: int | None = None) -> int:
        """Puts rows in and gives the version that holds them.

        A ``batch`` of a ``writer`` that is stored already is left out, so a writer that starts again may repeat its last one.
        """
        staged_at, merged, mine = self.log.new_folder(), {}, None
        for _ in range(self.attempts):
            version, state = self.log.latest()
            if writer is not None and state.get("writers", {}).get(writer, -1) >= batch:
                return version
            if mine is None:
                # Written once: another attempt must not ask the source again.
                self._last(rows).withColumn("_bucket", self._bucket()).write.partitionBy("_bucket").parquet(staged_at)
                staged = self.spark.read.schema(StructType([*rows.schema, StructField("_bucket", IntegerType())])).parquet(staged_at)
                mine = sorted(r[0] for r in staged.select("_bucket").distinct().collect())
            folders = state.get("folders", {})
            # What another writer has changed since is merged again, and nothing else.
            stale = [b for b in mine if b not in merged or merged[b][0] != folders.get(str(b))]
            if stale:
                old, target = self._stored(state, stale), self.log.new_folder()
                new = staged.filter(F.col("_bucket").isin(stale)).drop("_bucket")
                both = new if old is None else old.unionByName(new)
                self._last(both).withColumn("_bucket", self._bucket()).write.partitionBy("_bucket").parquet(target)
                merged.update({b: (folders.get(str(b)), f"{target}/_bucket={b}") for b in stale})
            writers = state.get("writers", {}) | ({writer: batch} if writer is not None else {})
            after = {"schema": state.get("schema", rows.schema.json()), "folders": folders | {str(b): merged[b][1] for b in mine}, "writers": writers}
            if self.log.put(version + 1, after):
                files, path = file_system(self.spark, staged_at)
                files.delete(path, True)
                return version + 1
        raise Conflict(f"{self.attempts} attempts lost against other writers")

    def vacuum(self, keep: int = 10, age_seconds: float = 86_400) -> int:
        """Deletes what the last ``keep`` versions do not need; the number of folders that went."""
        return self.log.vacuum(keep, lambda state: state["folders"].values(), age_seconds)

