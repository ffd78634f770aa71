"""Logs of workers as a streaming source and sink: ``format("worker_log")``.

A log is a folder with a folder for each worker, which holds segments: Parquet files that
are read in the order of their names. The source's offset is the last segment taken of
each worker; a trigger takes ``segments`` more of each at most. The sink puts one segment
for each worker of a batch, under the batch's number, so a batch that is repeated after a
failure replaces nothing and adds nothing. A task has ``OPEN`` segments open at most: rows that
come in the order of their workers fill one after the other, as ``write_worker_log`` sorts them,
and a worker that comes again in others gets its pieces put together at the end.

Options: ``path``, a folder that the driver and all executors see; ``worker``, the column
of the worker (worker_id); ``order``, columns by which the sink sorts a segment; ``segments`` of a worker in a trigger (all); ``groups``, the
partitions of a trigger (8); ``reader`` and ``writer``, names of the query where several
read or write one log, for each of which the log keeps what it has planned or committed;
``batch``, the number under which a write that is no stream puts its segments (0).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Segments that a task has open at once.
OPEN = 16
#: The folder of rows without a worker; all others begin with ``w=``.
_NOBODY = "nobody"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _replace(files: fs.FileSystem, path: str, body: bytes) -> None:
    """A small file put in one step."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(body)
    files.move(draft, path)


def folder_of(worker: object) -> str:
    return _NOBODY if worker is None else "w=" + quote(str(worker), safe="")


@dataclass
class Segments(InputPartition):
    """Segments of some workers, each worker's in order."""

    paths: tuple[str, ...]


@dataclass
class Staged(WriterCommitMessage):
    """(worker's folder, file) that a task has written."""

    files: tuple[tuple[str, str], ...]


class WorkerLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "worker_log"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(schema, dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _Writer(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchWriter(dict(self.options))


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.uri = schema, options["path"].rstrip("/")
        self.most, self.groups = int(options.get("segments", 0)), int(options.get("groups", 8))
        self.name = options.get("reader", "reader")
        self.planned: dict[str, str] | None = None

    def _there(self) -> dict[str, list[str]]:
        """Names of the segments of each worker, in order."""
        files, path = _store(self.uri)
        found: dict[str, list[str]] = {}
        for info in files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
            folder, name = info.path.split("/")[-2:]
            if info.type == fs.FileType.File and name.endswith(".parquet") and (folder == _NOBODY or folder.startswith("w=")):
                found.setdefault(folder, []).append(name)
        return {k: sorted(v) for k, v in found.items()}

    def _position(self) -> str:
        return f"{_store(self.uri)[1]}/_readers/{quote(self.name, safe='')}.json"

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        if self.planned is None:  # a new start goes on from what the last one planned
            files = _store(self.uri)[0]
            there = files.get_file_info(self._position()).type == fs.FileType.File
            self.planned = json.loads(files.open_input_stream(self._position()).read()) if there else {}
        end = dict(self.planned)
        for worker, names in self._there().items():
            new = [n for n in names if n > end.get(worker, "")]
            if new:
                end[worker] = new[: self.most or None][-1]
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        files, path = _store(self.uri)
        files.create_dir(f"{path}/_readers")
        _replace(files, self._position(), json.dumps(end).encode())
        self.planned = dict(end)
        groups: dict[int, list[str]] = {}
        for worker, names in sorted(self._there().items()):
            mine = [f"{worker}/{n}" for n in names if start.get(worker, "") < n <= end.get(worker, "")]
            if mine:
                groups.setdefault(zlib.crc32(worker.encode()) % self.groups, []).extend(mine)
        return [Segments(tuple(v)) for v in groups.values()] or [Segments(())]

    def read(self, partition: Segments) -> Iterator[pa.RecordBatch]:
        files, path = _store(self.uri)
        names = self.schema.names
        for segment in partition.paths:
            with files.open_input_file(f"{path}/{segment}") as source:
                for batch in pq.ParquetFile(source).iter_batches(columns=names):
                    yield batch.select(names)

    def commit(self, end: dict) -> None:
        """Segments stay; what is planned is known already."""


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.uri, self.worker, self.name = options["path"].rstrip("/"), options.get("worker", "worker_id"), options.get("writer", "writer")
        self.order = [(c, "ascending") for c in options.get("order", "").split(",") if c]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """One staged file for each worker of the task, written as batches come."""
        files, path = _store(self.uri)
        stage = f"{path}/_staged/{uuid.uuid4().hex}"
        files.create_dir(stage)
        open_: dict[str, pq.ParquetWriter] = {}
        pieces: dict[str, list[str]] = {}
        try:
            for batch in iterator:
                workers = batch.column(batch.schema.get_field_index(self.worker))
                for worker in workers.unique().to_pylist():
                    mask = pc.is_null(workers) if worker is None else pc.fill_null(pc.equal(workers, worker), False)
                    folder = folder_of(worker)
                    if folder not in open_:
                        if len(open_) >= OPEN:
                            open_.pop(next(iter(open_))).close()
                        mine = pieces.setdefault(folder, [])
                        mine.append(f"{stage}/more/{len(mine)}-{folder}.parquet" if mine else f"{stage}/{folder}.parquet")
                        if len(mine) == 2:
                            files.create_dir(f"{stage}/more")
                        open_[folder] = pq.ParquetWriter(mine[-1], batch.schema, filesystem=files)
                    open_[folder].write_batch(batch.filter(mask))
        finally:
            for writer in open_.values():
                writer.close()
        for folder, mine in pieces.items():  # what a worker did in one trigger is sorted in one piece
            if self.order or len(mine) > 1:
                rows = pa.concat_tables([pq.read_table(p, filesystem=files, partitioning=None) for p in mine])
                pq.write_table(rows.sort_by(self.order) if self.order else rows, mine[0], filesystem=files)
        return Staged(tuple((folder, mine[0]) for folder, mine in pieces.items()))

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        files, path = _store(self.uri)
        mark = f"{path}/_commits/{quote(self.name, safe='')}-{batchId:012d}"
        staged = sorted(x for m in messages if m is not None for x in m.files)
        if files.get_file_info(mark).type == fs.FileType.NotFound:
            count: dict[str, int] = {}
            for folder, file in staged:
                count[folder] = n = count.get(folder, -1) + 1
                files.create_dir(f"{path}/{folder}")
                # The same name whenever the batch is repeated before its mark is put.
                files.move(file, f"{path}/{folder}/{batchId:012d}-{quote(self.name, safe='')}-{n:06d}.parquet")
            files.create_dir(f"{path}/_commits")
            _replace(files, mark, b"")
        self._drop(messages)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._drop(messages)

    def _drop(self, messages: list[Staged | None]) -> None:
        files = _store(self.uri)[0]
        for stage in {file.rsplit("/", 1)[0] for m in messages if m is not None for _, file in m.files}:
            if files.get_file_info(stage).type == fs.FileType.Directory:
                files.delete_dir(stage)


class _BatchWriter(DataSourceArrowWriter):
    """The sink of one batch of a stream that hands its batches on as frames."""

    def __init__(self, options: dict[str, str]):
        self.sink, self.batch = _Writer(options), int(options.get("batch", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.sink.write(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        self.sink.commit(messages, self.batch)

    def abort(self, messages: list[Staged | None]) -> None:
        self.sink.abort(messages, self.batch)


def read_worker_log(spark: SparkSession, path: str, schema: str | StructType, **options: object) -> DataFrame:
    """A stream of the rows of a log, each worker's in order."""
    spark.dataSource.register(WorkerLog)
    return spark.readStream.format("worker_log").schema(schema).options(path=path, **options).load()


def write_worker_log(rows: DataFrame, path: str, checkpoint: str, worker: str = "worker_id", **options: object):
    """Starts a query that appends a stream's rows to a log; a worker's rows of a trigger are one segment, in the order of ``ts`` and ``seq`` if it has them."""
    rows.sparkSession.dataSource.register(WorkerLog)
    order = [F.asc_nulls_last(c) for c in ("ts", "seq") if c in rows.columns]

    def put(batch: DataFrame, number: int) -> None:
        # A stream cannot be sorted, its batches can: a task then has one worker after the other.
        ordered = batch.repartition(worker).sortWithinPartitions(worker, *order)
        ordered.write.format("worker_log").options(path=path, worker=worker, batch=number, **options).mode("append").save()

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
