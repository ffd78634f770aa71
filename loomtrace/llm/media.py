"""Media columns: archives of images as a Spark data source.

A payload is stored losslessly as the 8-bit samples of an RGB image, 64 pixels wide,
in a PNG file; the files of a write task go to one ZIP archive. The source
``media_archive`` plans byte ranges of archives, so the driver never lists members;
each task reads its archive's directory, keeps the members that begin in its range
and streams their bytes in bounded Arrow batches. A member that cannot be read, or
whose checksum is wrong, is read again by its offset, alone.

Archives are written under new names and count only once the manifest of the whole
write names them, so what a lost executor leaves behind is never read. Folders are
opened by URI through Arrow's file systems, which the machines must share.
"""

from __future__ import annotations

import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from loomtrace.llm.batches import map_batches
from loomtrace.llm.scratch import Scratch

#: Bytes of a row of pixels: 64 of them, three samples each.
ROW = 192
WIDTH = 64
#: Bytes of an archive that a task reads, and of media in a batch.
RANGE_BYTES, BATCH_BYTES = 16 << 20, 4 << 20
#: Bytes at which an archive ends: each range reads its directory, so that an archive has few ranges.
ARCHIVE_BYTES = 128 << 20
TRIES = 4
MANIFEST = "_MANIFEST.json"
COLUMNS = "doc_id long, archive string, offset long, media binary"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


# --- images -----------------------------------------------------------------


def padded(payload: bytes) -> bytes:
    """``payload`` with bytes 32 up to a positive multiple of ROW."""
    return payload + b" " * (ROW - len(payload) if not payload else -len(payload) % ROW)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """The PNG file whose samples are the padded payload; its comment ``n_bytes`` holds the length before padding."""
    samples = np.frombuffer(padded(payload), np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(samples), ROW + 1), np.uint8)  # each line begins with filter 0
    lines[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 2, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"n_bytes\0" + str(len(payload)).encode()) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> tuple[bytes, int]:
    """(samples, n_bytes) of a file of ``to_png``; ValueError if a checksum or the form is wrong."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, data, n_bytes, size = 8, [], None, None
    while at < len(media):
        (length,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + length]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + length)[0]:
            raise ValueError("a chunk's checksum is wrong")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"tEXt" and body.startswith(b"n_bytes\0"):
            n_bytes = int(body[8:])
        at += 12 + length
    if size is None or size[0] != WIDTH or size[2:] != (8, 2, 0, 0, 0) or n_bytes is None:
        raise ValueError("not an image of this store")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(size[1], ROW + 1)
    if lines[:, 0].any():
        raise ValueError("a filtered line")
    return lines[:, 1:].tobytes(), n_bytes


def feature(samples: bytes) -> str:
    """Height, mean, deviation and entropy of the samples, and a 64-bit hash of bright cells of the picture."""
    values = np.frombuffer(samples, np.uint8)
    counts = np.bincount(values, minlength=256)
    p = counts[counts > 0] / len(values)
    levels = np.arange(256)
    mean = float(counts @ levels) / len(values)
    spread = float(np.sqrt(max(0.0, counts @ (levels.astype(float) ** 2) / len(values) - mean * mean)))
    light = values.reshape(-1, 8, 24).sum(axis=2, dtype=np.int64)  # eight cells across
    rows = np.linspace(0, len(light), 9).astype(int)
    sums = np.concatenate((np.zeros((1, 8), np.int64), np.cumsum(light, axis=0)))
    high = np.maximum(rows[1:], np.minimum(rows[:-1] + 1, len(light)))
    low = np.minimum(rows[:-1], high - 1)
    cells = (sums[high] - sums[low]) / (high - low)[:, None]
    bits = "".join("1" if x else "0" for x in (cells > cells.mean()).ravel())
    return f"h={len(light)};mean={mean:.4f};std={spread:.4f};entropy={float(-(p * np.log2(p)).sum()):.4f};hash={int(bits, 2):016x}"


# --- archives ---------------------------------------------------------------


def _files(uri: str):
    from pyarrow import fs

    if urlparse(uri).scheme:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class ArchiveReadError(OSError):
    """A member could not be read in TRIES tries."""


def read_member(files, path: str, info: zipfile.ZipInfo, opened, tries: int = TRIES, pause: float = 0.2) -> tuple[bytes, object]:
    """(bytes, file) of one member, by its offset; the file is opened anew for each further try."""
    for n in range(tries):
        try:
            if opened is None:
                opened = files.open_input_file(path)
            opened.seek(info.header_offset)
            head = opened.read(30)
            if len(head) < 30 or head[:4] != b"PK\x03\x04":
                raise OSError("no member at this offset")
            name, extra = struct.unpack_from("<HH", head, 26)
            opened.seek(info.header_offset + 30 + name + extra)
            media = opened.read(info.file_size)
            if len(media) != info.file_size or zlib.crc32(media) != info.CRC:
                raise OSError("a member's checksum is wrong")
            return media, opened
        except OSError as error:
            if opened is not None:
                opened.close()
            last, opened = error, None
            if n + 1 < tries:
                time.sleep(pause * 2**n)
    raise ArchiveReadError(f"{path} at {info.header_offset}: {last}")


@dataclass
class ByteRange(InputPartition):
    """The members of an archive that begin from ``start`` to before ``end``."""

    archive: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    """The archives of a task: name, size and number of members of each."""

    archives: list[tuple[str, int, int]]


class MediaReader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int):
        self.folder, self.range_bytes = folder, range_bytes

    def partitions(self) -> list[ByteRange]:
        files, root = _files(self.folder)
        with files.open_input_stream(f"{root}/{MANIFEST}") as file:
            archives = json.loads(file.read())
        ranges = [ByteRange(a["archive"], low, min(low + self.range_bytes, a["size"])) for a in archives for low in range(0, a["size"], self.range_bytes)]
        return ranges or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.archive:
            return
        files, root = _files(self.folder)
        path = f"{root}/{part.archive}"
        with files.open_input_file(path) as file:
            members = [i for i in zipfile.ZipFile(file).infolist() if part.start <= i.header_offset < part.end]
        rows, held, opened = [], 0, None
        try:
            for info in members:
                media, opened = read_member(files, path, info, opened)
                name = info.filename.partition("-")[2].removesuffix(".png")
                rows.append((None if name == "null" else int(name), part.archive, info.header_offset, media))
                held += len(media)
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)
        finally:
            if opened is not None:
                opened.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "archive", "offset", "media"])


class MediaWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, archive_bytes: int):
        self.folder, self.archive_bytes = folder, archive_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _files(self.folder)
        done, archive, stream, name, members = [], None, None, "", 0

        def finish() -> None:
            archive.close()
            done.append((name, stream.tell(), members))
            stream.close()

        for batch in iterator:
            for doc_id, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if archive is not None and stream.tell() >= self.archive_bytes:
                    finish()
                    archive = None
                if archive is None:
                    files.create_dir(root, recursive=True)
                    name, members = f"{uuid.uuid4().hex}.zip", 0
                    stream = files.open_output_stream(f"{root}/{name}")
                    archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                archive.writestr(zipfile.ZipInfo(f"{members:09d}-{'null' if doc_id is None else doc_id}.png"), to_png(payload.as_buffer().to_pybytes()))
                members += 1
        if archive is not None:
            finish()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _files(self.folder)
        files.create_dir(root, recursive=True)
        rows = [{"archive": name, "size": size, "members": members} for m in messages if m is not None for name, size, members in m.archives]
        with files.open_output_stream(f"{root}/{MANIFEST}") as file:
            file.write(json.dumps(rows).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _files(self.folder)
        for m in messages:
            for name, _, _ in m.archives if m is not None else ():
                files.delete_file(f"{root}/{name}")


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)``; option ``range_bytes`` sets the size of partitions, ``archive_bytes`` that at which a writer begins another archive."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)))

    def writer(self, schema, overwrite: bool) -> MediaWriter:
        return MediaWriter(self.options["path"], int(self.options.get("archive_bytes", ARCHIVE_BYTES)))


# --- columns ----------------------------------------------------------------


def store(docs: DataFrame, folder: str) -> None:
    """Write the whole text of each row of ``docs`` (doc_id, text; null: empty) to archives in the new ``folder``."""
    docs.sparkSession.dataSource.register(MediaArchive)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("payload")).write.format("media_archive").mode("append").save(folder)


def load(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, archive, offset, media) of each member that ``store`` wrote."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").option("range_bytes", range_bytes).load(folder)


def described(media: DataFrame) -> DataFrame:
    """The stored bytes decoded again: sizes, digests and features of each row of ``load``."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for item in batch.column("media"):
                stored = item.as_buffer().to_pybytes()
                samples, n_bytes = from_png(stored)
                rows.append((n_bytes, len(samples), sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(stored), sha256(stored).hexdigest(), feature(samples)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_batches(media.select("doc_id", "media"), scan, schema)


def text_media(docs: DataFrame) -> DataFrame:
    """Every text of ``docs`` stored, read back and described; one row for each row.

    Equal texts give equal values. A null or empty text is one line of spaces. Repeated
    rows and null ids are members like any other, a very long text is one member. Other
    columns than doc_id and text are not read, whatever their names. No row: no row.
    """
    scratch = Scratch(docs.sparkSession, "media")
    folder = scratch.folder("archives")
    store(docs, folder)
    return described(load(docs.sparkSession, folder))
