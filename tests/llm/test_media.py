"""Media archives: exact round trips, ranges, retries and what lost writers leave."""

import hashlib
import json
import os
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtrace.llm import media
from loomtrace.llm import media
from loomtrace.llm.media import MANIFEST, ArchiveReadError, feature, from_png, load, padded, read_member, store, text_media, to_png
from loomtrace.sources.tables import table


def expected(doc_id, text):
    raw = (text or "").encode()
    payload = raw + b" " * (192 - len(raw) if not raw else -len(raw) % 192)
    stored = to_png(raw)
    return (doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(payload))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=800))
def test_images_round_trip(payload):
    samples, n = from_png(to_png(payload))
    assert samples == padded(payload) and samples[:n] == payload and len(samples) % 192 == 0 and samples


def test_other_readers_see_the_same_samples():
    image = pytest.importorskip("PIL.Image")
    import io

    payload = bytes(range(256)) * 9
    assert image.open(io.BytesIO(to_png(payload))).convert("RGB").tobytes() == padded(payload)


def test_documents_and_odd_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = sorted(tuple(r) for r in text_media(docs).collect())
    assert got == sorted(expected(r.doc_id, r.text) for r in docs.collect())
    rows = [(1, None, "x"), (None, "", "y"), (-5, "é" * 100000, "z"), (7, "x" * 192, ""), (7, "x" * 192, ""), (8, "x" * 193, "")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, media string")
    assert sorted((tuple(r) for r in text_media(odd).collect()), key=str) == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert text_media(odd.limit(0)).collect() == []


def test_every_range_size_gives_each_member_once(spark, tmp_path):
    docs = spark.range(200).selectExpr("id as doc_id", "repeat(string(id), int(id)) as text").repartition(3)
    folder = f"file://{tmp_path}/a"
    store(docs, folder)
    with open(tmp_path / "a" / "orphan.zip", "wb") as file:
        file.write(b"what a lost executor left")
    for size in (700, 5000, 1 << 24):
        frame = load(spark, folder, size)
        assert sorted(r.doc_id for r in frame.select("doc_id").collect()) == list(range(200))
    assert load(spark, folder, 700).rdd.getNumPartitions() > 20
    names = {m["archive"] for m in json.load(open(tmp_path / "a" / MANIFEST))}
    assert "orphan.zip" not in names and names <= set(os.listdir(tmp_path / "a"))


class Flaky:
    """A file system whose first opens, or first reads at an offset, fail."""

    def __init__(self, bad):
        self.bad, self.opens = bad, 0

    def open_input_file(self, path):
        self.opens += 1
        if self.opens <= self.bad:
            raise OSError("lost")
        return open(path, "rb")


def test_members_are_retried_alone(tmp_path):
    path = str(tmp_path / "x.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("a", b"one")
        archive.writestr("b", b"two" * 50)
    infos = zipfile.ZipFile(path).infolist()
    files = Flaky(2)
    assert read_member(files, path, infos[1], None, pause=0)[0] == b"two" * 50 and files.opens == 3
    with pytest.raises(ArchiveReadError):
        read_member(Flaky(9), path, infos[0], None, pause=0)
    infos[0].CRC ^= 1
    with pytest.raises(ArchiveReadError):
        read_member(Flaky(0), path, infos[0], None, pause=0)
    assert media.TRIES > 1


def test_archives_end_at_a_size(spark, tmp_path):
    spark.dataSource.register(media.MediaArchive)
    rows = [(i, bytes([i % 256]) * 3000) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, payload binary").coalesce(1)
    frame.write.format("media_archive").option("archive_bytes", 20_000).mode("append").save(str(tmp_path / "a"))
    found = load(spark, str(tmp_path / "a"), range_bytes=7_000).collect()
    assert sorted(r.doc_id for r in found) == list(range(200)) and len({r.archive for r in found}) > 1
