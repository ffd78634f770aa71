"""The worker log: stream equals batch, bounded triggers, restart in the middle of a batch, batches committed once."""

import pyarrow as pa
import pytest

from loomtrace.streaming.worker_log import WorkerLog, _Writer, folder_of, read_worker_log, write_worker_log

ROW = "worker_id string, ts long, seq long, reward double"


def rows_of(frame):
    return sorted((r.worker_id or "", r.ts, r.seq, r.reward) for r in frame.collect())


@pytest.fixture()
def log(spark, tmp_path):
    """A log that a sink wrote in three batches, and the rows in it."""
    rows = [(f"w/{i % 5}" if i % 5 else None, i, i, i / 2) for i in range(90)]
    for n in range(3):
        spark.createDataFrame(rows[n * 30 : (n + 1) * 30], ROW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    write_worker_log(stream, str(tmp_path / "log"), str(tmp_path / "sink")).awaitTermination()
    return str(tmp_path / "log"), sorted((w or "", *r) for w, *r in rows)


def start(spark, path, tmp_path, name, each):
    stream = read_worker_log(spark, path, ROW, segments=1, groups=3, reader=name)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()


def test_stream_equals_batch_in_bounded_triggers(spark, tmp_path, log):
    path, rows = log
    sizes, target = [], str(tmp_path / "out")

    def each(batch, number):
        sizes.append(batch.count())
        batch.write.mode("overwrite").parquet(f"{target}/{number}")

    for _ in range(5):
        start(spark, path, tmp_path, "r", each).awaitTermination()
    assert rows_of(spark.read.schema(ROW).parquet(f"{target}/*")) == rows
    # Five workers, a segment of six rows each: no trigger took more.
    assert [n for n in sizes if n] == [30, 30, 30]


def test_a_restart_in_the_middle_repeats_and_loses_nothing(spark, tmp_path, log):
    path, rows = log
    target, failed = str(tmp_path / "out"), []

    def each(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/{number}")
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("killed")

    for _ in range(6):
        query = start(spark, path, tmp_path, "r", each)
        try:
            query.awaitTermination()
        except Exception as error:  # the second trigger dies once
            assert "killed" in str(error)
    assert failed == [1] and rows_of(spark.read.schema(ROW).parquet(f"{target}/*")) == rows


def test_a_batch_is_committed_once(tmp_path):
    options = {"path": str(tmp_path / "log")}
    batch = pa.RecordBatch.from_pylist([{"worker_id": "a", "x": 1}, {"worker_id": None, "x": 2}, {"worker_id": "a", "x": 3}])
    for number, times in ((0, 2), (1, 1)):
        for _ in range(times):
            writer = _Writer(options)
            writer.commit([writer.write(iter([batch])), None], number)
    writer = _Writer(options)
    writer.abort([writer.write(iter([batch]))], 2)
    names = sorted(str(p.relative_to(tmp_path / "log")) for p in (tmp_path / "log").rglob("*.parquet"))
    assert names == [f"{f}/{n:012d}-writer-000000.parquet" for f in (folder_of(None), folder_of("a")) for n in (0, 1)]
    assert pa.parquet.read_table(tmp_path / "log" / names[-1]).column("x").to_pylist() == [1, 3]
    assert WorkerLog.name() == "worker_log" and list((tmp_path / "log" / "_staged").iterdir()) == []


def test_few_segments_are_open_at_once(tmp_path, monkeypatch):
    """Two hundred workers by turns in four batches, in order and out of it, with a writer that counts what is open."""
    from loomtrace.streaming import worker_log

    now, most = set(), []

    class Counted(pa.parquet.ParquetWriter):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            now.add(self)
            most.append(len(now))

        def close(self):
            now.discard(self)
            super().close()

    monkeypatch.setattr(worker_log.pq, "ParquetWriter", Counted)
    batches = [pa.RecordBatch.from_pylist([{"worker_id": i or None, "seq": 10 - n} for i in range(200)]) for n in range(4)]
    ordered = pa.Table.from_batches(batches).sort_by("worker_id").to_batches(max_chunksize=90)
    for number, (rows, order) in enumerate([(batches, "seq"), (ordered, ""), (batches, "")]):
        writer = _Writer({"path": str(tmp_path / "log"), "order": order})
        writer.commit([writer.write(iter(rows))], number)
    assert not now and max(most) <= worker_log.OPEN + 1
    for i in range(200):
        found = sorted((tmp_path / "log" / folder_of(i or None)).iterdir())
        values = [pa.parquet.read_table(f, partitioning=None).column("seq").to_pylist() for f in found]
        assert len(found) == 3 and values[0] == [7, 8, 9, 10] and [sorted(v) for v in values] == [[7, 8, 9, 10]] * 3
    assert list((tmp_path / "log" / "_staged").iterdir()) == []
