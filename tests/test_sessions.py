"""Sessions by timers: spans put together, and the stream in triggers against the batch's session windows."""

import datetime
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loomtrace.streaming.sessions import Inactivity, joined, sessions_available, spans_of, stream_sessions
from loomtrace.streaming.replay import state_in_rocksdb


def test_spans():
    assert joined([(0, 0, 1), (9, 9, 1), (30, 30, 1)], 10) == [(0, 9, 2), (30, 30, 1)]
    # A row between two sessions joins both.
    assert joined([(0, 5, 2), (20, 25, 3), (14, 14, 1)], 10) == [(0, 25, 6)] and joined([], 10) == []


def test_out_of_order_triggers(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    minutes = [[(1, 0), (1, 30), (2, 0)], [(1, 15), (2, 50)], [(2, 25), (1, 100)], [(-1, 100_000)]]
    for rows in minutes:
        spark.createDataFrame([(w, day + datetime.timedelta(minutes=m)) for w, m in rows], "worker_id long, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    with state_in_rocksdb(spark):
        stream = stream_sessions(spark.readStream.schema("worker_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), 26 * 60, "2 hours")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    found = {(r.worker_id, (r.started - day).seconds // 60, (r.released - day).seconds // 60, r.requests) for r in spark.read.parquet(str(tmp_path / "out")).filter("worker_id > 0").collect()}
    assert found == {(1, 0, 56, 3), (1, 100, 126, 1), (2, 0, 76, 3)}


def test_all_events_against_session_windows(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("worker_id"), "ts")
    wanted = events.groupBy("worker_id", F.session_window("ts", "6 hours").alias("s")).agg(F.count("*").alias("n"))
    wanted = {(r.worker_id, r.s.start, r.s.end, r.n) for r in wanted.collect()}
    assert {tuple(r) for r in sessions_available(spark, events, 6 * 3600).collect()} == wanted


class _Held:
    """The open sessions and timers of one worker, with a count of what is asked of them."""

    def __init__(self):
        self.row, self.timers, self.asked = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.asked += 1
        return self.row

    def update(self, row):
        self.asked += 1
        self.row = row

    def clear(self):
        self.row = None

    def registerTimer(self, at):
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_worker_has_one_timer_whatever_it_holds():
    held, gap = _Held(), 10_000
    processor = Inactivity(gap)
    processor.init(held)
    times = [i * 20_000 for i in reversed(range(500))]
    assert spans_of(np.array(times), gap) == joined([(t, t, 1) for t in times], gap) and spans_of(np.array([], int), gap) == []
    list(processor.handleInputRows((1,), iter([pd.DataFrame({"us": times[:300]}), pd.DataFrame({"us": times[300:]})]), None))
    assert held.timers == {10} and len(held.row[0]) == 500
    out = []
    for watermark in (5_000, 20_000):
        while held.timers and min(held.timers) <= watermark:
            at = min(held.timers)
            out += list(processor.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w), SimpleNamespace(getExpiryTimeInMs=lambda a=at: a)))
            held.timers.remove(at)
        assert len(held.timers) == bool(held.row)
    assert sorted(pd.concat(out).started_us.tolist()) == sorted(times) and held.asked < 12
