"""Replay as a stream: steps are held by worker until their episode is done, then leave with their returns.

The state of a worker is the steps of its open episode and how many it has completed.
The batch query orders by event time; a stream takes steps in the order of arrival
within a worker, and sorts those of one trigger.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomtrace.operators.replay import flushed, steps_of_events
from loomtrace.sources.shared import new_folder
from loomtrace.streaming.buffer import StreamingBuffer
from loomtrace.streaming.worker_log import read_worker_log, write_worker_log

RETURNS = "worker_id long, ep long, step long, seq long, g double"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class EpisodeReturns(StatefulProcessor):
    """Emits discounted returns when a step is done. ``ttl_ms`` lets an open episode expire; none does by default."""

    def __init__(self, gamma: float, ttl_ms: int | None = None):
        self.gamma, self.ttl_ms = gamma, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", "seq long, reward double", self.ttl_ms)
        self.ended = handle.getValueState("ended", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The open list is read only when an episode ends, and otherwise added to."""
        frame = pd.concat(list(rows)).sort_values(["ts", "seq"])
        seqs, rewards, ends = frame.seq.to_numpy(np.int64), frame.reward.fillna(0.0).to_numpy(float), np.flatnonzero(frame.done.to_numpy(bool))
        added = lambda low, high: list(zip(seqs[low:high].tolist(), rewards[low:high].tolist(), strict=True))
        if not len(ends):
            self.open.appendList(added(0, len(seqs)))
            return
        ended = int(self.ended.get()[0]) if self.ended.exists() else 0
        out, low = [], 0
        held = [tuple(r) for r in self.open.get()]
        for end in ends.tolist():
            held += added(low, end + 1)
            g, returns = 0.0, []
            for _, r in reversed(held):
                g = r + self.gamma * g
                returns.append(g)
            out += [(int(key[0]), ended, i + 1, s, v) for i, ((s, _), v) in enumerate(zip(held, reversed(returns), strict=True))]
            held, ended, low = [], ended + 1, end + 1
        if low < len(seqs):
            self.open.put(added(low, len(seqs)))
        elif self.open.exists():
            self.open.clear()
        self.ended.update((ended,))
        yield pd.DataFrame(out, columns=["worker_id", "ep", "step", "seq", "g"])

    def close(self) -> None:
        pass


def stream_returns(steps: DataFrame, gamma: float = 0.9, ttl_ms: int | None = None) -> DataFrame:
    """Returns of episodes as they end; ``steps`` is a stream of worker_id, ts, seq, reward, done, is_init."""
    rows = steps.filter("not is_init").select("worker_id", "ts", "seq", "reward", "done")
    return rows.groupBy("worker_id").transformWithStateInPandas(EpisodeReturns(gamma, ttl_ms), RETURNS, "Append", "None")


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for as long as it is asked for."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STORE)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _returns_at(spark: SparkSession, steps: DataFrame, gamma: float, base: str) -> DataFrame:
    """Runs a stream of steps to its end and reads what it emitted."""
    with state_in_rocksdb(spark):
        query = stream_returns(steps, gamma).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(RETURNS).parquet(f"{base}/out").select("worker_id", "ep", "step", "seq", F.round("g", 6).alias("g"))


def replay_available(spark: SparkSession, events: DataFrame, gamma: float = 0.9) -> DataFrame:
    """What the stream emits for all events there are: the batch is laid out as files, streamed once and read back. The files go when the session ends."""
    base = new_folder(spark, "stream")
    events.write.parquet(f"{base}/in")
    return _returns_at(spark, steps_of_events(spark.readStream.schema(events.schema).parquet(f"{base}/in")), gamma, base)


def replay_from_log(spark: SparkSession, events: DataFrame, gamma: float = 0.9) -> DataFrame:
    """The same by way of a log of workers: a sink appends each worker's events as segments, and a source streams the log."""
    base = new_folder(spark, "log")
    events.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{base}/in").withColumn("seq", F.col("event_id"))
    write_worker_log(stream, f"{base}/log", f"{base}/sink", worker="user_id").awaitTermination()
    return _returns_at(spark, steps_of_events(read_worker_log(spark, f"{base}/log", events.schema)), gamma, base)


def buffer_available(spark: SparkSession, steps: DataFrame, capacity: int, keep: float, triggers: int = 4) -> StreamingBuffer:
    """A buffer that has taken in all completed steps in some triggers, in order of their episodes' ends."""
    base = new_folder(spark, "buffer")
    rows = flushed(steps).select("worker_id", "ep", "step", "seq", "ts", "reward", "flush_ts", "flush_seq")
    rows.write.parquet(f"{base}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/rows")
    cuts = rows.agg(F.percentile_approx("flush_ts", [i / triggers for i in range(1, triggers)]).alias("at")).first()["at"] or []
    # One after the other: the stream takes files in the order in which they came.
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.filter(F.col("flush_ts") > low)
        part = part if high is None else part.filter(F.col("flush_ts") <= high)
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    buffer = StreamingBuffer(spark, f"{base}/buffer", capacity, keep)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream.writeStream.foreachBatch(buffer.add).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return buffer
