"""Sessions of workers as a stream: a session ends when nothing was asked for as long as the gap, by a timer of event time.

The state of a worker is its open sessions, more than one where rows came out of order: rows
between two of them join both. A session leaves when the watermark passes its end, so what leaves
is what the batch's session windows give, for all rows that the watermark lets in. A worker has one
timer, for the first of its sessions to end; what it wakes takes out all that are over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomtrace.sources.shared import new_folder
from loomtrace.streaming.replay import state_in_rocksdb

SESSIONS = "worker_id long, started_us long, released_us long, requests long"
#: The open sessions of a worker in one row, so that they are read and put at one go.
OPEN = "started array<long>, last array<long>, requests array<long>"


def joined(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Spans (first, last, requests) with those put together that begin within ``gap`` of an earlier one's last."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] < gap:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def spans_of(times: np.ndarray, gap: int) -> list[tuple[int, int, int]]:
    """The spans of single requests, put together as ``joined`` does."""
    times = np.sort(times)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(times) >= gap) + 1, [len(times)]]) if len(times) else np.zeros(1, int)
    return [(int(times[a]), int(times[b - 1]), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Inactivity(StatefulProcessor):
    """Emits sessions whose worker was silent for ``gap_us`` microseconds."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _held(self) -> list[tuple[int, int, int]]:
        held = self.open.get()
        return list(zip(*held, strict=True)) if held is not None else []

    def _keep(self, spans: list[tuple[int, int, int]]) -> None:
        self.open.update(tuple(list(c) for c in zip(*spans, strict=True))) if spans else self.open.clear()

    def _due(self, span: tuple[int, int, int]) -> int:
        """The millisecond by which a session is over."""
        return math.ceil((span[1] + self.gap) / 1000)

    def _wake(self, spans: list[tuple[int, int, int]]) -> int | None:
        """When the first of the open sessions is over: a worker has this one timer, however many sessions are open."""
        return min((self._due(s) for s in spans), default=None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._held()
        times = np.concatenate([frame.us.to_numpy(np.int64) for frame in rows])
        after = joined(before + spans_of(times, self.gap), self.gap)
        old, new = self._wake(before), self._wake(after)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        self._keep(after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # No row that the watermark lets in can reach a session that is over by it, so all of those leave at once.
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self._held()
        over = [s for s in held if self._due(s) <= now]
        left = [s for s in held if self._due(s) > now]
        if over:
            self._keep(left)
            if left:
                self.handle.registerTimer(self._wake(left))
            yield pd.DataFrame({"worker_id": [int(key[0])] * len(over), "started_us": [s[0] for s in over], "released_us": [s[1] + self.gap for s in over], "requests": [s[2] for s in over]})

    def close(self) -> None:
        pass


def stream_sessions(requests: DataFrame, gap_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Sessions of a stream of requests (worker_id, ts) as they end; rows that come more than ``delay`` late are left out."""
    rows = requests.select("worker_id", "ts", F.unix_micros("ts").alias("us")).withWatermark("ts", delay)
    found = rows.groupBy("worker_id").transformWithStateInPandas(Inactivity(gap_seconds * 1_000_000), SESSIONS, "Append", "EventTime")
    return found.select("worker_id", F.timestamp_micros("started_us").alias("started"), F.timestamp_micros("released_us").alias("released"), "requests")


def sessions_available(spark: SparkSession, requests: DataFrame, gap_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """The sessions that the stream emits for all requests there are; a last row of nobody, far ahead, lets the open ones end."""
    base = new_folder(spark, "sessions")
    rows = requests.filter("worker_id is not null and ts is not null").select(F.col("worker_id").cast("long").alias("worker_id"), F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{base}/in")
    last = rows.agg(F.max("ts").alias("ts")).filter("ts is not null")
    last.select(F.lit(-1).cast("long").alias("worker_id"), (F.col("ts") + F.make_dt_interval(days=F.lit(3650))).alias("ts")).write.mode("append").parquet(f"{base}/in")
    with state_in_rocksdb(spark):
        stream = stream_sessions(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), gap_seconds, delay)
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    kind = requests.schema["ts"].dataType
    found = spark.read.schema("worker_id long, started timestamp, released timestamp, requests long").parquet(f"{base}/out").filter("worker_id <> -1")
    return found.select("worker_id", *[F.col(c).cast(kind).alias(c) for c in ("started", "released")], "requests")
