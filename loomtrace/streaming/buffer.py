"""The replay buffer as a stream keeps it: the last steps to enter, and the running reward, in versions.

Each trigger puts one version. The ring of bounded size takes part in the choice of the
new one as any other rows do, and the running reward is a map that is put behind the old
one, so the state of a trigger is bounded and its work is that of its own rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomtrace.operators.replay import exponential_map
from loomtrace.sources.snapshots import Conflict, Snapshots

#: Parts of the rows that are cut to the ring's size before they meet.
PARTS = 16


class StreamingBuffer:
    """A ring of ``capacity`` steps and the exponential mean of rewards of ended episodes, below a URI.

    Rows are steps of complete episodes with worker_id, ep, step, seq, ts, reward, flush_ts and
    flush_seq (``operators.replay.flushed``); an episode's last step is the one whose seq is flush_seq.
    The ring keeps the rows that entered last: by flush_ts, flush_seq and step, the greatest first,
    whatever trigger brought them. The mean takes rewards in the order of triggers, and within one in
    that of flush_ts and flush_seq. A batch that is there already changes nothing.
    """

    def __init__(self, spark: SparkSession, uri: str, capacity: int = 10_000, keep: float = 0.99):
        self.spark, self.capacity, self.keep = spark, capacity, keep
        self.log = Snapshots(spark, uri)

    def _ring(self, state: dict) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(state["schema"]))).parquet(state["ring"])

    def add(self, rows: DataFrame, batch: int) -> int:
        """Takes a trigger's rows in; fit for ``foreachBatch``. The version that holds them."""
        version, state = self.log.latest()
        if state.get("batch", -1) >= batch:
            return version
        both = rows.unionByName(self._ring(state).select(*rows.columns)) if state else rows
        order = [F.desc("flush_ts"), F.desc("flush_seq"), F.desc("step"), F.desc("worker_id")]
        part = Window.partitionBy(F.pmod(F.xxhash64("worker_id", "ep", "step"), F.lit(PARTS))).orderBy(*order)
        few = both.withColumn("_place", F.row_number().over(part)).filter(F.col("_place") <= self.capacity).drop("_place")
        target = self.log.new_folder()
        few.orderBy(*order).limit(self.capacity).write.parquet(target)
        ended = rows.filter("seq = flush_seq").select(F.col("flush_ts").alias("ts"), F.col("flush_seq").alias("seq"), "reward")
        n, value = exponential_map(ended, self.keep)
        after = {"ring": target, "schema": rows.schema.json(), "mean": self.keep**n * state.get("mean", 0.0) + value, "ended": state.get("ended", 0) + n, "batch": batch}
        if not self.log.put(version + 1, after):
            raise Conflict("a buffer has one writer")
        return version + 1

    def read(self, version: int | None = None) -> DataFrame:
        """The steps that the ring holds."""
        return self._ring(self.log.read(version) if version else self.log.latest()[1])

    def running_reward(self, version: int | None = None) -> float:
        """The mean after a version, the last one by default; 0 before the first."""
        return (self.log.read(version) if version else self.log.latest()[1]).get("mean", 0.0)

    def vacuum(self, keep: int = 10, age_seconds: float = 86_400) -> int:
        """Deletes what the last ``keep`` versions do not need; the number of folders that went."""
        return self.log.vacuum(keep, lambda state: [state["ring"]], age_seconds)
