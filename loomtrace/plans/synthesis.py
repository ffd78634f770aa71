"""Synthesis in rounds: candidates of the domains that are short, validated, free of near ones, and no more than are short.

A round is three commits: what it accepted, then the store of tasks, then the index of
their vectors. A run that starts again goes on with the first of them that is missing, and
does not ask for the candidates of an accepted round again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.operators import dedup
from loomtrace.operators.vector_index import VectorIndex
from loomtrace.sources.snapshots import Conflict, KeyedStore, Snapshots

#: (shortages with domain and short, number of the round) -> candidates with id, domain, embedding and any other columns.
Propose = Callable[[DataFrame, int], DataFrame]


class SynthesisLoop:
    """Fills ``quotas`` (domain, quota) with tasks below a URI.

    ``valid`` is a test of a candidate's columns. A candidate that is near a stored task of
    its domain, or an earlier accepted one of its round, goes, and so does one whose id is
    stored. Of the rest the first by id are taken, as many as the domain is short. Rows
    without an id, a domain or a vector go too; a domain without a quota wants nothing.
    """

    def __init__(self, spark: SparkSession, uri: str, quotas: DataFrame, propose: Propose, valid: Column, threshold: float = 0.85, patience: int = 2):
        self.spark, self.quotas, self.propose, self.valid, self.threshold, self.patience = spark, quotas, propose, valid, threshold, patience
        self.log = Snapshots(spark, f"{uri}/rounds")
        self.tasks = KeyedStore(spark, f"{uri}/tasks", ["id"], ["round"], buckets=16)
        self.index = VectorIndex(spark, f"{uri}/vectors", parts=16)

    def shortages(self) -> DataFrame:
        """(domain, short) of the domains that are short."""
        quotas = self.quotas.groupBy("domain").agg(F.max("quota").alias("quota"))
        if self.tasks.log.latest()[0]:
            held = self.tasks.read().groupBy("domain").agg(F.count("*").alias("held"))
            quotas = quotas.join(held, "domain", "left")
        else:
            quotas = quotas.withColumn("held", F.lit(0))
        return quotas.select("domain", (F.col("quota") - F.coalesce("held", F.lit(0))).alias("short")).filter("short > 0")

    def _accepted(self, number: int) -> DataFrame:
        short = self.shortages()
        # Written once: a model is not asked twice for what the steps below read.
        at = self.log.new_folder()
        self.propose(short, number).filter(F.coalesce(self.valid, F.lit(False))).filter("id is not null and domain is not null and embedding is not null").join(short, "domain", "left_semi").dropDuplicates(["id"]).write.parquet(at)
        rows = self.spark.read.parquet(at)
        if self.tasks.log.latest()[0]:
            rows = rows.join(self.tasks.read().select("id"), "id", "left_anti")
        few = rows.select("id", "domain", "embedding")
        told = self.index.filter_batch(few, self.threshold) if self.index.log.latest()[0] else dedup.greedy(few, self.threshold)
        kept = rows.join(told.filter("accepted").select("id"), "id", "left_semi").join(short, "domain")
        place = F.row_number().over(Window.partitionBy("domain").orderBy("id"))
        return kept.withColumn("_place", place).filter(F.col("_place") <= F.col("short")).drop("_place", "short").withColumn("round", F.lit(number))

    def run(self, most: int = 100) -> int:
        """Rounds until nothing is short, ``patience`` rounds in a row gave nothing, or ``most`` were run; how many there were in all."""
        while True:
            version, state = self.log.latest()
            if not state or state["stage"] == "done":
                number, empty = state.get("round", -1) + 1, state.get("empty", 0)
                if number >= most or empty >= self.patience or self.shortages().isEmpty():
                    return number
                target = self.log.new_folder()
                self._accepted(number).write.parquet(target)
                count = self.spark.read.parquet(target).count()
                state = {"round": number, "stage": "accepted", "rows": target, "count": count, "empty": empty + 1 if not count else 0}
                version = self._put(version, state)
            rows = self.spark.read.parquet(state["rows"])
            if state["count"]:
                self.tasks.upsert(rows, "synthesis", state["round"])
                self.index.insert(rows)
            self._put(version, state | {"stage": "done"})

    def _put(self, version: int, state: dict) -> int:
        if not self.log.put(version + 1, state):
            raise Conflict("a synthesis has one writer")
        return version + 1
