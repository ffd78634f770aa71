"""A vector index that is kept: vectors as Parquet by part of their domain and cell, in versions.

``build`` chooses pivots; an insert places rows in the cells that are there and adds files to
the parts of those cells only. A domain that is new has one cell without a pivot. A query finds
by the triangle inequality which cells may hold a near vector, and its scan reads the parts
of those cells. ``rebuild`` chooses pivots anew when domains have grown, and gathers files.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomtrace.operators import dedup
from loomtrace.sources.shared import ensure_checkpoints
from loomtrace.sources.snapshots import Conflict, Snapshots


class VectorIndex:
    """Stored vectors (id, domain, embedding) below a URI, each id once.

    An id that is stored already, or repeated in an insert, is put in once: the first time
    in the order of inserts, and in one insert the row with the least vector. Rows without
    an id, a domain or a vector are left out.
    """

    def __init__(self, spark: SparkSession, uri: str, parts: int = 64, attempts: int = 20):
        self.spark, self.parts, self.attempts = spark, parts, attempts
        self.log = Snapshots(spark, uri)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("domain", "cell"), F.lit(self.parts)).cast("int")

    def _frame(self, state: dict, name: str, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schemas"][name]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _placed(self, state: dict, parts: list[int] | None = None) -> DataFrame:
        """Placed rows of some parts, each folder of an insert being partitioned by part."""
        schema = StructType.fromJson(json.loads(state["schemas"]["placed"]))
        frames = [self.spark.read.schema(schema).parquet(f) for f in state["placed"]]
        if not frames:
            return self.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionByName, frames)
        return rows if parts is None else rows.filter(F.col("part").isin(parts))

    def _cells(self, state: dict) -> DataFrame:
        found = self._frame(state, "cells", state["cells"])
        return found.groupBy("domain", "cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n"))

    def _fresh(self, rows: DataFrame) -> DataFrame:
        rows = dedup.vectors(rows).filter("id is not null")
        return rows.groupBy("id").agg(F.min(F.struct("domain", "embedding")).alias("x")).select("id", "x.domain", "x.embedding")

    def build(self, rows: DataFrame) -> int:
        """The index of these rows in place of what was there; its version."""
        rows = self._fresh(rows)
        for _ in range(self.attempts):
            version, _ = self.log.latest()
            if self.log.put(version + 1, self._built(rows)):
                return version + 1
        raise Conflict("other writers were faster")

    def _built(self, rows: DataFrame) -> dict:
        pivots_at, staged = self.log.new_folder(), self.log.new_folder()
        rows.write.parquet(staged)
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        pivots = dedup.pivots_of(rows)
        pivots.write.parquet(pivots_at)
        state = {"pivots": [pivots_at], "placed": [], "cells": [], "schemas": {"pivots": pivots.schema.json()}}
        return self._with(state, rows)

    def _with(self, state: dict, rows: DataFrame) -> dict:
        """The state with rows added; the rows are written by now."""
        pivots = self._frame(state, "pivots", state["pivots"])
        placed = dedup.place(rows, pivots).withColumn("part", self._part())
        placed_at, cells_at = self.log.new_folder(), self.log.new_folder()
        placed.write.partitionBy("part").parquet(placed_at)
        cells = dedup.cells_of(self.spark.read.schema(placed.schema).parquet(placed_at))
        cells.write.parquet(cells_at)
        schemas = state["schemas"] | {"placed": placed.schema.json(), "cells": cells.schema.json()}
        return state | {"placed": [*state["placed"], placed_at], "cells": [*state["cells"], cells_at], "schemas": schemas}

    def insert(self, rows: DataFrame) -> int:
        """Adds the rows whose ids are not stored; the version that has them. Only the parts of their cells get files."""
        rows, staged = self._fresh(rows), self.log.new_folder()
        rows.write.parquet(staged)
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        for _ in range(self.attempts):
            version, state = self.log.latest()
            if not state:
                return self.build(rows)
            # Of what is stored only the ids are read.
            new = rows.join(self._placed(state).select(F.col("other").alias("id")), "id", "left_anti")
            if self.log.put(version + 1, self._with(state, new)):
                return version + 1
        raise Conflict("other writers were faster")

    def rebuild(self) -> int:
        """Chooses pivots anew for all that is stored, and gathers its files."""
        return self.build(self.read())

    def read(self, version: int | None = None) -> DataFrame:
        """(id, domain, embedding) of a version, the last one by default."""
        state = self.log.read(version) if version else self.log.latest()[1]
        return self._placed(state).select(F.col("other").alias("id"), "domain", F.col("v").alias("embedding"))

    def near(self, rows: DataFrame, threshold: float, version: int | None = None) -> DataFrame:
        """(id, other, domain, similarity): the stored vectors of a row's domain with a cosine of ``threshold`` or more."""
        state = self.log.read(version) if version else self.log.latest()[1]
        kind = rows.schema["domain"].dataType
        ensure_checkpoints(self.spark)
        rows = dedup.vectors(rows)
        met = dedup.meet(rows, self._frame(state, "pivots", state["pivots"]), self._cells(state), threshold).withColumn("part", self._part()).checkpoint()
        # As many numbers as the index has parts at most.
        parts = sorted(r.part for r in met.select("part").distinct().collect())
        found = dedup.pairs_of(met.drop("part"), self._placed(state, parts).drop("part"), threshold)
        return found.select("id", "other", F.col("domain").cast(kind).alias("domain"), "similarity")

    def filter_batch(self, rows: DataFrame, threshold: float) -> DataFrame:
        """The rows that are near no stored one, and not near an earlier accepted row of their own batch: (id, domain, accepted, match)."""
        stored = self.near(rows, threshold).groupBy("id").agg(F.max_by("other", F.struct("similarity", -F.col("other"))).alias("match"))
        free = rows.join(stored, "id", "left_anti")
        known = rows.join(stored, "id").select("id", "domain", F.lit(False).alias("accepted"), "match")
        return dedup.greedy(free, threshold).unionByName(known)

    def vacuum(self, keep: int = 10, age_seconds: float = 86_400) -> int:
        """Deletes what the last ``keep`` versions do not need; the number of folders that went."""
        return self.log.vacuum(keep, lambda s: [*s["pivots"], *s["placed"], *s["cells"]], age_seconds)
