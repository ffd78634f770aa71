"""The kept vector index: all pairs after inserts, versions, cells that a scan names, batches."""

import numpy as np
import pytest

from loomtrace.operators import dedup
from loomtrace.operators.vector_index import VectorIndex

ROW = "id long, domain string, embedding array<double>"


@pytest.fixture()
def vectors(monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 30)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, 12))
    return [(i, "hot" if i % 3 else f"d{i % 7}", (centres[rng.integers(10)] + rng.normal(size=12) * 0.2).tolist()) for i in range(360)]


def pairs(rows, store, threshold):
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    return {(a, b) for a, da, u in rows for b, db, v in store if da == db and unit(u) @ unit(v) >= threshold}


def test_near_after_inserts(spark, tmp_path, vectors):
    frame = lambda rows: spark.createDataFrame(rows, ROW)
    index = VectorIndex(spark, str(tmp_path / "i"), parts=32)
    stored, asked = [r for r in vectors if r[0] % 4], [r for r in vectors if r[0] % 4 == 0]
    index.build(frame([r for r in stored if r[0] % 4 == 1]))
    index.insert(frame([r for r in stored if r[0] % 4 == 2]))
    # Repeated ids stay as they are, new domains get a cell, and what lacks a part is left out.
    more = [r for r in stored if r[0] % 4 == 3] + [(1, "hot", [1.0] * 12), (1000, "new", vectors[0][2]), (1001, None, vectors[0][2]), (1002, "hot", None)]
    third = index.insert(frame(more))
    stored.append((1000, "new", vectors[0][2]))
    assert third == 3 and index.read().count() == len(stored) and index.read(1).count() == 90
    for threshold in (0.95, 0.6):
        got = index.near(frame([*asked, (2000, "new", vectors[0][2])]), threshold).collect()
        assert len(got) == len({(r.id, r.other) for r in got})
        assert {(r.id, r.other) for r in got} == pairs([*asked, (2000, "new", vectors[0][2])], stored, threshold)
    old = index.near(frame(asked), 0.9, version=1).collect()
    assert {(r.id, r.other) for r in old} == pairs(asked, [r for r in stored if r[0] % 4 == 1], 0.9)
    assert index.rebuild() == 4 and {(r.id, r.other) for r in index.near(frame(asked), 0.9).collect()} == pairs(asked, stored, 0.9)
    assert index.vacuum(keep=1, age_seconds=0) > 0 and index.read().count() == len(stored)


def test_a_scan_names_the_parts_of_its_cells(spark, tmp_path, vectors):
    index = VectorIndex(spark, str(tmp_path / "i"), parts=32)
    index.build(spark.createDataFrame(vectors, ROW))
    one = spark.createDataFrame([vectors[1]], ROW)
    plan = index.near(one, 0.98)._jdf.queryExecution().executedPlan().toString()
    named = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "part" in named and 1 <= named.count(",") + 1 < 12


def test_many_domains(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "i"), parts=8)
    rows = spark.range(5_000).selectExpr("id", "concat('d', id) as domain", "array(1.0D, 0.0D) as embedding")
    index.insert(rows.filter("id % 2 = 0")), index.insert(rows.filter("id % 2 = 1"))
    assert index.near(rows.selectExpr("id + 10000 as id", "domain", "embedding"), 0.99).filter("other = id - 10000").count() == 5_000


def test_batches_against_the_store(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "i"), parts=4)
    index.build(spark.createDataFrame([(0, "a", [1.0, 0.0])], ROW))
    batch = spark.createDataFrame([(1, "a", [1.0, 0.1]), (2, "a", [0.0, 1.0]), (3, "a", [0.1, 1.0]), (4, "b", [1.0, 0.0])], ROW)
    got = {r.id: (r.accepted, r.match) for r in index.filter_batch(batch, 0.9).collect()}
    assert got == {1: (False, 0), 2: (True, None), 3: (False, 2), 4: (True, None)}
