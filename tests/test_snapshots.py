"""Versions put once, and the keyed store: two writers at once, a writer that dies, repeated batches, old versions."""

import threading

import pytest
from pyspark.sql import functions as F

from loomtrace.sources import files as S
from loomtrace.sources.snapshots import Conflict, KeyedStore, Snapshots

ROW = "k long, t long, v string"


def rows_of(frame):
    return sorted((r.k if r.k is not None else -1, r.t, r.v) for r in frame.collect())


def test_a_version_is_put_once(spark, tmp_path):
    log = Snapshots(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {}) and log.put(1, {"a": 1}) and not log.put(1, {"a": 2}) and log.put(2, {"a": 3})
    assert log.latest() == (2, {"a": 3}) and log.read(1) == {"a": 1} and log.versions() == [1, 2]


def test_upserts_versions_and_odd_rows(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], ["t"], buckets=4)
    with pytest.raises(ValueError):
        store.read()
    first = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 1, "n"), (2, 1, "x")], ROW)
    assert store.upsert(first) == 1 and rows_of(store.read()) == [(-1, 1, "n"), (1, 3, "c"), (2, 1, "x")]
    late = spark.createDataFrame([(1, 2, "late"), (2, 1, "y"), (3, 0, None), (None, 5, "m")], ROW)
    assert store.upsert(late) == 2
    wanted = [(-1, 5, "m"), (1, 3, "c"), (2, 1, "y"), (3, 0, None)]
    assert rows_of(store.read()) == wanted
    # The same again changes nothing, nothing at all neither, and the first version is still there.
    store.upsert(late), store.upsert(late.limit(0))
    assert rows_of(store.read()) == wanted and rows_of(store.read(1)) == [(-1, 1, "n"), (1, 3, "c"), (2, 1, "x")]
    assert store.vacuum(keep=1, age_seconds=0) > 0 and rows_of(store.read()) == wanted and len(store.log.versions()) == 1


def test_an_update_rewrites_its_buckets_only(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], ["t"], buckets=16)
    store.upsert(spark.range(200).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("t"), F.lit("a").alias("v")))
    before = store.log.latest()[1]["folders"]
    store.upsert(spark.createDataFrame([(7, 1, "b")], ROW))
    after = store.log.latest()[1]["folders"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(after) == 16


def test_two_writers_lose_no_row(spark, tmp_path):
    uri, failures = str(tmp_path / "s"), []

    def write(writer, start):
        try:
            store = KeyedStore(spark, uri, ["k"], ["t"], buckets=4)
            for batch in range(3):
                rows = spark.range(start + batch, start + 30, 3).select(F.col("id").alias("k"), F.lit(batch).cast("long").alias("t"), F.lit(writer).alias("v"))
                store.upsert(rows, writer, batch)
        except Exception as error:  # told by the main thread
            failures.append(error)

    threads = [threading.Thread(target=write, args=("one", 0)), threading.Thread(target=write, args=("two", 15))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    store = KeyedStore(spark, uri, ["k"], ["t"], buckets=4)
    got = {r.k: (r.t, r.v) for r in store.read().collect()}
    wanted = {}
    for writer, start in (("one", 0), ("two", 15)):
        for batch in range(3):
            for k in range(start + batch, start + 30, 3):
                wanted[k] = max(wanted.get(k, (-1, "")), (batch, writer))
    assert got == wanted and store.log.versions() == list(range(1, 7))


def test_a_dead_writer_and_a_repeated_batch(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], ["t"], buckets=2, attempts=3)
    store.upsert(spark.createDataFrame([(1, 1, "a")], ROW), "w", 0)
    with monkeypatch.context() as patch:
        def die(*_):
            raise KeyboardInterrupt

        patch.setattr(store.log, "put", die)
        with pytest.raises(KeyboardInterrupt):
            store.upsert(spark.createDataFrame([(1, 2, "b")], ROW), "w", 1)
    assert rows_of(store.read()) == [(1, 1, "a")]
    store.upsert(spark.createDataFrame([(1, 2, "b")], ROW), "w", 1)
    assert store.upsert(spark.createDataFrame([(1, 9, "again")], ROW), "w", 1) == 2 and rows_of(store.read()) == [(1, 2, "b")]
    monkeypatch.setattr(store.log, "put", lambda *_: False)
    with pytest.raises(Conflict):
        store.upsert(spark.createDataFrame([(5, 1, "z")], ROW))


def test_keys_that_are_gone(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], ["t"], gone="dead")
    frame = lambda *rows: spark.createDataFrame(rows, "k long, t long, dead boolean")
    store.upsert(frame((1, 1, False), (2, 1, None), (3, 1, False)))
    store.upsert(frame((1, 2, True), (3, 0, True)))
    assert sorted(r.k for r in store.read().collect()) == [2, 3]


def test_results_keep_the_last_row(spark, tmp_path):
    results = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0), ("b", 1, 0.5)], "id string, finished_at long, score double")
    S.write_results(results, str(tmp_path / "r"))
    assert sorted((r.id, r.score) for r in spark.read.json(str(tmp_path / "r")).collect()) == [("a", 1.0), ("b", 0.5)]
    store = S.result_store(spark, str(tmp_path / "q"))
    store.upsert(results.filter("id = 'a'")), store.upsert(results.filter("id = 'b'"))
    assert sorted((r.id, r.score) for r in store.read().collect()) == [("a", 1.0), ("b", 0.5)]
