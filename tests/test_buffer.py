"""The streaming buffer after each trigger against the batch ring and mean, restarts, and the mean in two levels."""

import pytest

from loomtrace.operators.replay import exponential_map, flushed, ring, steps_of_events
from loomtrace.streaming.buffer import StreamingBuffer

STEPS = "worker_id long, ts long, seq long, action string, reward double, done boolean, is_init boolean"


def steps_of(spark, n):
    return spark.createDataFrame([(i % 7, i, i, "a", (i * 31 % 17) / 4 if i % 13 else None, i % 5 == 4, False) for i in range(n)], STEPS)


def folded(rewards, keep, x=0.0):
    for r in rewards:
        x = keep * x + (1 - keep) * (r or 0.0)
    return x


def test_the_mean_in_two_levels(spark):
    rows = steps_of(spark, 500)
    for keep in (0.9, 0.99999, 0.0):
        n, value = exponential_map(rows.repartition(7), keep)
        assert n == 500 and value == pytest.approx(folded([r.reward for r in sorted(rows.collect(), key=lambda r: r.seq)], keep), abs=1e-12)
    assert exponential_map(rows.limit(0)) == (0, 0.0)


def test_each_trigger_against_the_batch(spark, tmp_path):
    steps, keep = steps_of(spark, 300), 0.9
    all_rows = flushed(steps).select("worker_id", "ep", "step", "seq", "ts", "reward", "flush_ts", "flush_seq").cache()
    buffer, mean, cuts = StreamingBuffer(spark, str(tmp_path / "b"), capacity=40, keep=keep), 0.0, (0, 90, 100, 260, 1000)
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        mine = all_rows.filter(f"flush_ts >= {low} and flush_ts < {high}")
        assert buffer.add(mine, batch) == batch + 1
        wanted = sorted(r.seq for r in ring(steps.filter(f"ts < {high}"), 40).collect())
        assert sorted(r.seq for r in buffer.read().collect()) == wanted
        mean = folded([r.reward for r in sorted(mine.filter("seq = flush_seq").collect(), key=lambda r: (r.flush_ts, r.flush_seq))], keep, mean)
        assert buffer.running_reward() == pytest.approx(mean, abs=1e-12)
        # A batch that is repeated after a restart changes nothing.
        assert StreamingBuffer(spark, str(tmp_path / "b"), 40, keep).add(mine, batch) == batch + 1
    assert buffer.read(1).count() == 40 and buffer.vacuum(keep=1, age_seconds=0) == 3


def test_as_a_stream_of_files(spark, tmp_path, sf_dir):
    steps = steps_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    rows = flushed(steps).select("worker_id", "ep", "step", "seq", "ts", "reward", "flush_ts", "flush_seq")
    rows.repartitionByRange(3, "flush_ts", "flush_seq").sortWithinPartitions("flush_ts", "flush_seq").write.parquet(str(tmp_path / "in"))
    buffer = StreamingBuffer(spark, str(tmp_path / "b"), capacity=200)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(buffer.add).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert len(buffer.log.versions()) == 3
    assert sorted(r.seq for r in buffer.read().collect()) == sorted(r.seq for r in ring(steps, 200).collect())
