"""Step events to episodes, discounted returns and the views of a replay buffer.

A step has worker_id, ordering columns, reward and done. An episode of a worker ends
with a step that is done; steps after the last one that is done are not complete and
are never seen. All functions take and give DataFrames and are lazy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("ts", "seq")


def steps_of_events(events: DataFrame) -> DataFrame:
    """The driver's events as steps: a purchase ends an episode, a signup only begins one and carries no reward."""
    return events.select(
        F.col("user_id").alias("worker_id"), "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("action"), F.col("value").alias("reward"),
        (F.col("event_type") == "purchase").alias("done"), (F.col("event_type") == "signup").alias("is_init"),
    )


def with_episodes(steps: DataFrame) -> DataFrame:
    """``steps`` that are not initial with ``ep``, the number of the worker's steps done strictly before."""
    before = Window.partitionBy("worker_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(F.col("done").cast("long")).over(before), F.lit(0)).cast("long")
    return steps.filter(~F.coalesce(F.col("is_init"), F.lit(False))).withColumn("ep", ended)


def completed_steps(steps: DataFrame) -> DataFrame:
    """Steps of complete episodes with ``ep``, ``step`` (from 1) and ``n_steps``."""
    whole = Window.partitionBy("worker_id", "ep")
    rows = with_episodes(steps).withColumn("complete", F.max(F.col("done").cast("int")).over(whole)).filter("complete = 1").drop("complete")
    return rows.withColumn("step", F.row_number().over(whole.orderBy(*ORDER)).cast("long")).withColumn("n_steps", F.count("*").over(whole))


#: Steps that one fold goes over.
FOLD = 64


def discounted_returns(steps: DataFrame, gamma: float = 0.9) -> DataFrame:
    """(worker_id, ep, step, ts, seq, reward, g): G of a step is its reward plus gamma times the next one's G.

    Steps of an episode are folded from the end in blocks of FOLD; a block is an affine
    map of what comes after it, and the blocks' maps are folded in turn. So the work
    grows with the steps of an episode and not with their square.
    """
    rows = completed_steps(steps).withColumn("block", F.floor((F.col("n_steps") - F.col("step")) / FOLD))  # from the end
    listed = F.sort_array(F.collect_list(F.struct("step", "ts", "seq", "reward")), asc=False)
    blocks = rows.groupBy("worker_id", "ep", "block").agg(listed.alias("steps"))
    reward = lambda x: F.coalesce(x["reward"], F.lit(0.0))
    maps = blocks.withColumn("factor", F.pow(F.lit(gamma), F.size("steps"))).withColumn("offset", F.aggregate("steps", F.lit(0.0), lambda g, x: reward(x) + F.lit(gamma) * g))
    # What comes after a block: the maps of the later blocks, whose factors vanish fast.
    later = Window.partitionBy("worker_id", "ep").orderBy("block")
    if gamma == 1:  # nothing shrinks: a sum of all later blocks, without gathering them
        after = F.coalesce(F.sum("offset").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    else:
        after = F.aggregate(F.collect_list(F.struct("factor", "offset")).over(later.rowsBetween(-_blocks_that_count(gamma), -1)), F.lit(0.0), lambda g, m: m["offset"] + m["factor"] * g)
    start = lambda g: F.struct(g.alias("g"), F.array().cast("array<double>").alias("all"))

    def back(acc: Column, x: Column) -> Column:
        g = reward(x) + F.lit(gamma) * acc["g"]
        return F.struct(g.alias("g"), F.concat(acc["all"], F.array(g)).alias("all"))

    folded = maps.withColumn("after", after).withColumn("returns", F.aggregate("steps", start(F.col("after")), back)["all"])
    found = folded.select("worker_id", "ep", F.explode(F.arrays_zip("steps", "returns")).alias("x"))
    return found.select("worker_id", "ep", F.col("x.steps.step").alias("step"), F.col("x.steps.ts").alias("ts"), F.col("x.steps.seq").alias("seq"), F.col("x.steps.reward").alias("reward"), F.col("x.returns").alias("g"))


def _blocks_that_count(gamma: float) -> int:
    """Later blocks that reach a double's precision; all of an episode's (2**30) where gamma is above 1."""
    return max(1, math.ceil(math.log(1e-25) / math.log(gamma) / FOLD)) if 0 < gamma < 1 else 1 if gamma == 0 else 1 << 30


def outcome_only(steps: DataFrame) -> DataFrame:
    """The last step of each complete episode, with its own reward."""
    return completed_steps(steps).filter("step = n_steps")


def flushed(steps: DataFrame) -> DataFrame:
    """Complete steps with ``flush_ts`` and ``flush_seq``: episodes enter the buffer whole, when they end."""
    whole = Window.partitionBy("worker_id", "ep")
    return completed_steps(steps).withColumn("flush_ts", F.max("ts").over(whole)).withColumn("flush_seq", F.max_by("seq", F.struct(*ORDER)).over(whole))


def ring(steps: DataFrame, capacity: int = 10_000) -> DataFrame:
    """What a ring of ``capacity`` rows holds: the last ones to enter."""
    return flushed(steps).orderBy(F.desc("flush_ts"), F.desc("flush_seq"), F.desc("step")).limit(capacity)


def balance(rows: DataFrame, value: str, threshold: float = 0.1) -> DataFrame:
    """(below, above): how many values lie below the threshold and how many do not."""
    return rows.agg(F.count_if(F.col(value) < threshold).alias("below"), F.count_if(F.col(value) >= threshold).alias("above"))


def balanced(rows: DataFrame, value: str, threshold: float = 0.1, tolerance: float = 0.1) -> DataFrame:
    """All rows if both sides are about as many, else those strictly on the side that has fewer."""
    stats = balance(rows, value, threshold)  # one row
    rate = (F.col("above") - F.col("below")) / (F.col("above") + F.col("below") + 1e-8)
    low, high = (rate > 0) & (F.col(value) < threshold), (rate <= 0) & (F.col(value) > threshold)
    return rows.crossJoin(F.broadcast(stats)).filter((F.abs(rate) < tolerance) | low | high).select(*rows.columns)


def sample_by_hash(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, the same for the same seed."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def length_histogram(steps: DataFrame) -> DataFrame:
    """(n_steps, episodes): how many complete episodes have as many steps."""
    return completed_steps(steps).groupBy("worker_id", "ep").agg(F.count("*").alias("n_steps")).groupBy("n_steps").agg(F.count("*").alias("episodes"))


def outcome_reward(steps: DataFrame) -> DataFrame:
    """The mean reward of steps that are done; 0 without one."""
    return steps.agg(F.coalesce(F.avg(F.when(F.col("done"), F.col("reward"))), F.lit(0.0)).alias("outcome_reward"))


def exponential_map(rows: DataFrame, keep: float = 0.99) -> tuple[int, float]:
    """(n, value) of all rewards in order of ts and seq: x becomes keep ** n * x + value. A null reward counts as 0.

    Each range of the order is folded where it lies, so that one row of it, its first
    place with its map, is all that meets; maps are put one after the other.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, n, value = None, 0, 0.0
        for batch in batches:
            if not len(batch):
                continue
            first = first or (batch.ts.iloc[0], batch.seq.iloc[0])
            rewards = batch.reward.fillna(0.0).to_numpy(float)
            value = keep ** len(rewards) * value + (1 - keep) * float(keep ** np.arange(len(rewards) - 1, -1, -1) @ rewards)
            n += len(rewards)
        if first:
            yield pd.DataFrame({"ts": [first[0]], "seq": [first[1]], "n": [n], "value": [value]})

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("ts", "seq"))
    dealt = rows.select("ts", "seq", "reward").repartitionByRange("ts", "seq").sortWithinPartitions("ts", "seq")
    total, value = 0, 0.0
    for r in sorted(dealt.mapInPandas(fold, f"{kinds}, n long, value double").collect(), key=lambda r: (r.ts, r.seq)):
        total, value = total + r.n, keep**r.n * value + r.value
    return total, value


def running_reward(steps: DataFrame, keep: float = 0.99) -> DataFrame:
    """The exponential mean over all done steps in order: x, 0 at first, becomes keep * x + (1 - keep) * reward."""
    value = exponential_map(steps.filter("done"), keep)[1]
    return steps.sparkSession.createDataFrame([(value,)], "running_reward double")


def oldest_of_ready_workers(steps: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """The oldest step of each of n workers, chosen by a seeded hash."""
    first = steps.withColumn("place", F.row_number().over(Window.partitionBy("worker_id").orderBy(*ORDER))).filter("place = 1").drop("place")
    return sample_by_hash(first, "worker_id", n, seed)


def least_progressed(steps: DataFrame, n: int) -> DataFrame:
    """(worker_id, n_steps) of the n workers with the fewest steps; ties by id."""
    return steps.groupBy("worker_id").agg(F.count("*").alias("n_steps")).orderBy("n_steps", "worker_id").limit(n)


def force_finish(steps: DataFrame, most: int, action: str = "finish()") -> DataFrame:
    """Completed steps whose action is ``action`` from step ``most`` on."""
    return completed_steps(steps).withColumn("action", F.when(F.col("step") >= most, action).otherwise(F.col("action")))
