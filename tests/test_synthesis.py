"""The synthesis loop: quotas, near tasks, empty rounds, and a run that is killed after each of its commits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtrace.plans.synthesis import SynthesisLoop

ROW = "id long, domain string, embedding array<double>, text string"


def candidates(number):
    rng = np.random.default_rng(number)
    rows = []
    for i in range(24):
        v = rng.normal(size=3)
        rows.append((number * 100 + i, "abc"[i % 3], v.tolist(), "bad" if i % 8 == 7 else f"task {i}"))
    return rows + [(number * 100 + 50, "a", rows[0][2], "a copy"), (number * 100 + 51, "z", [1.0, 0.0, 0.0], "no quota"), (None, "a", [1.0, 0.0, 0.0], "no id")]


def plain(quotas, threshold, rounds):
    held = []
    for number in range(rounds):
        batch = []
        for row in sorted((r for r in candidates(number) if r[0] is not None and r[3] != "bad" and r[1] in quotas), key=lambda r: r[0]):
            short = quotas[row[1]] - sum(h[1] == row[1] for h in held)
            unit = lambda v: np.array(v) / np.linalg.norm(v)
            near = lambda other: other[1] == row[1] and unit(other[2]) @ unit(row[2]) >= threshold  # noqa: B023, E731
            if short > 0 and not any(near(h) for h in held) and not any(near(b) for b in batch):
                batch.append(row)
        for domain, quota in quotas.items():
            short = quota - sum(h[1] == domain for h in held)
            held += [b for b in batch if b[1] == domain][: max(0, short)]
    return sorted(h[0] for h in held)


def loop(spark, path, quotas, asked):
    def propose(short, number):
        asked.append(number)
        return spark.createDataFrame(candidates(number), ROW)

    return SynthesisLoop(spark, path, spark.createDataFrame(list(quotas.items()), "domain string, quota long"), propose, F.col("text") != "bad", threshold=0.8)


def test_rounds_until_nothing_is_short(spark, tmp_path):
    quotas, asked = {"a": 3, "b": 5, "c": 0}, []
    synthesis = loop(spark, str(tmp_path / "s"), quotas, asked)
    rounds = synthesis.run(most=3)
    assert rounds == len(asked) and sorted(r.id for r in synthesis.tasks.read().collect()) == plain(quotas, 0.8, rounds)
    assert synthesis.index.read().count() == synthesis.tasks.read().count()


@pytest.mark.parametrize("at", ["rounds", "tasks", "vectors"])
def test_a_killed_run_ends_like_an_undisturbed_one(spark, tmp_path, monkeypatch, at):
    quotas, asked = {"a": 4, "b": 6}, []
    synthesis = loop(spark, str(tmp_path / "s"), quotas, asked)
    part, name = {"rounds": (synthesis, "_put"), "tasks": (synthesis.tasks, "upsert"), "vectors": (synthesis.index, "insert")}[at]
    original = getattr(part, name)

    def die(*args):
        if at != "rounds":
            original(*args)  # what the step did stays, and the run dies behind it
        raise KeyboardInterrupt

    monkeypatch.setattr(part, name, die)
    with pytest.raises(KeyboardInterrupt):
        synthesis.run(most=2)
    again = loop(spark, str(tmp_path / "s"), quotas, asked)
    rounds = again.run(most=2)
    assert sorted(r.id for r in again.tasks.read().collect()) == plain(quotas, 0.8, rounds)
    assert sorted(r.id for r in again.index.read().collect()) == sorted(r.id for r in again.tasks.read().collect())
    # Only a round that was not accepted asks again.
    assert asked == ([0, *range(rounds)] if at == "rounds" else list(range(rounds)))


def test_empty_rounds_end_it(spark, tmp_path):
    empty = lambda short, number: spark.createDataFrame([], ROW)
    synthesis = SynthesisLoop(spark, str(tmp_path / "s"), spark.createDataFrame([("a", 2)], "domain string, quota long"), empty, F.lit(True), patience=2)
    assert synthesis.run() == 2 and synthesis.run() == 2
