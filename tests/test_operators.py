"""Operators on small tables with the odd rows of each family."""

import datetime
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtrace.functions import actions, geometry, landed
from loomtrace.operators import compare, decks, dedup, memory, replay, sheets
from loomtrace.plans.catalog import QUERIES
from loomtrace.plans.expression import validate_tasks
from loomtrace.streaming.replay import replay_available

STEPS = "worker_id long, ts timestamp, seq long, action string, reward double, done boolean, is_init boolean"


def steps(spark, rows):
    day = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(w, day + datetime.timedelta(minutes=t), s, "a", r, d, i) for w, t, s, r, d, i in rows], STEPS)


EPISODES = [(1, 0, 0, None, False, True), (1, 1, 1, 1.0, False, False), (1, 1, 2, -2.0, False, False), (1, 2, 3, 4.0, True, False), (1, 3, 4, 8.0, True, False), (1, 4, 5, 9.0, False, False), (2, 0, 6, 5.0, False, False)]


@pytest.mark.parametrize("gamma", [0.0, 0.5, 1.0])
def test_returns(spark, gamma):
    got = {r.seq: (r.ep, r.step, r.g) for r in replay.discounted_returns(steps(spark, EPISODES), gamma).collect()}
    assert got == {1: (0, 1, 1 + gamma * (-2 + gamma * 4)), 2: (0, 2, -2 + gamma * 4), 3: (0, 3, 4.0), 4: (1, 1, 8.0)}


def test_views_of_the_buffer(spark):
    rows = steps(spark, EPISODES)
    assert [(r.seq, r.reward) for r in replay.outcome_only(rows).orderBy("seq").collect()] == [(3, 4.0), (4, 8.0)]
    assert {r.seq for r in replay.ring(rows, 2).collect()} == {4, 3} and replay.ring(rows, 100).count() == 4
    assert replay.outcome_reward(rows).first()[0] == 6.0 and replay.outcome_reward(rows.limit(0)).first()[0] == 0.0
    assert replay.running_reward(rows, 0.5).first()[0] == pytest.approx(0.5 * (0.5 * 4) + 0.5 * 8)
    assert replay.sample_by_hash(rows, "seq", 99).count() == 7 and replay.sample_by_hash(rows.limit(0), "seq", 5).count() == 0
    values = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.1, 0.5, 0.6, 0.7)], "v double")
    assert replay.balance(values, "v").first().asDict() == {"below": 2, "above": 4}
    assert sorted(r.v for r in replay.balanced(values, "v").collect()) == [0.0, 0.05]
    low = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.01, 0.1, 0.5)], "v double")
    assert [r.v for r in replay.balanced(low.filter("v <> 0.1"), "v").collect()] == [0.5]


def test_upsert_and_classes(spark):
    rows = spark.createDataFrame([("", 1, 1), ("", 2, 2), ("a", 3, 3), ("a", 4, 3)], "id string, v int, seq int")
    got = {r.id: (r.v, r.first_seen.seq) for r in memory.upsert(rows, ["id"], ["seq", "v"]).collect()}
    assert got == {"": (2, 1), "a": (4, 3)}
    flags = spark.createDataFrame([(a, b) for a in (None, False, True) for b in (None, False, True)], "e boolean, s boolean")
    found = {(r.e, r.s): r.c for r in flags.select("e", "s", memory.memory_class(F.col("e"), F.col("s")).alias("c")).collect()}
    assert found[True, True] == found[False, True] == "solvable" and found[True, None] == "executable" and found[None, None] == "failed"
    tasks, tested = spark.createDataFrame([(1,), (2,), (3,)], "id int"), spark.createDataFrame([(1, True), (2, None)], "id int, solvable boolean")
    assert {r.id for r in memory.pending(tasks, tested, "id").collect()} == {2, 3}


def test_greedy_against_a_loop(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 3))
    vectors[7] = 0
    vectors[9] = vectors[8]
    rows = [(i, int(i % 2), [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "id long, domain int, embedding array<double>")
    accepted, wanted = [], {}
    for i, d, v in rows:
        like = lambda w: 0.0 if not np.linalg.norm(v) or not np.linalg.norm(w) else np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)  # noqa: B023, E731
        hits = [j for j, e, w in accepted if e == d and like(w) >= 0.9]
        wanted[i] = (not hits, hits[0] if hits else None)
        if not hits:
            accepted.append((i, d, v))
    got = {r.id: (r.accepted, r.match) for r in dedup.greedy(frame, 0.9).collect()}
    assert got == wanted and not all(a for a, _ in wanted.values())
    chain = spark.createDataFrame([(0, 0, [1.0, 0.0]), (1, 0, [0.8, 0.6]), (2, 0, [0.28, 0.96])], "id long, domain int, embedding array<double>")
    assert {r.id: r.accepted for r in dedup.greedy(chain, 0.75).collect()} == {0: True, 1: False, 2: True}


def test_comparisons(spark):
    a = spark.createDataFrame([("f", 1, 2.5), ("f", 2, float("nan")), ("g", 1, 1.0)], "file string, at int, v double")
    b = spark.createDataFrame([("f", 1, 2.5000001), ("f", 2, float("nan")), ("g", 1, 1.0), ("g", 2, 0.0)], "file string, at int, v double")
    got = {r.file: r.score for r in compare.positional(a, b, ["file"], ["at"], "v", 4).collect()}
    assert got == {"f": 1.0, "g": 0.0} and {r.score for r in compare.positional(a, b, ["file"], ["at"], "v", 4, longest=False).collect()} == {1.0}
    assert [(r.file, r.kind) for r in compare.differences(a, b, ["file", "at"], "v", 4).collect()] == [("g", "added")]
    twice = spark.createDataFrame([(1,), (1,)], "x int")
    once = spark.createDataFrame([(1,)], "x int")
    assert compare.sets_equal(twice, once).first()[0] and not compare.bags_equal(twice, once).first()[0] and compare.bags_equal(once.limit(0), once.limit(0)).first()[0]


def test_sheets_and_decks(spark):
    schema = "pair int, side string, sheet string, row int, col int, text string, number double"
    cells = spark.createDataFrame([(1, s, "S", 1, 1, None, 2.00001) for s in ("result", "expected")] + [(1, "result", "S", 2, 1, " Ab-", None), (1, "expected", "S", 2, 1, "ab", None)], schema)
    score = lambda frame: frame.first().score
    assert score(sheets.sheet_data(cells, "S")) == 0.0 and score(sheets.sheet_fuzzy(cells, "S", ["A2"], strip_left=" ", strip_right="-", ignore_case=True)) == 1.0
    assert score(sheets.sheet_fuzzy(cells, "S", ["A2:B3"], "fuzzy_match", 60, ignore_case=True)) == 1.0 and score(sheets.sheet_names(cells)) == 1.0
    assert score(sheets.check_cell(cells, "S", "A1", "eq", None)) == 0.0
    with pytest.raises(ValueError):
        sheets.apply_rules(cells, cells, [{"type": "other"}])
    styled = cells.withColumn("style", F.lit("own"))
    formats = spark.createDataFrame([("S", 1, 1, 9, 9, 1, 3.0, 1.0, "red")], "sheet string, r0 int, c0 int, r1 int, c1 int, priority int, low double, high double, style string")
    assert {(r.row, r.style) for r in sheets.conditional_styles(styled, formats).collect()} == {(1, "red"), (2, "own")}
    near = spark.range(1).select(decks.near(F.lit(0), F.lit(0)).alias("a"), decks.near(F.lit(0), F.lit(1)).alias("b"), decks.near(F.lit(1000), F.lit(1004)).alias("c"), decks.same_underline(F.lit(None).cast("string"), F.lit("true")).alias("d"), decks.same_underline(F.lit(None).cast("string"), F.lit("false")).alias("e")).first()
    assert tuple(near) == (True, False, True, False, True)


def test_geometry_and_actions(spark):
    def smart(h, w):  # by hand for one small and one large picture
        return tuple(spark.range(1).select(geometry.resized(F.lit(h), F.lit(w)).alias("s")).first().s)

    assert smart(20, 20) == (56, 56) and smart(28, 84) == (56, 112)
    h, w = smart(1080, 1920)
    assert h % 28 == w % 28 == 0 and h * w <= 1_003_520 and abs(h / w - 1080 / 1920) < 0.05
    assert spark.range(1).select(geometry.resized(F.lit(1), F.lit(5)).alias("s")).first().s is None
    assert spark.range(1).select(geometry.picture_tokens(F.lit(1080), F.lit(1920))["seq_len"].alias("n")).first().n == (1092 * 1932) // 784 + 2
    made = spark.range(1).select(actions.action_list(F.lit("drag(1, 2, 3, 4)")).alias("x"), actions.action_list(F.lit("fly(1)")).alias("y"), actions.action_list(F.lit("type(a, b)")).alias("z")).first()
    assert [(a.action_type, a.parameters) for a in made.x] == [("MOVE_TO", {"x": "1", "y": "2"}), ("DRAG_TO", {"x": "3", "y": "4"})] and made.y is None and made.z[0].parameters == {"text": "a, b"}


def test_landed_texts(spark):
    text = 'version="9"\nname="A"\nenabled="yes"\ncondition="AND (subject,contains,\\"x\\") OR (from,is,y)"\nname="B"\nenabled="no"\n'
    found = spark.range(1).select(landed.mail_filters(F.lit(text)).alias("f")).first().f
    assert [f["name"] for f in found] == ["A", "B"] and found[0]["condition"].startswith('AND (subject,contains,"x")')
    parts = spark.range(1).select(landed.filter_conditions(F.lit(found[0]["condition"])).alias("c")).first().c
    assert parts == ['AND (subject,contains,"x")', "OR (from,is,y)"]
    prefs = F.lit('{"extensions": {"settings": {"a": {"path": "/x", "manifest": {"name": "N"}}, "b": {}}}}')
    assert spark.range(1).select(landed.extensions(prefs, ("manifest", "name")).alias("n")).first().n == ["N"]


def test_task_validation(spark):
    rows = [("ok", ["go(1)"], None, "f(g(1)) and len([1])"), ("bad", ["go("], ["fly()"], "1"), ("none", None, None, None)]
    tasks = spark.createDataFrame(rows, "id string, config array<string>, postconfig array<string>, eval string")
    found = {r.id: r.errors for r in validate_tasks(tasks, ["go"], ["f", "g"]).collect()}
    assert found["ok"] == [] and found["bad"] == ["config: syntax", "postconfig: unknown fly", "eval: no call"] and found["none"] == ["eval: syntax"]


def test_stream_equals_batch(spark):
    rows = [(1, datetime.datetime(2024, 1, 1, 0, m), e, u, k, float(v)) for m, e, u, k, v in ((0, 1, 1, "signup", 0), (1, 2, 1, "view", 3), (1, 3, 1, "purchase", 5), (2, 4, 1, "view", 7), (0, 5, 2, "purchase", 1))]
    events = spark.createDataFrame([(e, ts, u, k, v) for _, ts, e, u, k, v in rows], "event_id long, ts timestamp, user_id long, event_type string, value double")
    got = sorted(tuple(r) for r in replay_available(spark, events, 0.5).collect())
    wanted = sorted((r.worker_id, r.ep, r.step, r.seq, r.g) for r in replay.discounted_returns(replay.steps_of_events(events), 0.5).collect())
    assert got == wanted and len(got) == 3


def test_task_text_reads_past_the_first_characters(spark, tmp_path):
    texts = ["x" * 80 + " one", "x" * 80 + " two", "x" * 80]
    rows = [(2 * i + 1, t, "en") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    bodies = {r.doc_id: r.body for r in QUERIES["q_task_text"](spark, str(tmp_path)).collect()}
    assert bodies == {i: hashlib.md5(t.encode()).hexdigest() for i, t, _ in rows}


def test_decks_differ_in_one_thing(spark):
    slide = dict(slide=2, background="FFFFFF", notes="n")
    shape = dict(slide=2, shape=0, kind="picture", left=5000000.0, top=1000000.0, width=10.0, height=20.0, text=None)
    run = dict(slide=2, shape=0, paragraph=0, run=0, text="t", font="f", size="12", bold=None, italic=None, strike=None, underline=None, color=None, alignment=None, level=None, bullet=None, bullet_level=None)
    cell = dict(slide=2, shape=0, row=0, col=0, paragraph=0, run=0, bold=None, italic=None, underline=None, color="000000")
    kinds = {"slides": (slide, ("slide",)), "shapes": (shape, ("slide", "shape", "left", "top", "width", "height")), "runs": (run, ("slide", "shape", "paragraph", "run")), "table_runs": (cell, ("slide", "shape", "row", "col", "paragraph", "run"))}
    # pair -> (frame, column, the value expected in place of the result's), (options), score
    cases = [
        ("slides", "notes", " n ", {}, 1), ("slides", "notes", "m", {}, 0), ("slides", "notes", "m", {"examine_note": False}, 1),
        ("slides", "background", None, {}, 0), ("slides", "background", None, {"examine_background_color": False}, 1),
        ("runs", "level", "0", {}, 1), ("runs", "level", "1", {}, 0), ("runs", "level", "1", {"examine_indent": False}, 1),
        ("runs", "bullet", "*", {}, 0), ("runs", "bullet", "*", {"examine_bullets": False}, 1), ("runs", "bullet_level", "1", {}, 0),
        ("table_runs", "bold", "true", {"examine_font_bold": False}, 0), ("table_runs", "bold", "false", {}, 1), ("table_runs", "color", "FF0000", {}, 0), ("table_runs", "color", "FF0000", {"examine_color_rgb": False}, 1),
        ("shapes", "width", 30.0, {"examine_shape": False}, 1), ("shapes", "width", 30.0, {"examine_shape": False, "examine_image_size": True}, 0), ("shapes", "left", 1.0, {"examine_shape": False, "examine_image_size": True}, 1),
        ("shapes", "width", 30.0, {"examine_shape": False, "examine_modify_height": True}, 1), ("shapes", "height", 30.0, {"examine_shape": False, "examine_modify_height": True}, 0),
        ("shapes", "top", 2000000.0, {"examine_shape": False, "examine_top_position": True}, 1), ("shapes", "top", 9.0, {"examine_shape": False, "examine_top_position": True}, 0),
        ("shapes", "left", 9.0, {"examine_shape": False, "examine_right_position": True}, 1), ("shapes", "left", 6000000.0, {"examine_shape": False, "examine_right_position": True}, 0),
        ("shapes", "left", 9.0, {"examine_shape": False, "examine_shape_for_shift_size": True}, 0), ("shapes", "top", 9.0, {"examine_shape": False, "examine_table_bottom_position": True}, 0), ("shapes", "top", 9.0, {"examine_shape": False, "examine_title_bottom_position": True}, 0),
    ]
    by_options = {}
    for pair, case in enumerate(cases):
        by_options.setdefault(tuple(case[3].items()), []).append((pair, *case))
    for options, group in by_options.items():
        frames = {}
        for name, (row, numbers) in kinds.items():
            schema = "pair int, side string, " + ", ".join(f"{c} {('double' if isinstance(v, float) else 'int') if c in numbers else 'string'}" for c, v in row.items())
            rows = [(pair, side, *{**row, **({column: value} if side == "expected" and frame == name else {})}.values()) for pair, frame, column, value, *_ in group for side in ("result", "expected")]
            frames[name] = spark.createDataFrame(rows, schema)
        got = {r.pair: r.score for r in decks.compare_decks(**frames, **dict(options)).collect()}
        assert got == {pair: float(case[-1]) for pair, *case in group}, options
    with pytest.raises(ValueError):
        decks.compare_decks(**frames, examine_nothing=True)


def test_data_validation_is_a_rule(spark):
    cells = spark.createDataFrame([(i, "result", "S", 1, 1, "a", None) for i in (1, 2, 3)], "pair int, side string, sheet string, row int, col int, text string, number double")
    validators = spark.createDataFrame([(1, {"type": "list"}), (2, {"type": "whole"})], "pair int, fields map<string, string>")
    rules = [{"type": "data_validation", "wanted": [{"type": ("eq", "list")}]}]
    assert {r.pair: r.score for r in sheets.apply_rules(cells, cells, rules, validators).collect()} == {1: 1.0, 2: 0.0, 3: 0.0}
    with pytest.raises(ValueError):
        sheets.apply_rules(cells, cells, rules)


def test_near_pairs_of_cells_and_blocks_are_those_of_all_pairs(spark, monkeypatch):
    import numpy as np

    from loomtrace.operators import dedup

    monkeypatch.setattr(dedup, "BLOCK", 25)
    monkeypatch.setattr(dedup, "SALT", 60)
    monkeypatch.setattr(dedup, "STRIPE", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, "hot" if i % 3 else f"d{i % 5}", (centres[rng.integers(12)] + rng.normal(size=16) * 0.35).tolist()) for i in range(400)]
    rows += [(400, "hot", [0.0] * 16), (401, "hot", rows[1][2]), (402, None, rows[0][2]), (403, "lone", rows[0][2])]
    frame = spark.createDataFrame(rows, "id long, domain string, embedding array<double>")
    units = {i: np.array(v) / (np.linalg.norm(v) or 1) for i, _, v in rows}
    for threshold in (0.9, 0.5, -0.2):
        wanted = {(a, b) for a, da, _ in rows for b, db, _ in rows if b < a and da is not None and da == db and units[a] @ units[b] >= threshold}
        got = dedup.near_pairs(frame, frame, threshold, earlier=True).collect()
        assert len(got) == len(wanted) and {(r.id, r.other) for r in got} == wanted
    pivots = dedup.pivots_of(dedup.vectors(frame)).groupBy("domain").count().collect()
    assert {r.domain: r["count"] for r in pivots}["hot"] == 11 and all(r["count"] > 1 for r in pivots)
    assert dedup.near_pairs(frame.limit(0), frame, 0.5).collect() == [] and dedup.near_pairs(frame, frame.limit(0), 0.5).collect() == []


def test_near_pairs_of_many_domains(spark):
    from loomtrace.operators import dedup

    frame = spark.range(10_000).selectExpr("id", "concat('d', id div 2) as domain", "array(1.0, id % 2 * 0.1) as embedding")
    found = dedup.near_pairs(frame, frame, 0.9, earlier=True).collect()
    assert len(found) == 5_000 and all(r.id == r.other + 1 and r.domain == f"d{r.other // 2}" for r in found)


def test_returns_of_long_episodes(spark):
    from loomtrace.operators.replay import discounted_returns, running_reward

    rewards = [((i * 37) % 11) / 7 - 0.5 for i in range(700)]
    rows = [(1, i, i, "a", r if i % 50 else None, i == 699, False) for i, r in enumerate(rewards)] + [(2, 0, 1000, "a", 3.0, True, False), (2, 1, 1001, "a", 4.0, False, False)]
    steps = spark.createDataFrame(rows, "worker_id long, ts long, seq long, action string, reward double, done boolean, is_init boolean")
    for gamma in (0.9, 0.999, 1.0, 0.0):
        g, wanted = 0.0, {}
        for i in range(699, -1, -1):
            g = (rewards[i] if i % 50 else 0.0) + gamma * g
            wanted[i + 1] = g
        got = {r.step: r.g for r in discounted_returns(steps.filter("worker_id = 1"), gamma).collect()}
        assert len(got) == 700 and all(abs(got[k] - v) < 1e-9 for k, v in wanted.items())
    assert [(r.worker_id, r.step, r.g) for r in discounted_returns(steps.filter("worker_id = 2")).collect()] == [(2, 1, 3.0)]
    done = steps.selectExpr("ts", "seq", "reward", "true as done").filter("reward is not null")
    x = 0.0
    for r in sorted(done.collect()):
        x = 0.9 * x + 0.1 * r.reward
    assert abs(running_reward(done, keep=0.9).first()[0] - x) < 1e-12


def test_ranges_by_tiles_against_all_pairs(spark):
    import numpy as np

    from loomtrace.operators.compare import in_ranges, last_range

    rng = np.random.default_rng(2)
    ranges = [(str(s), n, int(r), int(c), int(r + h - 1), int(c + w - 1)) for n, (s, r, c, h, w) in enumerate(zip(rng.integers(0, 2, 400), rng.integers(1, 5000, 400), rng.integers(1, 300, 400), 8 ** rng.uniform(0, 4.2, 400), 8 ** rng.uniform(0, 2.5, 400), strict=True))]
    ranges += [("0", 900, 10, 10, 9, 20), ("0", 901, None, 1, 5, 5), ("0", 902, 1, 1, 1_048_576, 16_384), ("0", 902, 1, 1, 1_048_576, 16_384), ("0", 903, 8, 8, 8, 8)]
    cells = [(str(s), int(r), int(c)) for s, r, c in zip(rng.integers(0, 3, 600), rng.integers(1, 5200, 600), rng.integers(1, 320, 600), strict=True)] + [("0", 8, 8)]
    cells = sorted(set(cells))
    wanted = sorted((s, r, c, n) for s, r, c in cells for t, n, r0, c0, r1, c1 in ranges if s == t and r0 is not None and r0 <= r <= r1 and c0 <= c <= c1)
    left = spark.createDataFrame(cells, "sheet string, row long, col long")
    right = spark.createDataFrame(ranges, "sheet string, rule long, r0 long, c0 long, r1 long, c1 long")
    assert sorted((x.sheet, x.row, x.col, x.rule) for x in in_ranges(left, right, ["sheet"]).collect()) == wanted
    last = {(x.sheet, x.row, x.col): x.rule for x in last_range(left, right, ["sheet"], ["rule"], ["rule"]).collect()}
    assert last == {(s, r, c): max(n for *k, n in wanted if tuple(k) == (s, r, c)) for s, r, c, _ in wanted}


def test_range_totals_without_the_pairs(spark):
    """Counts and last rules of cells and ranges against all pairs, and of two thousand million pairs that are not made."""
    from collections import Counter

    import numpy as np

    from loomtrace.operators.compare import range_totals

    rng = np.random.default_rng(3)
    ranges = [("a", n, int(r), int(c), int(r + h), int(c + w)) for n, (r, c, h, w) in enumerate(zip(rng.integers(-40, 60, 300), rng.integers(-9, 30, 300), rng.integers(-3, 70, 300), rng.integers(-1, 20, 300), strict=True))]
    ranges += [ranges[0]] * 2 + [("b", 5, None, 1, 5, 5), ("a", 900, 0, 0, 2**40, 16_384), (None, 901, 0, 0, 9, 9)]
    cells = [(i, "ab"[i % 7 == 0], int(r), int(c)) for i, (r, c) in enumerate(zip(rng.integers(-60, 150, 500), rng.integers(-12, 60, 500), strict=True))] + [(900, "a", None, 3), (901, "a", 5, 5), (902, "a", 5, 5)]
    hits, last = Counter(), {}
    for i, s, r, c in cells:
        for t, n, r0, c0, r1, c1 in ranges:
            if s == t and None not in (r, r0) and r0 <= r <= r1 and c0 <= c <= c1:
                hits[i], last[i] = hits[i] + 1, max(n, last.get(i, n))
    left = spark.createDataFrame(cells, "id long, sheet string, row long, col int")
    right = spark.createDataFrame(ranges, "sheet string, rule long, r0 long, c0 long, r1 long, c1 long")
    found = {x.id: (x.hits, x["last"]) for x in range_totals(left, right, ["sheet"], "rule").collect()}
    assert found == {i: (n, last[i]) for i, n in hits.items()}
    all_cells = spark.range(100_000).selectExpr("'s' as sheet", "id % 900 + 60 as row", "id % 101 as col")
    all_ranges = spark.range(20_000).selectExpr("'s' as sheet", "id as rule", "id % 50 as r0", "-(id % 40) as c0", "id + 1000 as r1", "id % 13 + 100 as c1")
    totals = range_totals(all_cells, all_ranges, ["sheet"], "rule").groupBy("hits", "last").count().collect()
    assert [tuple(r) for r in totals] == [(20_000, 19_999, 100_000)]


def test_tasks_of_compared_decks_grow_with_the_table(spark, sf_dir, tmp_path):
    from loomtrace.plans.office_queries import DECK_TASKS, deck_compare

    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    items.repartition(30).write.option("maxRecordsPerFile", 300).parquet(str(tmp_path / "lineitem.parquet"))
    splits = spark.read.parquet(str(tmp_path / "lineitem.parquet")).rdd.getNumPartitions()
    frame = deck_compare(spark, str(tmp_path))
    assert "hashpartitioning(pair#" in frame._jdf.queryExecution().toString() and f", {DECK_TASKS * splits})" in frame._jdf.queryExecution().toString().replace(", REPARTITION_BY_NUM", ")")
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, deck_compare(spark, sf_dir).collect()))


def test_a_row_that_meets_many_cells_leaves_python_once(spark):
    """What chooses cells gives one row for each vector; the copies for each cell are made by a generator after it."""
    import numpy as np

    from loomtrace.operators import dedup

    rng = np.random.default_rng(4)
    values = [[float(x) for x in rng.normal(size=4)] for _ in range(50)]
    rows = spark.createDataFrame([(i, "d", v) for i, v in enumerate(values)], "id long, domain string, embedding array<double>")
    pivots = spark.createDataFrame([("d", c, values[c]) for c in range(6)], "domain string, cell int, pivot array<double>")
    cells = spark.createDataFrame([("d", c, 3.2, 1) for c in range(6)], "domain string, cell int, radius double, n long")
    met = dedup.meet(rows, pivots, cells, 0.0)
    assert sorted((r.id, r.cell) for r in met.collect()) == [(i, c) for i in range(50) for c in range(6)]
    assert {r.id: r.n for r in met.groupBy("id").agg({"u": "count"}).withColumnRenamed("count(u)", "n").collect()} == dict.fromkeys(range(50), 6)
    assert "explode(cells" in met._jdf.queryExecution().optimizedPlan().toString()
