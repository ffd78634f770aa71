"""Checks of documents, archives and pages on small tables."""

import math

from pyspark.sql import functions as F

from loomtrace.operators import documents as D


def scores(frame, key="pair"):
    return {r[key]: r.score for r in frame.collect()}


def test_runs_and_paragraphs(spark):
    runs = spark.createDataFrame([("f", 0, 0, "one", True, 14.0, False, False), ("f", 1, 0, "TWO", False, 10.0, True, True), ("g", 0, 0, "x", True, 12.0, None, False)], "file string, paragraph int, run int, text string, italic boolean, size double, strike boolean, page_break boolean")
    assert scores(D.italic_at_size(runs), "file") == {"f": 1.0, "g": 0.0}
    assert scores(D.last_paragraph_struck(runs), "file") == {"f": 1.0, "g": 0.0}
    assert scores(D.page_breaks(runs, 1), "file") == {"f": 1.0, "g": 0.0} == scores(D.page_breaks(runs), "file")
    assert scores(D.no_run(runs, (F.col("text") == F.upper("text")) & F.col("text").rlike("[A-Z]")), "file") == {"f": 0.0, "g": 1.0}
    paragraphs = spark.createDataFrame([("f", 0, "a b c\td e. x", 1.0), ("f", 1, "p q r\ts", 2.0)], "file string, paragraph int, text string, spacing double")
    assert scores(D.spacing_of_first(paragraphs, [1.0, 2.0]), "file") == {"f": 1.0} == scores(D.first_words_lead(paragraphs), "file")
    lines = spark.createDataFrame([("f", "1,A,x,y"), ("f", "2,A,x,y"), ("f", "3, B,x,y"), ("f", "bad")], "file string, text string")
    assert D.unique_field(lines).first().n == 2


def test_pairs(spark):
    cells = spark.createDataFrame([(1, s, 0, 0, 0, t) for s, t in (("result", " a "), ("expected", "a"))] + [(2, "result", 0, 0, 0, "a")], "pair int, side string, table int, row int, col int, text string")
    assert scores(D.tables_equal(cells)) == {1: 1.0, 2: 0.0}
    refs = spark.createDataFrame([(1, s, p, t) for s in ("result", "expected") for p, t in ((0, "x"), (1, "References"), (2, "abcd" if s == "result" else "abce"))], "pair int, side string, paragraph int, text string")
    assert scores(D.references_likeness(refs)) == {1: 0.75}
    members = spark.createDataFrame([(1, "result", "a", "d", "x\ny"), (1, "expected", "a", "d", "x\nz"), (2, "result", "a", "d", ""), (2, "expected", "b", "d", "")], "pair int, side string, name string, digest string, text string")
    assert scores(D.archives_likeness(members)) == {1: 1.0, 2: 0.0} and scores(D.archives_likeness(members, True)) == {1: 0.5, 2: 0.0}
    nodes = spark.createDataFrame([(1, "result", 0, "p", "t ", {"k": "1", "n": "2"}), (1, "expected", 0, "p", "t", {"k": "1", "n": "3"}), (1, "expected", 1, "b", "", {})], "pair int, side string, node int, tag string, text string, attributes map<string,string>")
    assert scores(D.pages_equal(nodes)) == {1: 0.0} and scores(D.pages_equal(nodes, ("n",))) == {1: 1.0}
    frames = spark.createDataFrame([(1, s, a, 255 if s == "result" and a < 2 else 0) for s in ("result", "expected") for a in range(9)], "pair int, side string, at int, hash long")
    assert scores(D.video_frames_alike(frames)) == {1: 1.0} and scores(D.video_frames_alike(frames, 1)) == {1: 0.0}
    sound = spark.createDataFrame([(1, 2.0, 4, False, False), (2, None, None, True, True), (3, None, None, True, False)], "pair int, cost double, steps int, result_bad boolean, expected_bad boolean")
    assert scores(D.audio_score(sound)) == {1: math.exp(-0.5), 2: 1.0, 3: 0.0}
    images = spark.createDataFrame([(1, "result", 0, "d"), (1, "expected", 0, "d"), (1, "expected", 1, "e")], "pair int, side string, at int, digest string")
    assert scores(D.images_equal(images)) == {1: 0.0}
