"""Quality classifier: the flat forest against recursion, held-out accuracy, edge cases."""

import zlib

import numpy as np

from loomtrace.llm.quality import FEATURES, fit, keep_quality, quality, statistics
from loomtrace.sources.tables import table


def walk(forest, at, row, depth):
    if depth == 0 or forest.left[at] == at:
        return forest.value[at]
    below = forest.left if row[forest.feature[at]] <= forest.threshold[at] else forest.right
    return walk(forest, below[at], row, depth - 1)


def test_flat_traversal_against_recursion():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = fit(x, y, trees=20)
    raw = [forest.start + sum(walk(forest, r, row, forest.depth) for r in forest.roots) for row in x]
    assert np.allclose(forest.scores(x), 1 / (1 + np.exp(-np.array(raw))))
    assert ((forest.scores(x) >= 0.5) == y).mean() > 0.95
    assert np.allclose(fit(x[:0], y[:0]).scores(x[:3]), 0.5)
    assert (fit(x, np.ones(600)).scores(x) > 0.5).all()


def test_statistics_by_hand():
    data = np.frombuffer("Äb AB! ab ab\n".encode(), np.uint8)
    row = dict(zip(FEATURES, statistics(data, np.array([0, len(data)]))[0], strict=True))
    assert row["letters"] == 8 / 13 and row["upper"] == 2 / 8 and row["bangs"] == 1 / 13 and row["line_ends"] == 1 / 13
    assert row["distinct_words"] == 3 / 4 and row["repeats"] == 1 / 4 and row["distinct_pairs"] == 1.0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.95 * len(held)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, ""), (3, "", ""), (4, "w " * 60000, "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, None, 1), (4, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality(docs, labels).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    assert quality(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality(docs, labels.limit(0)).collect()} == {0.5}
    assert keep_quality(docs, labels.limit(0)).columns == docs.columns and keep_quality(docs, labels.limit(0)).count() == 5


def grown(x, y, trees, depth, rate, smooth, least):
    """Scores by trees grown with an exhaustive search over all distinct values, a row at a time."""
    base = (sum(y) + 0.5) / (len(y) + 1)
    raw = [float(np.log(base / (1 - base)))] * len(y)

    def split(rows, left):
        g, h = sum(slope[i] for i in rows), sum(bend[i] for i in rows)
        best = (1e-6, None)
        for j in range(len(x[0])) if left and len(rows) >= 2 * least else ():
            for cut in sorted({x[i][j] for i in rows}):
                low = [i for i in rows if x[i][j] <= cut]
                if least <= len(low) <= len(rows) - least:
                    gl, hl = sum(slope[i] for i in low), sum(bend[i] for i in low)
                    gain = gl**2 / (hl + smooth) + (g - gl) ** 2 / (h - hl + smooth) - g**2 / (h + smooth)
                    if gain > best[0] + 1e-12:
                        best = (gain, (j, cut))
        if best[1] is None:
            for i in rows:
                moved[i] = rate * g / (h + smooth)
            return
        j, cut = best[1]
        split([i for i in rows if x[i][j] <= cut], left - 1)
        split([i for i in rows if x[i][j] > cut], left - 1)

    for _ in range(trees):
        p = [1 / (1 + np.exp(-r)) for r in raw]
        slope, bend, moved = [b - a for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p], [0.0] * len(y)
        split(list(range(len(y))), depth)
        raw = [r + m for r, m in zip(raw, moved, strict=True)]
    return 1 / (1 + np.exp(-np.array(raw)))


def test_growing_against_exhaustive_search():
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(60, 3)), 2)
    y = ((x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=60) * 0.3) > 0.3).astype(float)
    options = dict(trees=6, depth=3, rate=0.3, smooth=1.0, least=4)
    # As many bins as rows, so that every distinct value is an edge.
    forest = fit(x, y, bins=2000, **options)
    assert np.allclose(forest.scores(x), grown(x.tolist(), y.tolist(), **options), atol=1e-9)
    assert ((forest.scores(x) > 0.5) == (y == 1)).mean() > 0.9
