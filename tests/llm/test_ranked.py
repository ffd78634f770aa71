"""Ranked search against a plain loop over all items and documents, blocks of items and odd rows."""

import math
import re

import numpy as np

from loomtrace.llm.ranked import Best, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, most):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    out = []
    for item in {i for i, _ in items}:
        asked = {t for i, text in items if i == item for t in terms(text)}
        scores = []
        for doc, found in held:
            m = 10 + (90 * len(found) * n_docs) // length
            score = 0
            for t in asked & set(found):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in f for _, f in held) + 1)))
                score += w * ((10**9 * found.count(t)) // (1000 * found.count(t) + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:most], 1)]
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=str)


def test_against_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    vocabulary = ["The", "çà", "x1", "straße", "ÉTÉ", "été", "don't", "a_b", "[é]", "日本", "B", "b"]
    docs = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(1, 30)))) for i in range(150)]
    docs += [(7, "The the THE"), (7, "The the THE"), (None, "x1 B"), (900, None), (901, ""), (902, " ., \x7f"), (903, "b " * 50_000), (904, "The the THE"), (905, "q" * 100_000)]
    items = [(1, "the x1"), (2, "ÉTÉ çà nothing"), (2, "straße"), (None, "日本 b"), (4, None), (5, ""), (6, "q" * 100_000), (7, "the"), (7, "the")]
    frame = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, n int, terms string").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    wanted = plain(docs, items, 10)
    assert rows(ranked(frame, asked)) == wanted
    # The same with items in many blocks.
    assert rows(ranked(frame, asked, block_bytes=20_000)) == wanted
    assert rows(ranked(frame, asked, most=3)) == plain(docs, items, 3)
    assert rows(ranked(frame.limit(0), asked)) == [] and rows(ranked(frame, asked.limit(0))) == []


def test_best_keeps_ties_by_id():
    best = Best(2, 2)
    best.add(np.array([[5, 0], [5, 1]]), np.array([9, 8]), np.array([False, False]))
    best.add(np.array([[5, 0], [4, 7]]), np.array([3, 1]), np.array([False, True]))
    assert list(zip(best.item, best.score, best.doc, strict=True)) == [(0, 5, 3), (0, 5, 8), (1, 7, 1), (1, 1, 8)]
