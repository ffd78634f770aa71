"""Near duplicates against brute force over all pairs."""

import random
import re

import pytest

from loomtrace.llm.near_duplicates import drop_near_duplicates, near_duplicates
from loomtrace.sources.tables import table

SCHEMA = "doc_id long, text string, kept string, node string"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, size=5):
    found = words_of(text)
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if len(found) >= size else ({tuple(found)} if found else set())


def brute(rows, percent):
    """(doc_id, n, component, kept) of rows (doc_id, text) with distinct ids, by all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, a in enumerate(ids):
        for b in ids[p + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def got(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_documents_table_against_brute_force(spark, sf_dir, percent):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(near_duplicates(docs, percent=percent)) == brute(rows, percent)


def test_groups_chains_and_edge_cases_against_brute_force(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocabulary) for _ in range(150)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    texts = [None, "", " \n", "one", "ONE", "one two three", "x" * 3000, "é é é é é é", "É é é é é é"]
    texts += [" ".join(base)] * 5
    for i in range(60):  # near copies, from close to far
        copy = list(base)
        for _ in range(i // 4):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
        texts.append(" ".join(copy))
    for i in range(40):  # short documents that share one passage
        texts.append(passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(i)))
    chain = [rnd.choice(vocabulary) for _ in range(300)]
    for i in range(12):  # each is near the next only
        texts.append(" ".join(chain[i * 12 : i * 12 + 200]))
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    for percent in (80, 85):
        assert got(near_duplicates(frame, percent=percent)) == brute(rows, percent)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "a b c d e f g"
    frame = spark.createDataFrame([(1, text, "", ""), (1, text, "", ""), (None, text, "", ""), (2, text.upper(), "", ""), (3, None, "", "")], SCHEMA)
    rows = [tuple(r) for r in near_duplicates(frame).collect()]
    assert sorted(rows, key=str) == sorted([(1, 3, 1, True), (1, 3, 1, True), (None, 3, None, True), (2, 3, 1, False), (3, 0, 3, True)], key=str)
    assert near_duplicates(frame.limit(0)).collect() == []
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1, 3]


def test_rows_that_share_a_doc_id(spark):
    t, u, v = ("a b c d e f g h", "p q r s t u v w", "k l m n o p q r")
    rows = [(3, t), (5, t), (5, u), (7, v), (7, v), (7, v + " x"), (8, v.upper()), (None, t), (9, ""), (9, "")]
    frame = spark.createDataFrame([(i, x, "", "") for i, x in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(frame).collect()]
    assert sorted(kept, key=str) == sorted([(3, t), (5, u), (7, v), (7, v), (7, v + " x"), (None, t), (9, ""), (9, "")], key=str)
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame).collect()), key=str)
    assert found == sorted([(3, 3, True), (5, 3, False), (5, 5, True), (7, 7, True), (7, 7, True), (7, 7, True), (8, 7, False), (None, None, True), (9, 9, True), (9, 9, True)], key=str)


@pytest.mark.parametrize("few", [0, 48])
def test_families_that_share_most_of_a_passage(spark, monkeypatch, few):
    """Many documents share a long passage and are not linked, some are; also with every open list sent by whole sets."""
    from loomtrace.llm import near_duplicates as module

    monkeypatch.setattr(module, "FEW", few)
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(5000)}"
    passage = [word() for _ in range(120)]
    texts = [" ".join(passage + [word() for _ in range(rnd.randrange(8, 60))]) for _ in range(90)]
    texts += [t + " one two" for t in texts[:10]] + [" ".join(t.split()[:-2]) for t in texts[20:40]]
    small = [word() for _ in range(22)]
    texts += [" ".join(small[:20] + [word() for _ in range(rnd.randrange(3))]) for _ in range(70)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    for percent in (80, 85):
        assert got(near_duplicates(frame, percent=percent)) == brute(rows, percent)


def test_a_very_long_text_and_its_copy(spark):
    rnd = random.Random(2)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(300_000))
    frame = spark.createDataFrame([(1, long, "", ""), (2, long + " end", "", ""), (3, "x" * 10**6, "", "")], SCHEMA)
    assert got(near_duplicates(frame)) == [(1, 299_996, 1, True), (2, 299_997, 1, False), (3, 1, 3, True)]


def test_components_of_a_long_path_take_few_rounds(spark):
    from loomtrace.llm.components import connected_components
    from loomtrace.llm.scratch import Scratch

    class Counting(Scratch):
        rounds = 0

        def keep(self, frame, name):
            self.rounds += name == "edges"
            return super().keep(frame, name)

    rnd = random.Random(4)
    for nodes in (list(range(1024)), rnd.sample(range(1024), 1024)):
        edges = spark.createDataFrame([*zip(nodes, nodes[1:], strict=False), (5000, 6000), (7000, 7000)], "a long, b long")
        scratch = Counting(spark, "components")
        labels = {r.node: r.label for r in connected_components(edges, scratch).collect()}
        assert labels == {**dict.fromkeys(range(1024), 0), 5000: 5000, 6000: 5000, 7000: 7000}
        assert scratch.rounds <= 14
