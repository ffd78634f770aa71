"""Toxicity: calibration and lexicon against plain loops, features by hand, held-out accuracy, odd rows."""

import zlib

import numpy as np

from loomtrace.llm.toxicity import FEATURES, Lexicon, _entries, _folded, features, isotonic, learn, toxicity
from loomtrace.sources.tables import table

NONE = Lexicon(np.empty(0, np.uint64), np.zeros((0, 1)))


def row_of(text, lexicon=NONE):
    data = np.frombuffer(text.encode(), np.uint8)
    return dict(zip(FEATURES, features(data, np.array([0, len(data)]), lexicon)[0], strict=True))


def entry(word, whole=False):
    """The hash of a whole word, or of all of it as a beginning."""
    data = np.frombuffer(word.encode(), np.uint8)
    found = [h[0] for w, h in _entries(_folded(data), np.array([0]), np.array([len(data)])) if len(w)]
    return found[-2] if whole else found[-1]


def test_features_by_hand():
    row = row_of("YOU id1ot!! sooo b a d, s*t ÉTÉ?")
    assert round(np.expm1(row["log_words"])) == 9
    assert row["second_person"] == 1 / 9 and row["shouted"] == 1 / 9
    assert row["lone_letters"] > 0
    assert row["bangs"] == 2 / 34 and row["mark_runs"] == 1 / 34 and row["inner_digits"] == 1 / 34 and row["inner_symbols"] == 1 / 34 and row["repeated_letters"] == 1 / 34
    assert row_of("") == dict.fromkeys(FEATURES, 0.0)


def test_words_by_their_beginnings_and_disguises():
    lexicon = Lexicon(np.sort(np.array([entry("idio"), entry("ÉTÉ", True)])), np.array([[2.0], [2.0]]))
    assert row_of("an Idiotic 1d1oTs été", lexicon)["tier0_density"] == 3 / 4
    # A beginning ends with a whole character, and a whole word is not the beginning of another.
    assert row_of("idi étés id io", lexicon)["weight"] == 0
    near, far = row_of("you are an idiot", lexicon), row_of("you " + "x " * 9 + "idiot", lexicon)
    assert near["near_second_person_density"] == 1 / 4 and far["near_second_person_density"] == 0
    # A text does not reach into the next one.
    data = np.frombuffer(b"youidiot", np.uint8)
    assert features(data, np.array([0, 3, 8]), lexicon)[:, FEATURES.index("near_second_person")].tolist() == [0, 0]


def test_isotonic_against_the_min_max_formula():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = np.round(rng.random(40), 1), (rng.random(40) < 0.4).astype(float)
        levels = np.unique(x)
        mean = lambda a, b: y[(x >= levels[a]) & (x <= levels[b])].mean()  # noqa: B023, E731
        wanted = [max(min(mean(a, b) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]
        found = isotonic(x, y)
        # Each level's step is the pooled one whose mean the formula gives.
        assert np.allclose(sorted(set(np.round(wanted, 9))), sorted(set(np.round(found.value, 9))))
        assert (np.diff(found(np.linspace(0, 1, 50))) >= 0).all()
    assert isotonic(np.empty(0), np.empty(0))(np.array([0.5])).tolist() == [0.0]


def test_lexicon_finds_planted_words(spark):
    rng = np.random.default_rng(5)
    usual = ["".join(rng.choice(list("abcdeilnorst"), 6)) for _ in range(300)]
    bad = [i % 5 == 0 for i in range(400)]
    texts = [" ".join([*rng.choice(usual, 40), *(["zyxwq" + e for e in ("a", "en", "é")] if b else [])]) for b in bad]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad)], "doc_id long, toxic int")
    model = learn(docs, labels)
    place = np.searchsorted(model.lexicon.hashes, entry("zyxwq"))
    assert model.lexicon.hashes[place] == entry("zyxwq") and model.lexicon.weights[place].min() > 3
    rows = toxicity(docs, labels).collect()
    assert all(r.predicted == bad[r.doc_id] for r in rows)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.93 * len(held)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "c d", "y"), (2, "a b", ""), (None, None, ""), (3, "", ""), (4, "w " * 60_000, ""), (5, "q" * 200_000, "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, None, 1), (4, 7, 0), (2, 0, 0), (2, 0, 0)], "doc_id long, toxic int, fold int")
    rows = toxicity(docs, labels).collect()
    assert len(rows) == 7 and {r.held_out for r in rows if r.doc_id is None} == {True}
    assert len({r.score for r in rows if r.doc_id == 2} | {r.score for r in rows if r.doc_id == 1}) <= 2
    assert toxicity(docs.limit(0), labels).collect() == []
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
