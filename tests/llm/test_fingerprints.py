"""Fingerprints against brute force: the order of documents, the edit, the anchors and the likeness."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from loomtrace.llm import fingerprints as module
from loomtrace.llm.fingerprints import K, S, anchors, fingerprints, marks_of
from loomtrace.llm.queries import QUERIES
from loomtrace.sources.tables import table


ENDS, INSIDE = "[aeoAEO0-9\\x80-\U0010ffff]", "[^aeoAEO0-9 \\x09-\\x0D\\x80-\U0010ffff]"


def letters_of(text):
    return re.findall(f"{INSIDE}{{0,15}}{ENDS}|{INSIDE}{{1,16}}", text or "")


def hashes(spark, items):
    """xxhash64 of tuples of words or numbers, by the engine."""
    from pyspark.sql import functions as F

    items = list(dict.fromkeys(items))
    if not items:
        return {}
    kind = "string" if isinstance(items[0][0], str) else "long"
    names = [f"c{i}" for i in range(len(items[0]))]
    frame = spark.createDataFrame(items, ", ".join(f"{n} {kind}" for n in names))
    return {tuple(r)[:-1]: r.h for r in frame.select(*names, F.xxhash64(*names).alias("h")).collect()}


def brute(spark, texts):
    """Marks of texts: (k-mer or whole sequence, letters from the anchor before)."""
    pairs = hashes(spark, [p for t in texts for p in zip(letters_of(t), letters_of(t)[1:])])
    out = []
    for t in texts:
        w = letters_of(t)
        g = [pairs[p] for p in zip(w, w[1:])]
        inner = K - S + 1
        at = [i for i in range(len(g) - inner + 1) if min(g[i : i + inner]) in (g[i], g[i + inner - 1])]
        if len(g) < inner:
            out.append([(tuple(w), 0)] if w else [])
        else:
            out.append([(tuple(w[i : i + K]), i - ([i] + at)[n]) for n, i in enumerate(at)])
            assert all(0 <= gap <= K - S for _, gap in out[-1])
    return out


def expected(spark, rows):
    """Rows (doc_id, text) in order, with distinct ids."""
    rows = sorted((i, t or "") for i, t in rows)
    texts, edited, out = [t for _, t in rows], [], []
    for p, (_, t) in enumerate(rows):
        after = texts[(p + 1) % len(rows)]
        m = len(t) // 4
        edited.append(t[: len(t) - m] + after[:m])
    sets = [frozenset(x) for x in brute(spark, texts + edited)]
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    n = len(rows)
    for p, (i, t) in enumerate(rows):
        out.append((i, len(t), hashlib.sha256(edited[p].encode()).hexdigest(), like(sets[p], sets[n + p]), like(sets[p], sets[(p + 1) % n])))
    return out


def got(frame):
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in frame.collect())


def test_documents_against_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(module, "PIECE_ROWS", 13)
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(fingerprints(docs)) == expected(spark, rows)


def test_small_and_odd_texts(spark):
    rnd = random.Random(8)
    texts = ["", " ", "a", "b", "a b", "é" * 7, "🙂 x y z 🙂 x y z 🙂", "x" * 50000, "the same text as the next one has", "the same text as the next one has"]
    texts += [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (5, 6, 7, 8, 40, 900)] + [None]
    rows = [(10**12 if i == 3 else 5 * i - 20, t, "f") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    result = fingerprints(docs).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in result) == expected(spark, [r[:2] for r in rows])
    same = {r.fingerprint for r in result if r.doc_id in (20, 25)}
    assert len(same) == 1 and len({r.fingerprint for r in result}) > 10


def test_repeated_rows_null_ids_one_row_and_none(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "e"), (None, "abcd")], schema)
    rows = fingerprints(docs).collect()
    assert len(rows) == 4
    outside = next(r for r in rows if r.doc_id is None)
    assert outside.edited_sha256 == hashlib.sha256(b"abc").hexdigest() and outside.near_next == 0.0
    one = fingerprints(docs.filter("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints(docs.limit(0)).collect() == []


def test_anchors_are_context_free(spark):
    rnd = random.Random(1)
    middle = " ".join(f"w{rnd.randrange(500)}" for _ in range(300))
    docs = spark.createDataFrame([(1, middle), (2, "one two three " + middle + " four")], "doc_id long, text string")
    shift = len(letters_of("one two three"))
    found = {}
    for r in anchors(docs).collect():
        found.setdefault(r.doc_id, set()).add((r.position, r.anchor))
    assert {(p + shift, a) for p, a in found[1]} <= found[2] and len(found[1]) > 60


def test_short_and_unspaced_texts(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    texts = [" ".join(word() for _ in range(n)) for n in (8, 11, 20)] + ["".join(chr(0x4E00 + rnd.randrange(900)) for _ in range(n)) for n in (30, 3000)]
    texts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)), "", " ", "a", "seven77", "🙂 x y z 🙂 x y z 🙂", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(fingerprints(docs).collect(), key=lambda r: r.doc_id)
    assert got(fingerprints(docs)) == expected(spark, list(enumerate(texts)))
    assert all(0 < r.near_edited < 1 for r in rows[:6]) and all(r.near_edited > 0.5 for r in rows[4:6])


def test_fingerprints_hold_the_marks_that_likeness_compares(spark):
    rnd = random.Random(7)
    texts = [" ".join(f"w{rnd.randrange(300)}" for _ in range(n)) for n in (0, 1, 30, 400)]
    rows = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    both = rows.select("near_edited", marks_of(F.col("fingerprint")).alias("a"), marks_of(F.col("edited_fingerprint")).alias("b"), "n_anchors").collect()
    for r in both:
        a, b = set(r.a), set(r.b)
        assert len(r.a) == r.n_anchors and r.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)


def test_an_edit_keeps_the_marks_around_it(spark):
    rnd = random.Random(3)
    w = [f"word{rnd.randrange(900)}" for _ in range(300)]
    inserted, head = w[:150] + ["brand", "new", "words"] + w[150:], ["some", "heading"] + w
    frame = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate((w, inserted, head))], "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints(frame).collect()}
    assert found[0].near_next > 0.9 and found[1].near_next > 0.9


def test_pieces_of_an_order(spark, monkeypatch):
    from loomtrace.llm import pieces

    monkeypatch.setattr(pieces, "COARSE", 40)
    rnd = random.Random(1)
    values = [rnd.choice([rnd.randrange(10**6), -rnd.randrange(10**12), 77]) for _ in range(6000)] + [None]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for rows in (10**6, 400, 20):
        found = sorted((r.v, r.piece) for r in pieces.with_pieces(frame, "v", rows).collect() if r.v is not None)
        assert len(found) == 6000 and [p for _, p in found] == sorted(p for _, p in found)
        of = {}
        for v, p in found:
            of.setdefault(p, []).append(v)
        assert max(sum(v != 77 for v in x) for x in of.values()) <= max(8 * rows, 60) and len(of) >= min(6000 // rows, 1) / 2


def test_the_query_leaves_no_text_of_some_length_without_likeness(spark, sf_dir):
    rows = [r for r in QUERIES["op9_fingerprints"](spark, sf_dir).collect() if r.n_chars >= 40]
    assert len(rows) > 100 and all(r.near_edited > 0 for r in rows)
