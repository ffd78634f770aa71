"""Language identification: phrases against brute force, held-out accuracy, edge cases."""

import random
import time
import zlib

import numpy as np

from loomtrace.llm import language
from loomtrace.llm.language import CrossParser, identify, keep_identified, language_id, training_sample
from loomtrace.sources.tables import table


def encoded(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def phrases(text, rows):
    """Greedy longest matches of a folded text, from its first byte to its last, in any of the rows."""
    count = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and any(text[i:j] in row for row in rows):
            j += 1
        i, count = max(i + 1, j - 1), count + 1
    return count


def check_phrases(sample, texts):
    parser = CrossParser(sample)
    rows = {lang: [language._fold(t) for own, t in sample if own == lang] for lang in parser.langs}
    folded, at = language._encode(*encoded(texts))
    found = parser.phrases(folded, at)
    for k, lang in enumerate(parser.langs):
        for i, text in enumerate(texts):
            own = language._fold(text)
            own += b" " if text and not text[-1].isalpha() and own else b""
            assert folded[at[i] : at[i + 1]].tobytes() == own
            assert found[k, i] == phrases(own, rows[lang]), (lang, text)


def test_phrases_against_brute_force():
    rnd = random.Random(3)
    sample = tuple((lang, "".join(rnd.choice(letters) for _ in range(400))) for lang, letters in (("x", "abc "), ("y", "bcdé "), ("y", "abcd,")))
    texts = ["", "a", "zzz", "ab cd", " !! ", "".join(rnd.choice("abcdéz .") for _ in range(2500))]
    check_phrases(sample, texts + ["".join(rnd.choice("abcd ") for _ in range(n)) for n in (1, 7, 1023, 1024, 1025, 5000)])


def test_blocks_that_do_not_fall_in_step():
    """Long matches cross blocks, so that what a block begins with depends on the whole text before it."""
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    texts = [passage, passage[1:] * 2, "x" + passage[500:2900] + "x" + passage, "a" * 4000, "ab" * 2500]
    check_phrases((("x", passage), ("y", "a" * 3000), ("z", "ab" * 700)), texts)


def test_long_periodic_texts_take_time_in_proportion():
    rnd = random.Random(7)
    parser = CrossParser((("x", "a" * 5000 + "b" + "ab " * 900), ("y", "".join(rnd.choice("abc ") for _ in range(4000)))))
    for piece in ("a", "ab ", "aab"):
        seconds = {}
        for size in (1 << 20, 1 << 22):
            start = time.perf_counter()
            found = parser.phrases(*language._encode(*encoded([piece * (size // len(piece))])))
            seconds[size] = time.perf_counter() - start
            assert (found > 0).all()
        assert seconds[1 << 22] < 8 * seconds[1 << 20] + 2 and seconds[1 << 22] < 60, seconds


def test_alphabets_of_many_letters():
    rnd = random.Random(5)
    letters = {"x": [chr(0x4E00 + i) for i in range(400)], "y": [chr(0x5E00 + i) for i in range(400)]}
    text = {k: "".join(rnd.choice(v) for _ in range(3000)) for k, v in letters.items()}
    sample = tuple((k, text[k][:2000]) for k in letters)
    langs, scores = CrossParser(sample).predict(*encoded([text["x"][2000:], text["y"][2000:], text["y"][2000:2010]]))
    assert langs == ["x", "y", "y"] and min(scores) > 0.1
    check_phrases(sample, [text["x"][1900:2100], text["y"][1990:2400]])


def test_a_repeated_id_and_many_languages_give_a_bounded_sample(spark):
    rows = [(1, f"text {i} of one id", "en") for i in range(5000)] + [(i, f"word {i}", f"l{i % 300}") for i in range(2, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = training_sample(docs, rows=4)
    counts = {lang: sum(own == lang for own, _ in sample) for lang, _ in sample}
    # No language is left out.
    assert len(counts) == 301 and max(counts.values()) <= 4 and counts["en"] == 1
    assert max(len(text) for _, text in training_sample(docs, sample_bytes=3)) == 3
    assert sample == training_sample(docs.repartition(7), rows=4)


def test_text_of_no_learned_language_goes(spark):
    rnd = random.Random(1)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    noise = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)), "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(300))]
    noise.append("".join(chr(0x410 + rnd.randrange(60)) + " " * (rnd.random() < 0.2) for _ in range(400)))
    both = docs.union(spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(noise)], docs.schema))
    kept = {r.doc_id for r in keep_identified(both).select("doc_id").collect()}
    assert not kept & {10**9 + i for i in range(3)}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}


def test_texts_that_two_languages_fit_alike_stay(spark):
    ids = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5][:4]
    docs = spark.createDataFrame([(i, "alpha beta gamma", "en" if k % 2 else "de") for k, i in enumerate(ids)] + [(100, "beta", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.score for r in language_id(docs).collect()}[100] == 0
    assert 100 in {r.doc_id for r in keep_identified(docs).collect()}


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id(docs).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.98 * len(held)


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    text = "the cat sat on the mat and the dog lay by the door "
    other = "le chat est sur le tapis et le chien dort devant la porte "
    rows = [(i, text, "en", "s") for i in range(1, 8)] + [(i, other, "fr", "s") for i in range(8, 16)]
    rows += [(20, None, "en", ""), (21, "", None, ""), (22, "12 !?", "fr", ""), (None, text, "en", ""), (23, text * 3000, None, ""), (23, other, None, "")]
    docs = spark.createDataFrame(rows, schema)
    found = {(r.doc_id, i): (r.lang_pred, r.score) for i, r in enumerate(language_id(docs).collect())}
    by_id = {}
    for (doc_id, _), value in found.items():
        by_id.setdefault(doc_id, []).append(value[0])
    assert by_id[20] == by_id[21] == by_id[22] == ["und"]
    assert by_id[None] == ["en"] and sorted(by_id[23]) == ["en", "fr"]
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == sorted([0, *range(1, 16), 23, 23])
    empty = docs.limit(0)
    assert language_id(empty).collect() == [] and training_sample(empty) == []
    assert [tuple(r) for r in identify(docs.filter("doc_id = 1"), []).collect()] == [(1, "und", 0.0)]
    assert keep_identified(docs.withColumn("lang", docs.lang.substr(1, 0)).filter("doc_id = 22")).collect() == []
