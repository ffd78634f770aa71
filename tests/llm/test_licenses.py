"""Licence scans against comparing every part with every template."""

import re
import textwrap

import regex

from loomtrace.llm.licenses import TEMPLATES, THRESHOLD, document_licenses, scan
from loomtrace.sources.tables import table


def grams(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    return set(zip(words, words[1:])) if len(words) > 1 else set(words)


PATTERNS = [grams(t) for _, t in TEMPLATES]


def brute(rows, threshold=THRESHOLD):
    out = set()
    for doc_id, text in rows:
        text = text or ""
        paragraphs, lines = re.split(r"\n[ \t\r]*\n\s*", text), text.split("\n")
        parts = [("text", 0, text)]
        parts += [("paragraph", i, p) for i, p in enumerate(paragraphs)] if len(paragraphs) > 1 else []
        parts += [("line", i, p) for i, p in enumerate(lines)] if len(lines) > len(paragraphs) else []
        for part, i, body in parts:
            own = grams(body)
            dice = [(2 * len(own & p) / (len(own) + len(p)), -k) for k, p in enumerate(PATTERNS)]
            best = max(dice)
            if best[0] >= threshold:
                out.add((doc_id, part, i, TEMPLATES[-best[1]][0], -best[1], round(best[0], 9)))
    return sorted(out, key=str)


def got(frame):
    return sorted({(r.doc_id, r.part, r.number, r.licence, r.template, round(r.dice, 9)) for r in frame.collect()}, key=str)


def test_documents_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = got(scan(docs))
    assert found == brute(rows) and len(found) > 20
    assert {x[0] for x in found} == {r.doc_id for r in document_licenses(docs).collect()}


def test_edits_parts_and_odd_rows(spark):
    mit = TEMPLATES[3][1]
    edited = mit.replace("hereby", "here").replace("Software", "Programme", 2)
    rows = [(1, mit), (2, "Title\n\n" + edited + "\n\nend"), (3, "x\nReleased under  the MIT-License\ny"), (4, None), (5, ""), (6, "word " * 40000), (7, "\n\n\n"), (None, "All rights reserved."), (1, mit), (8, "ALL RIGHTS RESERVED"), (9, "rights"), (10, mit[:200])]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, licence string, dice double")
    assert got(scan(docs)) == brute(rows)
    assert got(scan(docs, threshold=0.5)) == brute(rows, 0.5)
    assert {(r.doc_id, r.licences) for r in document_licenses(docs).collect()} >= {(1, "MIT"), (2, "MIT"), (3, "MIT"), (None, "proprietary"), (8, "proprietary")}
    assert scan(docs.limit(0)).collect() == []


def test_windows_in_longer_texts(spark):
    mit = TEMPLATES[3][1]
    gpl, apache = TEMPLATES[9][1], TEMPLATES[7][1]
    prose = " ".join(f"The river ran past mill {i} and nobody of village {i + 500} knew who had built it." for i in range(40)) + " "
    wrapped = textwrap.fill(mit, 76)
    blocks = mit.replace(" The above", "\n\nThe above").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    in_blocks = "\n\n".join(textwrap.fill(p, 76) for p in blocks.split("\n\n"))
    texts = {
        1: prose + "\n" + wrapped + "\n" + prose,
        2: prose + "\n\n" + in_blocks + "\n\n" + prose,
        3: prose + "\n\n" + "\n\n".join(textwrap.fill(gpl[i : i + 200], 76) for i in range(0, len(gpl), 200)) + "\n\n" + prose,
        4: prose + "\n" + textwrap.fill(apache, 76) + "\n" + prose + in_blocks,
        5: prose + "Released under the MIT License. " + prose,
        6: prose + "This work is licensed under the GNU General Public License, version 3. " + prose,
        7: prose + "\nReleased under the MIT License.\n" + prose,
        8: prose,
    }
    docs = spark.createDataFrame([*texts.items(), (5, texts[5]), (None, texts[5])], "doc_id long, text string")
    rows = scan(docs).collect()
    by_id = {i: sorted({r.licence for r in rows if r.doc_id == i}) for i in [*texts, None]}
    assert by_id == {1: ["MIT"], 2: ["MIT"], 3: ["GPL-3.0"], 4: ["Apache-2.0", "MIT"], 5: ["MIT"], 6: ["GPL-3.0"], 7: ["MIT"], 8: [], None: ["MIT"]}
    assert [(r.part, r.dice) for r in rows if r.doc_id == 5] == [("window", 1.0)]
    assert [r.part for r in rows if r.doc_id == 7] == ["line"]
    first = len([w for w in regex.split(r"[^\p{L}\p{N}]+", prose) if w])
    assert {(r.doc_id, r.number) for r in rows if r.doc_id in (1, 2, 5, 6)} == {(i, first) for i in (1, 2, 5, 6)}
