"""Every query of the catalogue against its DuckDB SQL, on the smallest tables."""

import glob
import os
import re

import duckdb
import pytest

from loomtrace.plans.catalog import ORACLES, QUERIES


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(names) == sorted(frame.columns)
    order = [frame.columns.index(n) for n in sorted(names)]
    theirs = sorted((tuple(plain(r[names.index(n)]) for n in sorted(names)) for r in result.fetchall()), key=str)
    ours = sorted((tuple(plain(r[i]) for i in order) for r in frame.collect()), key=str)
    assert ours == theirs


def common(a, b):
    """The length of the longest common subsequence, row by row."""
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


def likeness(a, b):
    return 2 * common(a, b) / (len(a) + len(b)) if a or b else 1.0


def test_likeness_of_texts_by_hand(spark, sf_dir):
    """The queries that SQL cannot state, against plain loops over all their rows."""
    from difflib import SequenceMatcher

    texts = {r.item_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {r.item_id: r.ratio for r in QUERIES["q_indel_ratio"](spark, sf_dir).collect()}
    assert found == {i: round(likeness(t, texts[i + 1]), 9) for i, t in texts.items() if i + 1 in texts}
    docs = {r.doc_id: (r.text or "").splitlines() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: r.ratio for r in QUERIES["q_sequence_ratio"](spark, sf_dir).collect()}
    assert found == {i: round(SequenceMatcher(None, t, docs[i + 1]).ratio(), 9) for i, t in docs.items() if i + 1 in docs}
    words = {}
    for i, t in texts.items():
        for w in re.split(r"\s+", t):
            words[w] = min(i, words.get(w, i))
    found = {r.word: (r.first_item, r.best) for r in QUERIES["q_max_fuzzy_join"](spark, sf_dir).collect()}
    assert found == {w: (i, round(max(likeness(w, x) for x in ("the", "thing", "reation", "and")), 9)) for w, i in words.items()}


def test_every_other_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"q_indel_ratio", "q_sequence_ratio", "q_max_fuzzy_join"}
