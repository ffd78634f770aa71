"""Revisit resolution against a direct search of all records."""

import random
import re

from loomtrace.llm import revisits as module
from loomtrace.llm.revisits import NOT_PERMITTED, crawl_records, resolve_revisits, restored
from loomtrace.sources.tables import table

SCHEMA = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, payload string, from_id string"


def canonical(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?", url or "")
    if not m or not m[1]:
        return None
    kept = sorted(p for p in (m[3] or "").split("&") if p and not re.match(r"(utm_[^=]*|ref|fbclid|gclid)(=|$)", p))
    return re.sub(r"^www\.", "", m[1].lower()) + m[2].rstrip("/") + ("?" + "&".join(kept) if kept else "")


def brute(rows):  # (record_id, url, ts, kind, status, headers, payload)
    out = []
    plain = [{k.lower(): v for k, v in (h or {}).items()} for *_, h, _ in rows]
    full = [p for p, r in enumerate(rows) if r[3] == "response" and r[4] == 200]
    for p, (i, url, ts, kind, status, _, payload) in enumerate(rows):
        key, h = canonical(url), plain[p]
        if p in full:
            out.append((i, key, kind, "full", i, status, h, payload))
            continue
        if kind != "revisit":
            out.append((i, key, kind, "other", None, status, h, None))
            continue
        found = [q for q in full if key and canonical(rows[q][1]) == key and None not in (ts, rows[q][2]) and rows[q][2] < ts]
        if not found:
            out.append((i, key, kind, "no-earlier-response", None, status, h, None))
            continue
        q = max(found, key=lambda q: (rows[q][2], rows[q][0]))
        old = plain[q]
        tag = lambda x: x.removeprefix("W/")
        how = "no-validator"
        if "warc-payload-digest" in h and "warc-payload-digest" in old and h["warc-payload-digest"] != old["warc-payload-digest"]:
            how = "validator-mismatch"
        elif "etag" in h and "etag" in old:
            how = "resolved" if tag(h["etag"]) == tag(old["etag"]) else "validator-mismatch"
        elif "last-modified" in h and "last-modified" in old:
            how = "resolved" if h["last-modified"] == old["last-modified"] else "validator-mismatch"
        elif "warc-payload-digest" in h and "warc-payload-digest" in old:
            how = "resolved"
        if how == "resolved":
            out.append((i, key, kind, how, rows[q][0], rows[q][4], old | {k: v for k, v in h.items() if k not in NOT_PERMITTED}, rows[q][6]))
        else:
            out.append((i, key, kind, how, None, status, h, None))
    return sorted(map(shown, out))


def shown(row):
    return str((*row[:6], sorted((row[6] or {}).items()), row[7]))


def test_pages_against_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(module, "PIECE_ROWS", 7)
    records = crawl_records(table(spark, sf_dir, "pages"), later=20_000)
    rows = [tuple(r) for r in records.collect()]
    got = sorted(shown(tuple(r)) for r in restored(records).collect())
    assert got == brute(rows)
    assert {"full", "resolved", "validator-mismatch"} <= {x.resolution for x in resolve_revisits(records).select("resolution").distinct().collect()}


def test_hot_url_ties_nulls_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(module, "PIECE_ROWS", 20)
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        url = rnd.choice(["http://hot.org/a", "https://www.HOT.org/a/?utm_source=q", "http://b.org/?z=1&y=2", "http://b.org?y=2&z=1#f", None, "junk", "http://c.org/%d" % rnd.randrange(20)])
        headers = {k: v for k, v in {"ETag": rnd.choice(['"1"', 'W/"1"', '"2"', None]), "Last-Modified": rnd.choice(["m", "n", None]), "WARC-Payload-Digest": rnd.choice(["d", "d", "e", None]), "Content-Type": str(i), "x-Seen": str(i)}.items() if v}
        kind = rnd.choice(["response", "revisit", "revisit", None])
        rows.append((i, url, rnd.choice([None, *range(60)]), kind, rnd.choice([200, 200, 404]) if kind == "response" else 304, headers if i % 9 else None, f"body {i}" if kind == "response" else None))
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    assert sorted(shown(tuple(r)) for r in restored(frame).collect()) == brute(rows)
    twice = resolve_revisits(frame.union(frame))
    assert twice.count() == 800 and restored(frame.limit(0)).collect() == []
    odd = spark.createDataFrame([(1, "http://x.org", 1, "response", 200, {"A": "1", "a": "2"}, "p", "")], SCHEMA)
    assert resolve_revisits(odd).first().headers == {"a": "2"}


def test_a_source_that_most_revisits_repeat_is_copied(spark, monkeypatch):
    monkeypatch.setattr(module, "COPY_ROWS", 3)
    body, url = "b" * 200_000, "http://hot.org/" + "p" * 20_000
    rows = [(0, url, 1, "response", 200, {"ETag": '"1"'}, body, "x")] + [(i, url, 1 + i, "revisit", 304, {"ETag": '"1"', "Date": str(i)}, None, "x") for i in range(1, 60)]
    rows += [(100, "http://b.org", 5, "revisit", 304, None, None, None), (100, "http://b.org", 5, "revisit", 304, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(shown(tuple(r)) for r in restored(frame).collect()) == brute([r[:7] for r in rows])
