"""Toxicity: boosted trees over lexicon densities and marks of style, with isotonic calibration.

The lexicon is learned from labelled rows: beginnings of words, and whole words, that
toxic texts have more often than others, each with its log-odds. Labelled rows fall into
folds by their text. A row's densities come from a lexicon of the other folds, and the
calibration from scores of trees that were grown without the row's fold, so neither sees
its own labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.batches import map_batches, slices
from loomtrace.llm.language import held_out
from loomtrace.llm.quality import Forest, fit
from loomtrace.llm.scratch import Scratch
from loomtrace.llm.shingles import mix, runs

#: Labelled rows that the classifier is fitted on at most, those with the least hash of doc_id, and entries of its lexicon at most.
SAMPLE_ROWS, ENTRIES = 20_000, 50_000
#: Folds of the labelled rows, and levels of the trees.
FOLDS, DEPTH = 5, 3
#: Bytes of the shortest and the longest beginning of a word that is an entry.
SHORTEST, LONGEST = 4, 12
#: Words on either side of a lexicon word where a second person counts as near.
NEAR = 5
#: Sightings at the usual share of toxic texts that are added to those of every entry.
PRIOR = 4.0
#: Log-odds from which a word counts to a tier of the lexicon.
TIERS = (1.5, 2.25, 3.0, 4.0)
#: Words that address a reader in English, German, French and Spanish.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "deiner", "euch", "euer", "ihr", "tu", "toi", "te",
    "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros", "contigo",
)

FEATURES = (
    "log_words", "log_bytes", "weight", "weight_density", "greatest",
    *(f"tier{i}_{kind}" for i in range(len(TIERS)) for kind in ("count", "density")),
    "second_person", "near_second_person", "near_second_person_density", "capitals", "shouted", "bangs", "questions", "mark_runs",
    "inner_digits", "inner_symbols", "repeated_letters", "lone_letters", "symbols",
)

_STEP, _PRIME, _WHOLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3), np.uint64(0x5851F42D4C957F2D)
#: Bytes between words: all of ASCII but digits and letters.
_BETWEEN = np.ones(256, bool)
_BETWEEN[128:] = False
_UPPER, _LETTER, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[0x41:0x5B] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = _DIGIT[0x30:0x3A] = True
_BETWEEN[_LETTER | _DIGIT] = False
_SYMBOL[[ord(c) for c in "*@$#%&_+=~^|\\<>"]] = True
#: Lower case, and digits as the letters that they stand for in a disguised word.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
for _digit, _letter in zip("013457", "oieast", strict=True):
    _FOLD[ord(_digit)] = ord(_letter)


def _folded(data: np.ndarray) -> np.ndarray:
    """Bytes as words are compared: lower case in Latin-1 too."""
    low = _FOLD[data]
    if len(data) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][accented] += 32
    return low


def _entries(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which words, hash) of every beginning of SHORTEST to LONGEST bytes, characters whole, and of every word up to LONGEST."""
    h = np.full(len(starts), _STEP)
    for k in range(1, LONGEST + 1):
        at = np.flatnonzero(lengths >= k)
        if not len(at):
            return
        h[at] = (h[at] ^ low[starts[at] + k - 1]) * _PRIME
        h[at] ^= h[at] >> np.uint64(29)
        ends = at[lengths[at] == k]
        yield ends, mix(h[ends] ^ _WHOLE)
        if k >= SHORTEST:
            longer = at[lengths[at] > k]
            longer = longer[(low[starts[longer] + k] & 0xC0) != 0x80]
            for whole in (longer, ends):  # a whole word is also its own beginning
                yield whole, mix(h[whole] + np.uint64(k))


def _unlike(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one word of each kind, the kind of each word), where words alike in LONGEST bytes and in length up to one more are one kind."""
    h = np.minimum(lengths, LONGEST + 1).astype(np.uint64) * _STEP
    for k in range(LONGEST):
        at = np.flatnonzero(lengths > k)
        if not len(at):
            break
        h[at] = (h[at] ^ low[starts[at] + k]) * _PRIME
        h[at] ^= h[at] >> np.uint64(29)
    # Whether a character goes on behind the last byte decides which beginnings count.
    long = np.flatnonzero(lengths > LONGEST)
    h[long] ^= ((low[starts[long] + LONGEST] & 0xC0) == 0x80).astype(np.uint64) * _WHOLE
    _, one, kind = np.unique(h, return_index=True, return_inverse=True)
    return one, kind


@dataclass
class Lexicon:
    """Sorted hashes of entries and their log-odds: a column without each fold, and the last one from all."""

    hashes: np.ndarray
    weights: np.ndarray

    def of_words(self, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """The greatest log-odds of each word's entries, 0 without one, by the column ``fold`` of each word."""
        if not len(starts) or not len(self.hashes):
            return np.zeros(len(starts))
        one, kind = _unlike(low, starts, lengths)
        best = np.zeros((len(one), self.weights.shape[1]))
        for which, hashes in _entries(low, starts[one], lengths[one]):
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[place] == hashes
            best[which[hit]] = np.maximum(best[which[hit]], self.weights[place[hit]])
        return best[kind, fold]


def _pronouns() -> np.ndarray:
    texts = [t.encode() for t in SECOND_PERSON]
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    return np.unique(_wholes(_folded(data), starts, lengths))


def _wholes(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each whole word of up to LONGEST bytes; 0 for a longer one."""
    h, out = np.full(len(starts), _STEP), np.zeros(len(starts), np.uint64)
    for k in range(1, LONGEST + 1):
        at = np.flatnonzero(lengths >= k)
        if not len(at):
            break
        h[at] = (h[at] ^ low[starts[at] + k - 1]) * _PRIME
        h[at] ^= h[at] >> np.uint64(29)
        ends = at[lengths[at] == k]
        out[ends] = mix(h[ends] ^ _WHOLE)
    return out


_SECOND = _pronouns()


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, fold: np.ndarray | None = None) -> np.ndarray:
    """One row of FEATURES for each UTF-8 text data[offsets[i]:offsets[i + 1]]; ``fold`` names the lexicon's column of each text, the last by default."""
    n = len(offsets) - 1
    low = _folded(data)
    starts, lengths = runs(data, offsets, _BETWEEN)
    first = np.searchsorted(starts, offsets)
    n_words, sizes = np.diff(first), np.diff(offsets)
    owner, of_byte = np.repeat(np.arange(n), n_words), np.repeat(np.arange(n), sizes)
    fold = np.full(n, lexicon.weights.shape[1] - 1) if fold is None else fold
    weight = lexicon.of_words(low, starts, lengths, fold[owner])
    total = np.bincount(owner, weight, n)
    greatest = np.zeros(n)
    np.maximum.at(greatest, owner, weight)
    some, bytes_ = np.maximum(1, n_words), np.maximum(1, sizes)
    columns = [np.log1p(n_words), np.log1p(sizes), np.log1p(total), total / some, greatest]
    for least in TIERS:
        count = np.bincount(owner[weight >= least], minlength=n)
        columns += [np.log1p(count), count / some]
    second = np.isin(_wholes(low, starts, lengths), _SECOND)
    # How many of the second person stand from NEAR words before to NEAR words after, within the text.
    seen = np.concatenate(([0], np.cumsum(second)))
    place = np.arange(len(starts))
    around = seen[np.minimum(place + NEAR + 1, first[owner + 1])] - seen[np.maximum(place - NEAR, first[owner])]
    near = np.bincount(owner[(weight >= TIERS[0]) & (around > 0)], minlength=n)
    letters = _LETTER[data]
    upper = np.bincount(of_byte[_UPPER[data]], minlength=n)
    uppers = np.concatenate(([0], np.cumsum(_UPPER[data])))
    shouted = (lengths >= 2) & (uppers[starts + lengths] - uppers[starts] == lengths)
    bang, question = data == 0x21, data == 0x3F
    same = np.zeros(len(data), bool)  # a byte of the same text as the one before
    same[1:] = of_byte[1:] == of_byte[:-1]
    runs_of = same & (bang | question)
    runs_of[1:] &= (bang | question)[:-1]
    inner = np.zeros(len(data), bool)
    inner[1:-1] = letters[:-2] & letters[2:] & same[1:-1] & same[2:]
    repeated = np.zeros(len(data), bool)
    repeated[2:] = (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & letters[2:] & (data[2:] < 0x80) & same[2:] & same[1:-1]
    lone = (lengths == 1) & letters[starts]
    pairs = np.zeros(len(starts), bool)
    pairs[1:] = lone[1:] & lone[:-1] & (owner[1:] == owner[:-1])

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(of_byte[mask], minlength=n) / bytes_

    def share_of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n) / some

    columns += [
        share_of_words(second), np.log1p(near), near / some, upper / np.maximum(1, np.bincount(of_byte[letters], minlength=n)), share_of_words(shouted),
        share(bang), share(question), share(runs_of), share(inner & _DIGIT[data]), share(inner & _SYMBOL[data]), share(repeated), share_of_words(pairs), share(_SYMBOL[data]),
    ]
    return np.column_stack(columns)


@dataclass
class Isotonic:
    """A rising line through the means of pooled scores."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        return np.interp(scores, self.at, self.value) if len(self.at) else np.zeros(len(scores))


def isotonic(scores: np.ndarray, labels: np.ndarray) -> Isotonic:
    """The rising step function nearest to the labels in squares, as a line through the middles of its steps."""
    order = np.argsort(scores, kind="stable")
    x, first = np.unique(scores[order], return_index=True)
    sums = np.add.reduceat(labels[order], first) if len(x) else np.empty(0)
    counts = np.diff(np.append(first, len(order)))
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, c, v in zip(sums, counts, x, strict=True):
        blocks.append([float(s), float(c), float(v * c)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return Isotonic(np.array([v / c for _, c, v in blocks]), np.array([s / c for s, c, _ in blocks]))


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, label, fold): at most ``most`` rows of ``labels`` whose crc32(doc_id) mod 4 is not 2, those with the least hash; equal texts of a label once."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), 4, 2)).distinct()
    # The limit proves the bound of what is broadcast.
    known = known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(known.drop("place")), "doc_id").withColumn("key", F.xxhash64("text"))
    return joined.dropDuplicates(["key", "label"]).select("text", "label", F.pmod("key", F.lit(FOLDS)).cast("int").alias("fold"), "key")


def learn_lexicon(rows: DataFrame, entries: int = ENTRIES) -> Lexicon:
    """Entries that at least two toxic texts of ``rows`` have, those that tell most, with log-odds by fold left out."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            low = _folded(data)
            starts, lengths = runs(data, offsets, _BETWEEN)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
            group = np.asarray(batch.column("fold")).astype(np.int64) * 2 + np.asarray(batch.column("label"))
            found = list(_entries(low, starts, lengths))
            if not found:
                continue
            hashes, who = np.concatenate([h for _, h in found]), owner[np.concatenate([w for w, _ in found])]
            order = np.lexsort((who, hashes))
            hashes, who = hashes[order], who[order]
            fresh = np.ones(len(hashes), bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (who[1:] != who[:-1])
            at = np.flatnonzero(fresh)
            times = np.diff(np.append(at, len(hashes)))
            # Repetition within a text counts by its number of binary digits.
            amount = np.frexp(times.astype(float))[1].astype(np.int64)
            out, place = hashes[at].view(np.int64), group[who[at]]
            yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(place.astype(np.int32)), pa.array(amount)], names=["entry", "place", "amount"])

    found = map_batches(rows, scan, "entry long, place int, amount long")
    sums = [F.sum(F.when(F.col("place") == p, F.col("amount")).otherwise(0)).alias(f"a{p}") for p in range(2 * FOLDS)]
    counted = found.groupBy("entry").agg(*sums, F.count_if(F.col("place") % 2 == 1).alias("toxic"))
    sizes = {(r.fold, r.label): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    of = lambda label: float(sum(v for (_, y), v in sizes.items() if y == label))
    bad, good = sum(F.col(f"a{2 * f + 1}") for f in range(FOLDS)), sum(F.col(f"a{2 * f}") for f in range(FOLDS))
    odds = F.log((bad + 0.5) / (of(1) + 1)) - F.log((good + 0.5) / (of(0) + 1))
    told = counted.filter("toxic >= 2").withColumn("odds", odds).filter(F.col("odds") >= TIERS[0])
    kept = told.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(entries).collect()
    amounts = np.array([[r[f"a{p}"] for p in range(2 * FOLDS)] for r in kept], float).reshape(len(kept), FOLDS, 2)
    totals = np.array([[sizes.get((f, y), 0) for y in (0, 1)] for f in range(FOLDS)], float)
    weights = np.zeros((len(kept), FOLDS + 1))
    for f in range(FOLDS + 1):
        rest = [g for g in range(FOLDS) if g != f]
        a, t = amounts[:, rest].sum(axis=1), totals[rest].sum(axis=0)
        # The log-odds of a text with the entry to be toxic, against those of any text; few sightings stay near 0.
        share = (t[1] + 0.5) / (t.sum() + 1)
        weights[:, f] = np.log((a[:, 1] + PRIOR * share) / (a[:, 0] + PRIOR * (1 - share))) - np.log(share / (1 - share))
    hashes = np.array([r.entry for r in kept], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], np.where(weights[order] >= TIERS[0], weights[order], 0))


@dataclass
class Model:
    lexicon: Lexicon
    forest: Forest
    calibration: Isotonic

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.calibration(self.forest.scores(features(data, offsets, self.lexicon)))


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, entries: int = ENTRIES) -> Model:
    """Lexicon, trees and calibration from at most ``most`` labelled rows."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.keep(labelled_rows(docs, labels, most), "labelled")
    lexicon = learn_lexicon(rows, entries)

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            fold = np.asarray(batch.column("fold")).astype(np.int64)
            x = features(data, offsets, lexicon, fold)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), batch.column("fold"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["key", "label", "fold", "x"])

    found = map_batches(rows, scan, "key long, label int, fold int, x array<double>").orderBy("key", "label").limit(most).collect()
    scratch.drop(rows)
    x = np.array([r.x for r in found]).reshape(len(found), len(FEATURES))
    y, fold = np.array([r.label for r in found], float), np.array([r.fold for r in found])
    apart = np.zeros(len(y))
    for f in range(FOLDS):
        if (mine := fold == f).any():
            apart[mine] = fit(x[~mine], y[~mine], depth=DEPTH).scores(x[mine])
    return Model(lexicon, fit(x, y, depth=DEPTH), isotonic(apart, y))


def toxicity(docs: DataFrame, labels: DataFrame, least: float = 0.3, most: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted): learns from at most ``most`` rows of ``labels`` (doc_id, toxic) and scores every row of ``docs``.

    ``predicted`` is 1 from a score of ``least`` on. Equal texts have equal scores; a null
    text counts as empty. Without labels, or with no toxic one, every score is 0. A row with
    a null doc_id is scored and counts as held out; rows of a repeated id are scored each by
    its own text, very long texts whole. Of texts with labels of both kinds both count. No
    other column is read, whatever its name. No row: no row.
    """
    model = learn(docs, labels, most)

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(data, offsets))], names=["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = map_batches(source, scan, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
