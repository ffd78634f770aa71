"""Language identification by cross-parsing entropy over suffix automata.

Labelled text of each language becomes a suffix automaton, whose paths spell every
substring of it. A text is cut greedily into phrases, each the longest match that a
language's automaton has from there on; the language that needs the fewest phrases,
times the bits that point to a place in its labelled text, wins.

The alphabet is UTF-8 bytes of lower-cased letters, so that no script has too many
symbols for a table. The automata of all languages become one table of transitions,
and many blocks of texts walk through it in step, so that a step is a few numpy calls
however many texts a batch has. Blocks only split the work: each begins some symbols
early to fall in step with the block before, and one that did not is walked again
from the state in which that block ended. So phrases are those of the whole text.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.batches import kept, map_batches, slices

#: Labelled rows of a language that are learned from at most, and bytes of them.
SAMPLE_ROWS = 64
SAMPLE_BYTES = 48_000
#: Bytes that the tables of all languages may take in a worker; with many languages each learns from less.
TABLE_BYTES = 256 << 20
#: Rows longer than this are learned from only where a language has no others.
ROW_CHARS = 4_000
#: Rounds in which blocks that are out of step are walked again side by side, before one after the other.
ROUNDS = 4
#: Symbols of a block, and symbols before it that are walked to fall in step.
BLOCK, LEAD = 1_024, 96
#: Cost that a text may have beyond its symbols' share before it is in no learned language, in phrases.
SLACK = 8
#: Times the usual bits a symbol from which on a text is in no learned language.
FAR = 2.5

#: What a worker keeps from task to task.
KEEPS = ("_parser", "_fold_table")

UNDETERMINED = "und"
_SPACE = 0x20


def held_out(doc_id: Column, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is held out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == remainder, F.lit(True))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, row_chars: int = ROW_CHARS) -> list[tuple[str, str]]:
    """(lang, text) of at most ``rows`` rows of each language, the same for the same rows.

    Learned from are rows with a language whose crc32(doc_id) mod 5 is not 0. Each
    language's rows fall into ``rows`` cells by a hash of the id; a cell gives one row,
    that with the least hashes of id and text, of up to ``row_chars`` characters if it has one.
    A row gives its first ``sample_bytes`` characters at most, so what comes to the driver is
    ``rows * sample_bytes`` for each language, whatever ids are repeated.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    known = known.withColumn("place", F.xxhash64("doc_id")).withColumn("hash", F.xxhash64("text")).withColumn("long", F.length("text") > row_chars)
    cells = known.groupBy("lang", F.pmod("place", F.lit(rows)).alias("cell")).agg(F.min(F.struct("long", "place", "hash")).alias("least"))
    chosen = [(r.lang, r.least.place, r.least.hash) for r in cells.collect()]
    if not chosen:
        return []
    # ``rows`` keys of a language at most.
    keys = docs.sparkSession.createDataFrame(chosen, "lang string, place long, hash long")
    texts = known.join(F.broadcast(keys), ["lang", "place", "hash"]).groupBy("lang", "place", "hash").agg(F.min(F.substring("text", 1, sample_bytes)).alias("text"))
    return [(r.lang, r.text) for r in texts.orderBy("lang", "place", "hash").collect()]


class CrossParser:
    """The automata of all languages as one table; made from (lang, text) rows, the same for the same rows."""

    def __init__(self, sample: tuple[tuple[str, str], ...], sample_bytes: int = SAMPLE_BYTES, table_bytes: int = TABLE_BYTES):
        self.langs = sorted({lang for lang, _ in sample})
        learned = {lang: [_fold(text) for own, text in sample if own == lang] for lang in self.langs}
        # A state has one cell for each symbol of its language; a byte has two states at most.
        most = {lang: min(sample_bytes, table_bytes // len(self.langs) // (8 * (len(set(b"".join(texts))) + 1))) for lang, texts in learned.items()}
        self.codes = np.zeros((len(self.langs), 256), np.uint8)
        tables, self.bits, self.roots, base = [], [], [], 0
        for k, lang in enumerate(self.langs):
            symbols = sorted(set(b"".join(learned[lang])))
            self.codes[k, symbols] = np.arange(1, len(symbols) + 1)
            rows: list[bytes] = []
            left = most[lang]
            for text in learned[lang]:
                rows.append(text[:left])
                left -= len(rows[-1])
            table = _parse_table([self.codes[k][np.frombuffer(text, np.uint8)].tolist() for text in rows], len(symbols) + 1, base)
            gc.collect()  # an automaton's dictionaries go before the next one's come
            self.roots.append(base)
            self.bits.append(math.log2(sum(map(len, rows)) + 2))
            base += len(table)
            tables.append(table)
        self.table, at = np.empty(base, np.int32), 0
        while tables:  # each goes as it is copied, so that the tables are not held twice
            part = tables.pop(0)
            self.table[at : at + len(part)] = part
            at += len(part)

    def _walk(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases that end, last state) of walks over symbols[:, start:start + length] of each row; the longest come first."""
        state = state.copy()
        count = np.zeros(state.shape, np.int32)
        for j in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -j, "left"))  # walks longer than j
            packed = self.table.take(state[:, :n] + symbols[:, starts[:n] + j])
            count[:, :n] += packed & 3
            np.right_shift(packed, 2, out=state[:, :n])
        return count, state

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language, for folded texts data[offsets[i]:offsets[i + 1]]."""
        out = np.zeros((len(self.langs), len(offsets) - 1), np.int64)
        n_blocks = -(-np.diff(offsets) // BLOCK)
        owner = np.repeat(np.arange(len(n_blocks)), n_blocks)
        if not len(owner) or not self.langs:
            return out
        symbols = self.codes[:, data]
        number = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        starts = offsets[owner] + number * BLOCK
        lengths = np.minimum(BLOCK, offsets[owner + 1] - starts)
        roots = np.array(self.roots, np.int64)[:, None]
        begin = np.repeat(roots, len(owner), axis=1)
        later = np.flatnonzero(number > 0)
        if len(later):  # all later blocks walk in from LEAD symbols before
            begin[:, later] = self._walk(symbols, starts[later] - LEAD, np.full(len(later), LEAD), begin[:, later])[1]
        order = np.argsort(-lengths, kind="stable")
        count, end = np.empty(begin.shape, np.int64), np.empty(begin.shape, np.int64)
        count[:, order], end[:, order] = self._walk(symbols, starts[order], lengths[order], begin[:, order])
        for _ in range(ROUNDS):  # blocks that did not begin as the one before ended
            lang, at = np.nonzero(begin[:, later] != end[:, later - 1])
            if not len(at):
                break
            at = later[at]
            order = np.argsort(-lengths[at], kind="stable")
            lang, at = lang[order], at[order]
            begin[lang, at] = end[lang, at - 1]
            flat = symbols.reshape(1, -1)
            counted, ended = self._walk(flat, lang * symbols.shape[1] + starts[at], lengths[at], begin[lang, at][None, :])
            count[lang, at], end[lang, at] = counted[0], ended[0]
        else:
            self._settle(data, symbols, starts, lengths, number, begin, end, count)
        last = np.append(owner[1:] != owner[:-1], True)
        count += (end != roots) & last  # the phrase that the text's end cuts off
        for k in range(len(self.langs)):
            out[k] = np.bincount(owner, weights=count[k], minlength=len(n_blocks)).astype(np.int64)
        return out

    def _settle(self, data: np.ndarray, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, number: np.ndarray, begin: np.ndarray, end: np.ndarray, count: np.ndarray) -> None:
        """Walks the blocks that are still out of step in their order, each once.

        Texts that never fall in step repeat themselves, and so do their blocks: a block
        that was walked from the same state before is not walked again.
        """
        known: dict[tuple[int, bytes, int], tuple[int, int]] = {}
        for lang in range(len(self.langs)):
            wrong = np.flatnonzero((begin[lang, 1:] != end[lang, :-1]) & (number[1:] > 0)) + 1
            done = 0
            for first in wrong.tolist():
                at = first
                # From the first wrong block on, for as long as the one before ends in another state than this one began in.
                while at >= done and at < len(number) and number[at] > 0 and begin[lang, at] != end[lang, at - 1]:
                    state = int(end[lang, at - 1])
                    low, high = int(starts[at]), int(starts[at] + lengths[at])
                    key = (lang, data[low:high].tobytes(), state)
                    if key not in known:
                        known[key] = self._walk_one(symbols[lang, low:high].tolist(), state)
                    begin[lang, at] = state
                    count[lang, at], end[lang, at] = known[key]
                    at += 1
                done = max(done, at)

    def _walk_one(self, symbols: list[int], state: int) -> tuple[int, int]:
        """(phrases that end, last state) of one block."""
        ended, step = 0, self.table.item
        for symbol in symbols:
            packed = step(state + symbol)
            ended += packed & 3
            state = packed >> 2
        return ended, state

    def costs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits that each language needs for each text, symbols of each text, whether it has a letter) of texts as UTF-8."""
        folded, at = _encode(data, offsets)
        letters = np.concatenate(([0], np.cumsum(folded != _SPACE)))
        return self.phrases(folded, at) * np.array(self.bits)[:, None], np.diff(at), letters[at[1:]] > letters[at[:-1]]

    def predict(self, data: np.ndarray, offsets: np.ndarray, limit: np.ndarray | None = None) -> tuple[list[str], np.ndarray]:
        """(languages, scores) of texts as UTF-8; a text above its language's ``limit`` of bits a symbol is in none."""
        if not self.langs:
            return [UNDETERMINED] * (len(offsets) - 1), np.zeros(len(offsets) - 1)
        cost, sizes, known = self.costs(data, offsets)
        best = np.argmin(cost, axis=0)
        ordered = np.sort(cost, axis=0)
        second = ordered[1] if len(self.langs) > 1 else np.where(sizes > 0, np.inf, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            scores = np.where(second > 0, 1 - ordered[0] / second, 0.0)
        scores = np.where(known, scores, 0.0)
        if limit is not None:
            known = known & (ordered[0] <= limit[best] * sizes + SLACK * np.array(self.bits)[best])
        return [self.langs[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist(), strict=True)], scores


def _encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded texts as UTF-8 bytes, with one space for each run of anything but letters, and their offsets."""
    points, at = code_points(data, offsets)
    points = _fold_table()[points]
    gap = points == _SPACE
    again = np.zeros(len(points), bool)
    again[1:] = gap[1:] & gap[:-1]
    first = at[(at < len(points))]
    again[first] = gap[first]  # no text begins with a space
    points = points[~again]
    at = np.concatenate(([0], np.cumsum(~again)))[at]
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    folded = np.frombuffer(points.tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
    return folded, np.concatenate(([0], np.cumsum(sizes)))[at]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 texts, and their offsets; bytes that aren't UTF-8 count as U+FFFD."""
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        return points, starts[offsets]
    except UnicodeDecodeError:
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        at = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32), at


def _fold(text: str) -> bytes:
    """Lower-case letters as UTF-8, with one space for each run of other characters."""
    return " ".join("".join(c.lower()[0] if c.isalpha() else " " for c in text).split()).encode()


@kept
def _fold_table() -> np.ndarray:
    """The lower-case letter of each code point, and a space for what is no letter."""
    letters = [chr(point) for point in range(0x110000)]
    return np.array([ord(c.lower()[0]) if c.isalpha() else _SPACE for c in letters], "<u4")


def _automaton(rows: list[list[int]]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of the rows; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def split(p: int, q: int, c: int) -> int:
        """State q of the move p -c-> q, or a copy of it that only the suffixes up to p reach."""
        if length[q] == length[p] + 1:
            return q
        copy = len(moves)
        moves.append(dict(moves[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and moves[p].get(c) == q:
            moves[p][c] = copy
            p = link[p]
        return copy

    for symbols in rows:
        last = 0
        for c in symbols:
            if c in moves[last]:  # an earlier row has it
                last = split(last, moves[last][c], c)
                continue
            now = len(moves)
            moves.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = now
                p = link[p]
            if p >= 0:
                link[now] = split(p, moves[p][c], c)
            last = now
    return moves


def _parse_table(rows: list[list[int]], width: int, base: int) -> np.ndarray:
    """What a step of the greedy parse does, by place of the state + symbol: 4 * place of the next state + phrases that end.

    A symbol that does not go on ends the phrase and begins the next one; symbol 0,
    which the language lacks, is a phrase of its own.
    """
    moves = _automaton(rows)
    root = np.full(width, base << 2 | 1, np.int32)
    for c, to in moves[0].items():
        root[c] = (base + to * width) << 2
    table = np.tile(root + 1, (len(moves), 1))
    table[0] = root
    source = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
    by = np.fromiter((c for m in moves for c in m), np.int64, len(source))
    to = np.fromiter((t for m in moves for t in m.values()), np.int64, len(source))
    table[source, by] = (base + to * width) << 2
    return table.ravel()


@kept
def _parser(sample: tuple[tuple[str, str], ...], sample_bytes: int, table_bytes: int) -> CrossParser:
    return CrossParser(sample, sample_bytes, table_bytes)


def _limits(sample: tuple[tuple[str, str], ...], sample_bytes: int, table_bytes: int) -> np.ndarray:
    """For each language FAR times the bits a symbol that the median labelled row needs which the automata did not learn.

    Every other row of a language is learned, the others are measured beyond SLACK
    phrases; the median does not heed mislabelled rows. A language of fewer than eight
    rows has no limit.
    """
    langs = sorted({lang for lang, _ in sample})
    rows = {lang: [text for own, text in sample if own == lang] for lang in langs}
    parser = CrossParser(tuple((lang, text) for lang in langs for text in rows[lang][::2]), sample_bytes, table_bytes)
    out = []
    for k, lang in enumerate(langs):
        parts = [text.encode() for text in rows[lang][1::2]]
        cost, sizes, known = parser.costs(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
        share = (cost[k] - SLACK * parser.bits[k])[known] / sizes[known]
        out.append(FAR * max(float(np.median(share)), 1.0) if len(rows[lang]) >= 8 and len(share) else 1e9)
    return np.array(out)


def identify(docs: DataFrame, sample: list[tuple[str, str]], sample_bytes: int = SAMPLE_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text; other columns are not read).

    ``score`` is the share of the runner-up's cost that the winner saves, 0 to 1.
    A null text, an empty one and one without a letter give ``und`` and 0, as does a
    model without languages; a text of unknown letters only ties and gives the first
    language and 0. Ties go to the first language by name. Rows of a repeated id are
    judged each by its own text; texts of any length are read whole; no row: no row.
    Each worker builds the automata from the bounded sample, so a lost executor loses nothing.
    """
    rows = tuple(sample)

    def scan(batches: Iterator[pa.RecordBatch]):
        parser = _parser(rows, sample_bytes, table_bytes)
        for batch, data, offsets in slices(batches):
            langs, scores = parser.predict(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(source, scan, "doc_id long, lang_pred string, score double", KEEPS)


def language_id(docs: DataFrame, rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, row_chars: int = ROW_CHARS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns from ``docs`` (doc_id, text, lang) as ``training_sample`` does and predicts every row of it as ``identify`` does."""
    found = identify(docs, training_sample(docs, rows, sample_bytes, row_chars), sample_bytes, table_bytes)
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.0, rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, row_chars: int = ROW_CHARS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a score of ``least`` or more; columns are unchanged.

    A row goes if its text is null, has no letter, or needs far more bits a symbol than
    labelled text of the language does (``_limits``): text of no learned language. Short
    texts that two languages fit alike have the score 0 and stay. Where no row has a
    language nothing can be learned and every row with a letter stays. Rows of a repeated
    id are judged each by its own text, very long ones whole; no row: no row.
    """
    sample = tuple(training_sample(docs, rows, sample_bytes, row_chars))
    if not sample:
        return docs.filter(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    limit = _limits(sample, sample_bytes, table_bytes)

    def scan(batches: Iterator[pa.RecordBatch]):
        parser = _parser(sample, sample_bytes, table_bytes)
        for batch, data, offsets in slices(batches, "text"):
            langs, scores = parser.predict(data, offsets, limit)
            yield batch.filter(pc.and_(pc.not_equal(pa.array(langs), UNDETERMINED), pa.array(scores >= least)))

    return map_batches(docs, scan, docs.schema, KEEPS)
